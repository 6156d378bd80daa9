"""Training-data operators: scoring, deduplication, decontamination, personal data, packing, token files, search.

Each module holds one operator with a general DataFrame interface; ``catalog`` registers the thin queries on the
driver's tables. Nothing outside this package imports it.
"""
