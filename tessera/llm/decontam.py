"""Operator 8: benchmark decontamination by a prefix-filtered set join.

Every item becomes windows of ``window`` consecutive words (a shorter item is one window), every window the set of its
shingles (runs of ``SHINGLE`` words, or the whole window if shorter), ordered by rarity: their counts over all
documents. A document that contains a window contains all its shingles, so for exact containment a prefix of one, the
rarest, is necessary: documents and windows are joined on that shingle alone, and a window with a shingle that no
document has is dropped. The shingle's place in the document and in the window fixes where the window would lie;
places before the document's first word or beyond its last are discarded (positional and length bounds), and the rest is
verified word by word. Words inside verified windows are hit.

Scale: documents are read twice (shingle counts, then candidates) and never shuffled; only candidate places travel, with
the words around them. Both passes are filtered by a bitmap of the benchmark's shingles, whose size is bounded at 16 MB
whatever the benchmark; what passes the bitmap by chance falls out of the exact join. A very frequent shingle is chosen
only when its window has no rarer one, and the join is left to AQE, which splits skewed keys.

Defined results: null, empty or wordless texts have no words, no hits and aren't contaminated; items without words (or
null) have no windows; an empty benchmark gives zero hits; an empty table gives no rows; repeated rows and equal or
null ids each give their own row; items that are equal all count; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import read, written
from tessera.llm.hashing import Words, bitmap, groups, in_bitmap

WINDOW = 13
SHINGLE = 5


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(words, size, items): each distinct window of the benchmark (item_id, text) with the items that have it."""
    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in groups(pdf):
                found = Words(list(part["text"]))
                rows = []
                for item, a, n in zip(part["item_id"], found.first.tolist(), found.counts.tolist()):
                    own, size = found.words(a, a + n), min(window, n)
                    rows += [(item, " ".join(own[i: i + size]), size) for i in range(n - size + 1 if n else 0)]
                yield pd.DataFrame(rows, columns=["item_id", "words", "size"])

    cut = benchmark.select(F.col("item_id").cast("string"), "text").mapInPandas(
        split, "item_id string, words string, size int")
    return cut.groupBy("words", "size").agg(F.collect_set("item_id").alias("items"))


def window_shingles(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(words, size, items, hash, length, offset): every shingle of every window."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for words, size in zip(pdf["words"], pdf["size"]):
                k = min(shingle, size)
                rows += [(words, k, int(o), int(h)) for h, o in zip(*Words([words]).shingles(k))]
            out = pd.DataFrame(rows, columns=["words", "length", "offset", "hash"])
            out["hash"] = out["hash"].to_numpy(np.uint64).view(np.int64) if len(out) else out["hash"]
            yield out

    places = windows.select("words", "size").mapInPandas(cut, "words string, length int, offset int, hash long")
    return windows.join(places, "words")


def shingle_counts(docs: DataFrame, packed: np.ndarray, bits: int, lengths: list[int]) -> DataFrame:
    """(hash, n): occurrences in all documents of the shingles that the bitmap lets through."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for part in groups(pdf):
                text = Words(list(part["text"]))
                for k in lengths:
                    h, _ = text.shingles(k)
                    found.append(h[in_bitmap(h, packed, bits)])
            if found:
                h, n = np.unique(np.concatenate(found), return_counts=True)
                yield pd.DataFrame({"hash": h.view(np.int64), "n": n})

    return docs.select("text").mapInPandas(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def necessary_prefixes(shingles: DataFrame, counts: DataFrame) -> DataFrame:
    """(words, size, items, hash, length, offset) of the rarest shingle of each window; windows of which a shingle
    occurs nowhere are gone."""
    w = W.partitionBy("words")
    return (shingles.join(counts, "hash", "left")
            .withColumn("rarest", F.min(F.coalesce("n", F.lit(0))).over(w)).filter("rarest > 0")
            .withColumn("rank", F.row_number().over(w.orderBy("n", "hash", "offset"))).filter("rank = 1")
            .select("words", "size", "items", "hash", "length", "offset"))


def candidate_places(docs: DataFrame, packed: np.ndarray, bits: int, lengths: list[int], window: int, shingle: int,
                     key: Column) -> DataFrame:
    """(row, doc_id, key, n_words, places): one row a document; places of shingles that the bitmap lets through, with the
    words around that a window could cover."""
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in groups(pdf):
                text = Words(list(part["text"]))
                places: list[list] = [[] for _ in range(len(part))]
                for k in lengths:
                    h, at = text.shingles(k)
                    keep = np.flatnonzero(in_bitmap(h, packed, bits))
                    around = window - k if k == shingle else 0
                    for value, place in zip(h[keep].view(np.int64).tolist(), at[keep].tolist()):
                        doc = int(np.searchsorted(text.first, place, side="right")) - 1
                        a = max(int(text.first[doc]), place - around)
                        b = min(int(text.first[doc + 1]), place + k + around)
                        base = int(text.first[doc])
                        places[doc].append({"hash": value, "length": k, "at": place - base, "from": a - base,
                                            "near": text.words(a, b)})
                yield pd.DataFrame({"doc_id": part["doc_id"], "key": part["key"], "n_words": text.counts, "places": places})

    schema = ("doc_id string, key string, n_words long, places array<struct<hash: long, length: int, at: long, `from`: long, "
              "near: array<string>>>")
    return docs.select(F.col("doc_id").cast("string"), "text", key.alias("key")).mapInPandas(find, schema).withColumn(
        "row", F.monotonically_increasing_id())


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  key: Column | None = None) -> DataFrame:
    """One row a document: doc_id, key (the given text expression over the documents, null without one), n_words, n_hit,
    items (sorted as text), spans (first word, end) of the windows."""
    key = F.lit(None).cast("string") if key is None else key
    windows = written(item_windows(benchmark, window), "benchmark-windows")
    shingles = written(window_shingles(windows, shingle), "benchmark-shingles")
    sizes = shingles.groupBy("length").count().collect()  # a row a shingle length: ``shingle`` at most
    lengths = sorted(r["length"] for r in sizes)
    packed, bits = bitmap(shingles, sum(r["count"] for r in sizes))
    counts = shingle_counts(docs, packed, bits, lengths)
    prefixes = written(necessary_prefixes(shingles, counts), "benchmark-prefixes")
    sizes = prefixes.groupBy("length").count().collect()
    lengths = sorted(r["length"] for r in sizes)
    packed, bits = bitmap(prefixes, sum(r["count"] for r in sizes))
    # Written once: row numbers stay the same from here on.
    found = written(candidate_places(docs, packed, bits, lengths, window, shingle, key), "candidate-places")
    places = found.select("row", "n_words", F.explode("places").alias("p")).select("row", "n_words", "p.*")
    first = F.col("at") - F.col("offset")
    verified = (places.join(prefixes, ["hash", "length"]).withColumn("first", first)
                .filter((F.col("first") >= F.col("from")) & (F.col("first") + F.col("size") <= F.col("n_words")))
                .filter(F.array_join(F.slice("near", (F.col("first") - F.col("from") + 1).cast("int"), F.col("size")), " ")
                        == F.col("words"))
                .select("row", "first", (F.col("first") + F.col("size")).alias("end"), "items"))
    before = F.max("end").over(W.partitionBy("row").orderBy("first", "end").rowsBetween(W.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("first", F.coalesce(before, F.lit(0))))
    hits = verified.withColumn("fresh", fresh).groupBy("row").agg(
        F.sum("fresh").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.array_sort(F.collect_set(F.struct("first", "end"))).alias("spans"))
    return found.select("row", "doc_id", "key", "n_words").join(hits, "row", "left").select(
        F.col("doc_id").cast("long").alias("doc_id"), "key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans")


def contaminated(n_hit, n_words):
    return (n_hit > 0) & (20 * n_hit >= n_words)


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of all benchmark windows in all documents."""
    found = contamination(read(spark, sf_dir, "documents", "doc_id", "text"),
                          read(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def words_sql(text: str) -> str:
    """DuckDB expression for the list of words of a text expression."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{upper}', '{upper.lower()}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


OP8_SQL = f"""
WITH d AS (SELECT doc_id, {words_sql('text')} AS w FROM documents),
b AS (SELECT item_id, w, least({WINDOW}, len(w)) AS n FROM (SELECT item_id, {words_sql('text')} AS w FROM benchmark)
      WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)),
hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw USING (n, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
