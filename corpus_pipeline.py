"""The corpus pipeline: quality, near-duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; ``run`` writes every stage's result
as Parquet in the shared scratch folder and rereads it as the next one's ``docs``. All stages but the last return the
columns of ``documents``. Nulls, empty tables, repeated rows and further columns are treated as each operator states;
names that clash with the operators' own are not used by them. Models learn from the labelled rows of the stage's own
input and ``labels``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import fresh, read, written
from tessera.llm.decontam import contaminated, contamination
from tessera.llm.dedup import drop_near_duplicates, sized, text_key
from tessera.llm.packing import pack_documents
from tessera.llm.pii import redact
from tessera.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return keep_good(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows don't cover a twentieth or more."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows are told apart by id and text: equal rows are contaminated alike."""
    found = contamination(docs.select("doc_id", "text"), benchmark, key=text_key())
    gone = written(found.filter(contaminated(F.col("n_hit"), F.col("n_words"))).select("doc_id", "key").distinct(),
                   "contaminated")
    key = fresh(docs, "_key")
    left = docs.withColumn(key, F.struct(F.col("doc_id").cast("long").alias("d"), text_key().alias("t")))
    same = F.col(f"{key}.d").eqNullSafe(gone["doc_id"]) & F.col(f"{key}.t").eqNullSafe(gone["key"])
    return left.join(sized(gone), same, "left_anti").drop(key)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 1024 ids; ids as little-endian 32-bit integers."""
    return pack_documents(docs.select("doc_id", "text"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("personal_data", personal_data), ("packing", packing)]

#: Learned scores, samples of a hash and dynamic programming aren't expressible in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = read(spark, sf_dir, "documents", "*")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
