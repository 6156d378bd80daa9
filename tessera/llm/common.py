"""Helpers shared by the operators: folds, scratch tables, bounded Arrow batches, byte-exact words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import new_scratch_path
from tessera.sources.tables import table_path

#: Lower-cases A-Z and turns every byte outside [0-9a-z] and 0x80-0xFF into a space. In UTF-8 all bytes of a
#: non-ASCII character are 0x80 or above, so splitting the bytes splits the text at the same places.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256))
BATCH_ROWS = 1000


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(parts)


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(table_path(sf_dir, name)).select(*columns)


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = 32 << 20) -> None:
    """Arrow batches of at most ``rows`` rows and ``size`` bytes: texts can be long, and a worker holds a batch at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder: computed once, column-pruned on every later read,
    and safe when an executor is lost."""
    path = new_scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)



def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
