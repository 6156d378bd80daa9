"""CSV source and sink with pandas-compatible missing-value tokens.

Read: every column as text first (``escape='"'`` so a doubled quote is a quote), map the
NA tokens to null, then ``try_cast`` to the declared type — the tokens must be nulled
*before* the cast, or ``'NaN'`` would become a floating NaN. Without a declared schema the
types are inferred from all values in one aggregation, with the outcomes that pandas has.

Quoted line feeds: a file is still read in byte ranges by many tasks. A line feed ends a record where an even number of
quotes precede it in its file, so quotes are counted per range, prefix sums over the ranges (a row each) tell what precedes
each, and running counts inside the ranges tell it of every line. Lines that are whole records, nearly all, are parsed as they
are; only the lines of longer records are brought together, by file and record number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from tessera.spec import NA_TOKENS


# Values that are whole numbers, numbers and truth values to the type inference.
WHOLE = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?|(?i:inf|infinity))$"
TRUTH = ["True", "TRUE", "true", "False", "FALSE", "false"]


def _without_tokens(name: str, tokens: list[str]) -> Column:
    c = F.col(f"`{name}`")
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def inferred_types(text: DataFrame, na_tokens: list[str] | None = None) -> DataFrame:
    """(col_name, type, n_null) of a table of texts: one pass over it, partial results merged, a row a column.

    Whole numbers are ``bigint``, beyond its range ``decimal(20,0)`` if all fit 64 bits without a sign, else ``string``; a
    missing value among whole numbers makes them ``double``; numbers and columns without any value are ``double``; truth
    values, missing ones among them or not, are ``boolean``; anything else, and every column of a table without rows, is
    ``string``."""
    tokens = NA_TOKENS if na_tokens is None else na_tokens

    def facts(name: str) -> Column:
        value = _without_tokens(name, tokens)
        t = F.trim(value)
        whole, wide = t.rlike(WHOLE), t.try_cast("decimal(20,0)")

        def every(c: Column) -> Column:  # null when the column has no value
            return F.bool_and(F.when(value.isNotNull(), F.coalesce(c, F.lit(False))))

        return F.struct(F.lit(name).alias("col_name"), F.count(F.lit(1)).alias("n"), F.count(value).alias("present"),
                        every(whole).alias("whole"), every(whole & t.try_cast("bigint").isNotNull()).alias("narrow"),
                        every(whole & wide.between(0, F.lit(str(2**64 - 1)).cast("decimal(20,0)"))).alias("wide"),
                        every(t.rlike(NUMBER)).alias("number"), every(value.isin(*TRUTH)).alias("truth"))

    if not text.columns:
        return text.sparkSession.createDataFrame([], "col_name string, type string, n_null long")
    all_present = F.col("n") == F.col("present")
    kind = (F.when(F.col("n") == 0, "string").when(F.col("present") == 0, "double")
            .when(F.col("narrow"), F.when(all_present, "bigint").otherwise("double"))
            .when(F.col("whole"), F.when(F.col("wide") & all_present, "decimal(20,0)").otherwise("string"))
            .when(F.col("number"), "double").when(F.col("truth"), "boolean").otherwise("string"))
    return text.agg(F.array(*[facts(c) for c in text.columns]).alias("f")).select(F.inline("f")).select(
        "col_name", kind.alias("type"), (F.col("n") - F.col("present")).alias("n_null"))


READ_OPTIONS = {"escape": '"', "mode": "FAILFAST"}


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, record) of every record of the CSV files at ``path``, numbered from 1 in each file; quoted line feeds
    stay in their record, a carriage return before the line feed that ends one goes, empty records are left out.

    Quotes must be as RFC 4180 has them: only around fields, doubled inside. A file whose quotes don't pair up raises."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("at"))  # grows with the place inside a range, whatever task reads it
    inside = Window.partitionBy("file", "range").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumn("own", quotes).withColumn("seen", F.sum("own").over(inside))
    # Does a record start at the line if the range starts outside quotes (even), or inside them (odd)?
    lines = lines.withColumn("odd", ((F.col("seen") - F.col("own")) % 2).cast("long")).withColumn("even", 1 - F.col("odd"))
    lines = lines.withColumns({"even_starts": F.sum("even").over(inside), "odd_starts": F.sum("odd").over(inside)})
    ranges = lines.groupBy("file", "range").agg(F.sum("own").alias("quotes"), F.sum("even").alias("evens"), F.sum("odd").alias("odds"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.sum("quotes").over(Window.partitionBy("file"))
    ranges = ranges.withColumn("state", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).withColumn(
        "state", F.when(whole % 2 == 0, F.col("state")).otherwise(F.raise_error(F.concat(F.lit("unpaired quotes in "), F.col("file")))))
    ranges = ranges.withColumn("starts", F.when(F.col("state") == 0, F.col("evens")).otherwise(F.col("odds")))
    ranges = ranges.select("file", "range", "state", F.coalesce(F.sum("starts").over(before), F.lit(0)).alias("earlier"))
    placed = lines.join(ranges, ["file", "range"]).select(
        "file", "at", "range", "line",
        (F.col("earlier") + F.when(F.col("state") == 0, F.col("even_starts")).otherwise(F.col("odd_starts"))).alias("number"),
        (F.when(F.col("state") == 0, F.col("even")).otherwise(F.col("odd")) == 1).alias("first"),
        ((F.col("state") + F.col("seen")) % 2 == 0).alias("last"))
    alone = placed.filter("first and last").select("file", "number", F.col("line").alias("record"))
    parts = placed.filter("not (first and last)").groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("range", "at", "line"))).alias("parts"))  # the lines of one record
    joined = parts.select("file", "number", F.array_join(F.col("parts.line"), "\n").alias("record"))
    return alone.unionByName(joined).withColumn("record", F.regexp_replace("record", "\\r$", "")).filter("record <> ''")


def read_text_columns(spark: SparkSession, path: str, multi_line: bool | str = False) -> DataFrame:
    """A CSV file or folder with a header, every value as text."""
    whole = spark.read.options(header=True, multiLine=bool(multi_line), **READ_OPTIONS).csv(path)  # has read the header only
    if multi_line in (False, "whole"):
        return whole
    # a folder's files have a header each; fields by position, so that names may be anything
    schema = StructType([StructField(f"c{k}", StringType(), True) for k in range(len(whole.columns))])
    fields = F.from_csv("record", ", ".join(f"{f.name} string" for f in schema), {"multiLine": "true", **READ_OPTIONS})
    rows = quoted_records(spark, path).filter("number > 1").select(fields.alias("f"))
    return rows.select(*[F.col(f"f.{f.name}").alias(name) for f, name in zip(schema, whole.columns)])


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, na_tokens: list[str] | None = None,
             multi_line: bool | str = False) -> DataFrame:
    """Columns are found by their header name, in any order. Without ``schema`` all columns are read, their types inferred
    from all values. ``multi_line`` reads quoted line feeds, in byte ranges as ever; ``"whole"`` does so by a task a file, for
    files with quotes outside quoted fields. A value that its column's type can't hold raises."""
    tokens = NA_TOKENS if na_tokens is None else na_tokens
    raw = read_text_columns(spark, path, multi_line)
    if schema is None:
        found = inferred_types(raw, tokens).collect()  # a row a column
        schema = StructType([StructField(r["col_name"], _parse_datatype_string(r["type"]), True) for r in found])
    elif isinstance(schema, str):
        schema = _parse_datatype_string(schema)
    text = StructType([StructField(f.name, StringType(), True) for f in schema.fields])
    if not set(text.names) <= set(raw.columns):
        raise ValueError(f"no columns {sorted(set(text.names) - set(raw.columns))} in {path}")
    cols = []
    for f in schema.fields:
        nulled = _without_tokens(f.name, tokens)
        cols.append(nulled.alias(f.name) if isinstance(f.dataType, StringType)
                    else nulled.cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def write_csv(df: DataFrame, path: str, null_tokens: dict[str, str] | None = None) -> None:
    """Write with a header and RFC-4180 quoting, values with their outer blanks; ``null_tokens`` spells nulls per column."""
    null_tokens = null_tokens or {}
    out = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(null_tokens[c])).alias(c) if c in null_tokens
                      else F.col(c) for c in df.columns])
    (out.write.mode("overwrite").option("header", True).option("escape", '"').option("quote", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(path))
