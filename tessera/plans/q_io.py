"""Source and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import evaluate as V
from tessera.plans.catalog import query, scored, subjects
from tessera.plans.views import with_views
from tessera.session import new_scratch_path
from tessera.sources.tables import table_path
from tessera.sources.csv import inferred_types, read_csv, read_text_columns, write_csv

SUBJECT_SCHEMA = ("subject_id bigint, label int, tier int, grp string, full_name string, age double, sibsp int, "
                  "parch int, fare double, cabin string, port string")
# How the CSV fixture spells missing values, per column (pandas NA tokens).
CSV_NULLS = {"age": "NA", "fare": "NaN", "cabin": "", "port": "N/A"}


@query("csv_scan_na", with_views("subjects") + "SELECT * FROM subjects")
def q_csv_scan(spark, sf):
    """Write the labelled table as CSV with NA tokens and quoted names, read it back typed."""
    path = new_scratch_path(spark, "subjects-csv")
    write_csv(subjects(spark, sf), path, CSV_NULLS)
    return read_csv(spark, path, SUBJECT_SCHEMA)


@query("csv_scan_multiline", with_views("subjects") + "SELECT * REPLACE (replace(full_name, ', ', ',' || chr(10)) AS full_name) FROM subjects")
def q_csv_multiline(spark, sf):
    """The labelled table as CSV with line feeds inside its names, read back in byte ranges."""
    path = new_scratch_path(spark, "subjects-csv")
    broken = F.replace(F.col("full_name"), F.lit(", "), F.lit(",\n"))
    write_csv(subjects(spark, sf).withColumn("full_name", broken), path, CSV_NULLS)
    return read_csv(spark, path, SUBJECT_SCHEMA, multi_line=True)


@query("csv_scan_texts", "SELECT doc_id, nullif(text, '') AS text, lang, source FROM documents")
def q_csv_texts(spark, sf):
    """Whole texts, line feeds and quotes among them, written as CSV and read back in byte ranges."""
    path = new_scratch_path(spark, "texts-csv")
    write_csv(spark.read.parquet(table_path(sf, "documents")).select("doc_id", "text", "lang", "source"), path)
    return read_csv(spark, path, "doc_id bigint, text string, lang string, source string", na_tokens=[], multi_line=True)


_COLUMNS = [c.split()[0] for c in SUBJECT_SCHEMA.split(", ")]
_TYPE_SQL = """SELECT '{c}' AS col_name, CASE WHEN count(*) = 0 THEN 'string' WHEN count(v) = 0 THEN 'double'
  WHEN bool_and(regexp_full_match(v, '[+-]?[0-9]+')) THEN CASE WHEN count(v) = count(*) THEN 'bigint' ELSE 'double' END
  WHEN bool_and(regexp_full_match(v, '[+-]?[0-9]+[.]?[0-9]*(e[+-]?[0-9]+)?')) THEN 'double'
  WHEN bool_and(lower(v) IN ('true', 'false')) THEN 'boolean' ELSE 'string' END AS type,
  count(*) - count(v) AS n_null FROM (SELECT CAST({c} AS VARCHAR) AS v FROM subjects)"""


@query("csv_infer_types", with_views("subjects") + "\nUNION ALL ".join(_TYPE_SQL.format(c=c) for c in _COLUMNS))
def q_csv_infer(spark, sf):
    """Types of the labelled table's CSV columns, inferred from all their texts in one pass."""
    path = new_scratch_path(spark, "subjects-csv")
    write_csv(subjects(spark, sf), path, CSV_NULLS)
    return inferred_types(read_text_columns(spark, path))


@query("csv_scan_inferred", with_views("subjects") + "SELECT * REPLACE (CAST(label AS BIGINT) AS label, CAST(tier AS BIGINT) AS tier, "
       "CAST(sibsp AS BIGINT) AS sibsp, CAST(parch AS BIGINT) AS parch) FROM subjects")
def q_csv_scan_inferred(spark, sf):
    """The labelled table's CSV read without a declared schema."""
    path = new_scratch_path(spark, "subjects-csv")
    write_csv(subjects(spark, sf), path, CSV_NULLS)
    return read_csv(spark, path)


@query("fairness_csv_roundtrip", with_views("scored") + """SELECT model, CASE WHEN grouping(grp) = 0 THEN concat('grp_', grp)
  ELSE concat('tier_', CAST(tier AS VARCHAR)) END AS subgroup,
  CASE WHEN count(*) = 0 THEN 0.0 ELSE CAST(count_if(label = pred) AS DOUBLE) / count(*) END AS accuracy,
  round(CASE WHEN 2 * count_if(label = 1 AND pred = 1) + count_if(label <> pred) = 0 THEN 0.0
    ELSE CAST(2 * count_if(label = 1 AND pred = 1) AS DOUBLE) / (2 * count_if(label = 1 AND pred = 1) + count_if(label <> pred)) END, 6) AS f1,
  count(*) AS n FROM scored GROUP BY GROUPING SETS ((model, grp), (model, tier))""")
def q_fairness_csv(spark, sf):
    path = new_scratch_path(spark, "fairness-csv")
    fa = V.fairness_audit(scored(spark, sf), ["model"], ["grp", "tier"]).withColumnRenamed("group", "subgroup")
    write_csv(fa, path)
    return read_csv(spark, path, "model string, subgroup string, accuracy double, f1 double, n bigint")
