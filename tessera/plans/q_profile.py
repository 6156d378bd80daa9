"""Profiling queries (P1-P21) over the labelled table."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tessera.operators import profile as P
from tessera.plans.catalog import features, query, subjects
from tessera.plans.views import with_views

SUBJECT_COLS = [("subject_id", "bigint"), ("label", "int"), ("tier", "int"), ("grp", "string"),
                ("full_name", "string"), ("age", "double"), ("sibsp", "int"), ("parch", "int"),
                ("fare", "double"), ("cabin", "string"), ("port", "string")]
DESCRIBE_COLS = ["age", "fare", "sibsp", "parch"]
CORR_COLS = ["label", "tier", "age", "sibsp", "parch", "fare"]
AGE_HIST_EDGES = [float(x) for x in range(0, 85, 5)]
W_S = with_views("subjects")
W_F = with_views("features")


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


@query("profile_shape", W_S + "SELECT count(*) AS n_rows, 11 AS n_cols FROM subjects")
def q_shape(spark, sf):
    return P.shape(subjects(spark, sf))


def _duck_type(col: str) -> str:
    """DuckDB type name of a column, spelled as Spark's simpleString."""
    t = f"typeof({col})"
    return (f"CASE {t} WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' "
            f"WHEN 'DOUBLE' THEN 'double' ELSE lower({t}) END")


@query("profile_dtypes", W_S + _union([
    f"(SELECT CAST({i + 1} AS INT) AS ordinal, '{c}' AS col_name, {_duck_type(c)} "
    f"AS dtype FROM subjects LIMIT 1)" for i, (c, _) in enumerate(SUBJECT_COLS)]))
def q_dtypes(spark, sf):
    return P.dtypes(subjects(spark, sf))


@query("profile_head", W_S + "SELECT * FROM subjects ORDER BY subject_id LIMIT 5")
def q_head(spark, sf):
    return P.head(subjects(spark, sf), ["subject_id"], 5)


@query("profile_info", W_S + _union([
    f"SELECT '{c}' AS col_name, count({c}) AS non_null, '{t}' AS dtype FROM subjects" for c, t in SUBJECT_COLS]))
def q_info(spark, sf):
    return P.info(subjects(spark, sf))


_NULLS = [f"SELECT '{c}' AS col_name, CAST(count(*) - count({c}) AS BIGINT) AS n_null FROM subjects"
          for c, _ in SUBJECT_COLS]


@query("profile_nulls", W_S + _union(_NULLS))
def q_nulls(spark, sf):
    return P.null_counts(subjects(spark, sf))


@query("profile_nulls_ranked", W_S + "SELECT * FROM (" + _union(_NULLS) + ") x WHERE n_null > 0 ORDER BY n_null DESC, col_name")
def q_nulls_ranked(spark, sf):
    return P.nulls_ranked(subjects(spark, sf))


@query("profile_null_frac", W_S + _union([
    f"SELECT '{c}' AS col_name, CAST(count(*) - count({c}) AS BIGINT) AS n_null, "
    f"round(CAST(count(*) - count({c}) AS DOUBLE) / count(*), 6) AS null_frac FROM subjects" for c, _ in SUBJECT_COLS]))
def q_null_frac(spark, sf):
    return P.null_fraction(subjects(spark, sf))


@query("profile_describe", W_S + _union([
    f"SELECT '{c}' AS col_name, count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 6) AS mean, "
    f"round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, "
    f"round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50, "
    f"round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM subjects"
    for c in DESCRIBE_COLS]))
def q_describe(spark, sf):
    return P.describe(subjects(spark, sf), DESCRIBE_COLS)


@query("value_counts", W_F + "SELECT title AS value, count(*) AS n FROM features WHERE title IS NOT NULL GROUP BY title")
def q_value_counts(spark, sf):
    return P.value_counts(features(spark, sf), "title")


@query("value_counts_with_null", W_F + "SELECT age_group AS value, count(*) AS n FROM features GROUP BY age_group")
def q_value_counts_null(spark, sf):
    return P.value_counts(features(spark, sf), "age_group", dropna=False)


@query("class_balance", W_S + "SELECT label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share "
       "FROM subjects WHERE label IS NOT NULL GROUP BY label")
def q_class_balance(spark, sf):
    return P.normalised_counts(subjects(spark, sf), "label")


@query("rate_overall", W_S + "SELECT count(*) AS n, round(avg(label), 6) AS rate FROM subjects")
def q_rate_overall(spark, sf):
    return P.rate(subjects(spark, sf), "label")


def _rate_sql(k):
    return W_S + f"SELECT {k}, count(*) AS n, round(avg(label), 6) AS rate FROM subjects WHERE {k} IS NOT NULL GROUP BY {k}"


@query("rate_by_tier", _rate_sql("tier"))
def q_rate_by_tier(spark, sf):
    return P.rate(subjects(spark, sf), "label", ["tier"])


@query("rate_by_group", _rate_sql("grp"))
def q_rate_by_group(spark, sf):
    return P.rate(subjects(spark, sf), "label", ["grp"])


@query("rate_by_port", _rate_sql("port"))
def q_rate_by_port(spark, sf):
    return P.rate(subjects(spark, sf), "label", ["port"])


@query("rate_grouping_sets", W_S + "SELECT CAST(tier AS VARCHAR) AS tier, grp, port, grouping_id(tier, grp, port) AS gid, count(*) AS n, "
       "round(avg(label), 6) AS rate FROM subjects GROUP BY GROUPING SETS ((), (tier), (grp), (port))")
def q_rate_gs(spark, sf):
    s = subjects(spark, sf).withColumn("tier", F.col("tier").cast("string"))
    return P.rate_grouping_sets(s, "label", ["tier", "grp", "port"])


def _corr_sql():
    parts = []
    for a, b in combinations(CORR_COLS, 2):
        expr = f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6)"
        parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {expr} AS r FROM subjects")
        parts.append(f"SELECT '{b}' AS a, '{a}' AS b, {expr} AS r FROM subjects")
    parts += [f"SELECT '{c}' AS a, '{c}' AS b, CAST(1.0 AS DOUBLE) AS r" for c in CORR_COLS]
    return W_S + _union(parts)


@query("corr_matrix", _corr_sql())
def q_corr(spark, sf):
    return P.corr_matrix(subjects(spark, sf), CORR_COLS)


@query("label_counts", W_S + "SELECT label, count(*) AS n FROM subjects GROUP BY label")
def q_label_counts(spark, sf):
    return P.facet_counts(subjects(spark, sf), ["label"])


def _hist_sql():
    nb = len(AGE_HIST_EDGES) - 1
    parts = []
    for i in range(nb):
        lo, hi = AGE_HIST_EDGES[i], AGE_HIST_EDGES[i + 1]
        cond = f"age >= {lo} AND " + (f"age <= {hi}" if i == nb - 1 else f"age < {hi}")
        parts.append(f"SELECT label, CAST({lo} AS DOUBLE) AS bin_lo, CAST({hi} AS DOUBLE) AS bin_hi, "
                     f"CAST(count_if({cond}) AS BIGINT) AS n FROM subjects WHERE label IS NOT NULL GROUP BY label")
    return W_S + _union(parts)


@query("hist_fixed_by_label", _hist_sql())
def q_hist_fixed(spark, sf):
    return P.hist_fixed(subjects(spark, sf), "age", AGE_HIST_EDGES, "label")


@query("hist_log_by_label", W_S + """, lv AS (SELECT label, log10(fare) AS lv FROM subjects WHERE fare > 0 AND label IS NOT NULL),
st AS (SELECT min(lv) AS lo, max(lv) AS hi FROM lv),
b AS (SELECT label, least(greatest(CAST(floor((lv - lo) / CASE WHEN hi > lo THEN (hi - lo) / 30 ELSE 1.0 END) AS INT), 0), 29) AS bin,
  lo, (hi - lo) / 30 AS width FROM lv CROSS JOIN st)
SELECT label, bin, round(lo + bin * width, 6) AS bin_lo, round(lo + (bin + 1) * width, 6) AS bin_hi, count(*) AS n
FROM b GROUP BY label, bin, lo, width""")
def q_hist_log(spark, sf):
    return P.hist_log(subjects(spark, sf), "fare", 30, "label")


@query("facet_counts", W_S + "SELECT tier, grp, label, count(*) AS n FROM subjects GROUP BY tier, grp, label")
def q_facet_counts(spark, sf):
    return P.facet_counts(subjects(spark, sf), ["tier", "grp", "label"])


@query("facet_cube", W_S + "SELECT tier, grp, label, grouping_id(tier, grp, label) AS gid, count(*) AS n "
       "FROM (SELECT CAST(tier AS VARCHAR) AS tier, grp, CAST(label AS VARCHAR) AS label FROM subjects) s "
       "GROUP BY CUBE (tier, grp, label)")
def q_facet_cube(spark, sf):
    s = subjects(spark, sf).select(F.col("tier").cast("string").alias("tier"), "grp",
                                   F.col("label").cast("string").alias("label"))
    return P.facet_cube(s, ["tier", "grp", "label"])


@query("distinct_values", W_S + "SELECT DISTINCT grp AS value FROM subjects")
def q_distinct(spark, sf):
    return P.distinct_values(subjects(spark, sf), "grp")


@query("format_percent", W_S + "SELECT tier, printf('%.2f%%', avg(label) * 100) AS rate_pct FROM subjects "
       "WHERE tier IS NOT NULL GROUP BY tier")
def q_format_percent(spark, sf):
    s = subjects(spark, sf).dropna(subset=["tier"])
    return s.groupBy("tier").agg(P.format_percent(F.avg("label")).alias("rate_pct"))
