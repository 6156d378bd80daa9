"""Projection, filter, schema and derived-feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import features as FF
from tessera.operators import prep
from tessera.operators import select as S
from tessera.plans.catalog import features, features_b, query, subjects
from tessera.plans.views import with_views
from tessera.sources import fixtures
from tessera.spec import AGE_EDGES, PRESET_A, PRESET_B

W_S = with_views("subjects")
W_F = with_views("features")
W_FB = with_views("features_b")

API_ORDER = ["tier", "grp", "age", "sibsp", "parch", "fare", "port", "title", "family_size", "is_alone", "age_group", "deck"]

TITLE_RAW_SQL = "nullif(regexp_extract(full_name, ' ([A-Za-z]+)\\.', 1), '')"
TITLE_SPLIT_SQL = "nullif(trim(split_part(split_part(full_name, ',', 2), '.', 1)), '')"


@query("title_regex", W_S + f"SELECT subject_id, full_name, {TITLE_RAW_SQL} AS title_raw FROM subjects")
def q_title_regex(spark, sf):
    s = subjects(spark, sf)
    return s.select("subject_id", "full_name", FF.title_regex("full_name").alias("title_raw"))


@query("title_map", W_F + "SELECT subject_id, title FROM features")
def q_title_map(spark, sf):
    s = subjects(spark, sf)
    return s.select("subject_id", FF.title_mapped("full_name", PRESET_A).alias("title"))


@query("title_split_variant", W_FB.rstrip() + f", r AS (SELECT subject_id, {TITLE_SPLIT_SQL} AS title_raw FROM subjects)\n"
       "SELECT f.subject_id, r.title_raw, f.title FROM features_b f JOIN r ON f.subject_id = r.subject_id")
def q_title_split(spark, sf):
    s = subjects(spark, sf)
    return s.select("subject_id", FF.title_split("full_name").alias("title_raw"),
                    FF.title_mapped("full_name", PRESET_B).alias("title"))


@query("family_features", W_F + "SELECT subject_id, family_size, is_alone FROM features")
def q_family(spark, sf):
    s = subjects(spark, sf)
    return s.select("subject_id", FF.family_size().alias("family_size"), FF.is_alone().alias("is_alone"))


def _band_idx_sql(right: bool) -> str:
    parts = []
    for i, (lo, hi) in enumerate(zip(AGE_EDGES[:-1], AGE_EDGES[1:])):
        cond = f"age > {lo} AND age <= {hi}" if right else f"age >= {lo} AND age < {hi}"
        parts.append(f"WHEN {cond} THEN {i}")
    return "CAST(CASE " + " ".join(parts) + " END AS DOUBLE)"


@query("bin_left_closed", W_F.rstrip() + f"\nSELECT subject_id, age, age_group, {_band_idx_sql(False)} AS band_idx FROM features")
def q_bin_left(spark, sf):
    s = subjects(spark, sf)
    return s.select("subject_id", "age", FF.age_group("age", PRESET_A).alias("age_group"),
                    FF.band_index("age", AGE_EDGES, False).cast("double").alias("band_idx"))


@query("bin_right_closed", W_FB.rstrip() + f"\nSELECT subject_id, age, age_group, {_band_idx_sql(True)} AS band_idx FROM features_b")
def q_bin_right(spark, sf):
    s = subjects(spark, sf)
    return s.select("subject_id", "age", FF.age_group("age", PRESET_B).alias("age_group"),
                    FF.band_index("age", AGE_EDGES, True).cast("double").alias("band_idx"))


@query("deck_first_char", W_F + "SELECT subject_id, deck FROM features")
def q_deck(spark, sf):
    return subjects(spark, sf).select("subject_id", FF.deck("cabin", PRESET_A.deck_default).alias("deck"))


@query("deck_variant", W_FB + "SELECT subject_id, deck FROM features_b")
def q_deck_b(spark, sf):
    return subjects(spark, sf).select("subject_id", FF.deck("cabin", PRESET_B.deck_default).alias("deck"))


@query("fare_per_person", W_FB + "SELECT subject_id, round(fare_per_person, 6) AS fare_per_person FROM features_b")
def q_fpp(spark, sf):
    s = subjects(spark, sf)
    return s.select("subject_id", F.round(FF.fare_per_person("fare"), 6).alias("fare_per_person"))


@query("feature_frame", W_F + "SELECT * FROM features")
def q_feature_frame(spark, sf):
    return features(spark, sf)


# Whole-table fills of the dashboard variant (fit on all rows, before any split).
_VARIANT_SQL = W_FB.rstrip() + """,
st AS (SELECT quantile_cont(age, 0.5) AS age_med, quantile_cont(fare, 0.5) AS fare_med FROM features_b),
pm AS (SELECT port AS port_mode FROM features_b WHERE port IS NOT NULL GROUP BY port ORDER BY count(*) DESC, port LIMIT 1)
SELECT subject_id, label, tier, grp, coalesce(age, age_med) AS age, sibsp, parch, coalesce(fare, fare_med) AS fare,
  coalesce(port, port_mode) AS port, title, family_size, is_alone, age_group, deck, fare_per_person
FROM features_b CROSS JOIN st CROSS JOIN pm"""


@query("feature_frame_variant", _VARIANT_SQL)
def q_feature_frame_variant(spark, sf):
    fb = features_b(spark, sf)
    return prep.impute_whole_table(fb, median_cols=["age", "fare"], mode_cols=["port"])


@query("drop_unused", W_S + "SELECT subject_id, label, tier, grp, age, sibsp, parch, fare, port FROM subjects")
def q_drop(spark, sf):
    return S.drop_columns(subjects(spark, sf), ["full_name", "cabin", "ticket"])


@query("feature_order", W_F + f"SELECT {', '.join(API_ORDER)} FROM features")
def q_feature_order(spark, sf):
    return S.select_order(features(spark, sf), API_ORDER)


@query("filter_mask", W_F + "SELECT * FROM features WHERE grp = 'BUILDING' AND tier = 1 AND age IS NOT NULL")
def q_filter_mask(spark, sf):
    f = features(spark, sf)
    return f.filter((F.col("grp") == "BUILDING") & (F.col("tier") == 1) & F.col("age").isNotNull())


_FEAT_TYPES = [("subject_id", "bigint"), ("label", "int"), ("tier", "int"), ("grp", "string"), ("age", "double"),
               ("sibsp", "int"), ("parch", "int"), ("fare", "double"), ("port", "string"), ("title", "string"),
               ("family_size", "int"), ("is_alone", "int"), ("age_group", "string"), ("deck", "string")]
_SUBJ_TYPES = [("subject_id", "bigint"), ("label", "int"), ("tier", "int"), ("grp", "string"),
               ("full_name", "string"), ("age", "double"), ("sibsp", "int"), ("parch", "int"),
               ("fare", "double"), ("cabin", "string"), ("port", "string")]


def _schema_rows_sql(view: str, cols: list[tuple[str, str]]) -> str:
    m = ("CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' "
         "WHEN 'DOUBLE' THEN 'double' ELSE lower(typeof({c})) END")
    return "\nUNION ALL\n".join(f"(SELECT '{c}' AS col_name, {m.format(c=c)} AS dtype FROM {view} LIMIT 1)" for c, _ in cols)


@query("schema_diff", W_F.rstrip() +
       f",\nl AS ({_schema_rows_sql('subjects', _SUBJ_TYPES)}),\nr AS ({_schema_rows_sql('features', _FEAT_TYPES)})\n"
       "SELECT col_name, dtype, 'left_only' AS side FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r) a\n"
       "UNION ALL SELECT col_name, dtype, 'right_only' AS side FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l) b")
def q_schema_diff(spark, sf):
    return S.schema_diff(subjects(spark, sf), features(spark, sf))


@query("validate_enums", W_S + "SELECT subject_id, lower(grp) AS grp_lc, upper(port) AS port_uc, "
       "lower(grp) IN ('automobile', 'building', 'furniture', 'household', 'machinery') AS grp_ok, "
       "coalesce(upper(port) IN ('C', 'Q', 'S'), false) AS port_ok FROM subjects")
def q_validate_enums(spark, sf):
    s = subjects(spark, sf)
    return s.select("subject_id", F.lower("grp").alias("grp_lc"), F.upper("port").alias("port_uc"),
                    F.lower("grp").isin("automobile", "building", "furniture", "household", "machinery").alias("grp_ok"),
                    F.coalesce(F.upper("port").isin("C", "Q", "S"), F.lit(False)).alias("port_ok"))


_RUN_PARAMS = with_views("runs", extra=[("run_params", fixtures.RUN_PARAMS_SQL)])


@query("param_key_strip", _RUN_PARAMS + "SELECT run_id, regexp_replace(key, '^classifier__', '') AS key, value FROM run_params")
def q_param_strip(spark, sf):
    p = fixtures.run_params(spark, sf)
    return p.select("run_id", S.strip_prefix("key", "classifier__").alias("key"), "value")


@query("grid_expand", _RUN_PARAMS + """, p AS (SELECT regexp_replace(key, '^classifier__', '') AS key, value FROM run_params),
n AS (SELECT DISTINCT value AS n FROM p WHERE key = 'n_estimators'),
l AS (SELECT DISTINCT value AS lr FROM p WHERE key = 'learning_rate'),
d AS (SELECT DISTINCT value AS d FROM p WHERE key = 'max_depth')
SELECT concat('GB_n', n, '_lr', lr, '_d', d) AS run_name, CAST(n AS INT) AS n_estimators,
  CAST(lr AS DOUBLE) AS learning_rate, CAST(d AS INT) AS max_depth FROM n CROSS JOIN l CROSS JOIN d""")
def q_grid_expand(spark, sf):
    p = fixtures.run_params(spark, sf).select(S.strip_prefix("key", "classifier__").alias("key"), "value")
    grid = S.param_grid(p, ["n_estimators", "learning_rate", "max_depth"])
    return grid.select(
        F.concat(F.lit("GB_n"), "n_estimators", F.lit("_lr"), "learning_rate", F.lit("_d"), "max_depth").alias("run_name"),
        F.col("n_estimators").cast("int").alias("n_estimators"),
        F.col("learning_rate").cast("double").alias("learning_rate"),
        F.col("max_depth").cast("int").alias("max_depth"))
