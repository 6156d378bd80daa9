"""Imputation, scaling and encoding queries (I1-I5, E1-E4): fitted on the training split."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.operators import prep as I
from tessera.plans.catalog import query, split_table, subjects
from tessera.plans.views import with_views
from tessera.spec import PRESET_A

NUMERIC = list(PRESET_A.numeric)
CATEGORICAL = list(PRESET_A.categorical)
W_FS = with_views("features", "split", extra=[
    ("fs", "SELECT f.*, s.split FROM features f JOIN split s ON f.subject_id = s.subject_id")])


def split_features(spark, sf):
    return split_table(spark, sf)


@query("impute_median", W_FS.rstrip() + """,
m AS (SELECT quantile_cont(age, 0.5) AS age_m, quantile_cont(fare, 0.5) AS fare_m FROM fs WHERE split = 'train')
SELECT subject_id, split, coalesce(age, age_m) AS age, coalesce(fare, fare_m) AS fare FROM fs CROSS JOIN m""")
def q_impute_median(spark, sf):
    fs = split_features(spark, sf)
    med = I.fit_medians(fs.filter(F.col("split") == "train"), ["age", "fare"])
    return I.fill(fs, med).select("subject_id", "split", "age", "fare")


@query("impute_mode", W_FS.rstrip() + """,
pm AS (SELECT port AS port_m FROM fs WHERE split = 'train' AND port IS NOT NULL GROUP BY port ORDER BY count(*) DESC, port LIMIT 1),
am AS (SELECT age_group AS age_group_m FROM fs WHERE split = 'train' AND age_group IS NOT NULL GROUP BY age_group
       ORDER BY count(*) DESC, age_group LIMIT 1)
SELECT subject_id, split, coalesce(port, port_m) AS port, coalesce(age_group, age_group_m) AS age_group
FROM fs CROSS JOIN pm CROSS JOIN am""")
def q_impute_mode(spark, sf):
    fs = split_features(spark, sf)
    modes = I.fit_modes(fs.filter(F.col("split") == "train"), ["port", "age_group"])
    return I.fill(fs, modes).select("subject_id", "split", "port", "age_group")


@query("impute_whole_table", with_views("subjects") + """, m AS (SELECT quantile_cont(age, 0.5) AS age_m,
  quantile_cont(fare, 0.5) AS fare_m FROM subjects),
pm AS (SELECT port AS port_m FROM subjects WHERE port IS NOT NULL GROUP BY port ORDER BY count(*) DESC, port LIMIT 1)
SELECT subject_id, coalesce(age, age_m) AS age, coalesce(fare, fare_m) AS fare, coalesce(port, port_m) AS port
FROM subjects CROSS JOIN m CROSS JOIN pm""")
def q_impute_whole(spark, sf):
    s = subjects(spark, sf).select("subject_id", "age", "fare", "port")
    return I.impute_whole_table(s, ["age", "fare"], ["port"])


@query("impute_group_median", W_FS.rstrip() + """,
gm AS (SELECT title, tier, quantile_cont(age, 0.5) AS g_m FROM fs WHERE split = 'train' GROUP BY title, tier),
m AS (SELECT quantile_cont(age, 0.5) AS age_m FROM fs WHERE split = 'train')
SELECT fs.subject_id, round(coalesce(fs.age, gm.g_m, m.age_m), 6) AS age
FROM fs LEFT JOIN gm ON fs.title = gm.title AND fs.tier = gm.tier CROSS JOIN m""")
def q_impute_group(spark, sf):
    fs = split_features(spark, sf)
    out = I.group_median_fill(fs, "age", ["title", "tier"], fit_on=fs.filter(F.col("split") == "train"))
    return out.select("subject_id", F.round("age", 6).alias("age"))


_STD_SQL = W_FS.rstrip() + """,
m AS (SELECT quantile_cont(age, 0.5) AS age_m, quantile_cont(fare, 0.5) AS fare_m FROM fs WHERE split = 'train'),
x AS (SELECT subject_id, split, coalesce(age, age_m) AS age, coalesce(fare, fare_m) AS fare,
  CAST(sibsp AS DOUBLE) AS sibsp, CAST(parch AS DOUBLE) AS parch, CAST(family_size AS DOUBLE) AS family_size
  FROM fs CROSS JOIN m),
st AS (SELECT avg(age) AS a_m, stddev_pop(age) AS a_s, avg(fare) AS f_m, stddev_pop(fare) AS f_s,
  avg(sibsp) AS s_m, stddev_pop(sibsp) AS s_s, avg(parch) AS p_m, stddev_pop(parch) AS p_s,
  avg(family_size) AS z_m, stddev_pop(family_size) AS z_s FROM x WHERE split = 'train')
SELECT subject_id, round((age - a_m) / CASE WHEN a_s = 0 THEN 1 ELSE a_s END, 6) AS age,
  round((fare - f_m) / CASE WHEN f_s = 0 THEN 1 ELSE f_s END, 6) AS fare,
  round((sibsp - s_m) / CASE WHEN s_s = 0 THEN 1 ELSE s_s END, 6) AS sibsp,
  round((parch - p_m) / CASE WHEN p_s = 0 THEN 1 ELSE p_s END, 6) AS parch,
  round((family_size - z_m) / CASE WHEN z_s = 0 THEN 1 ELSE z_s END, 6) AS family_size
FROM x CROSS JOIN st"""


@query("standardise", _STD_SQL)
def q_standardise(spark, sf):
    fs = split_features(spark, sf)
    train = fs.filter(F.col("split") == "train")
    imp = I.ExactImputer(inputCols=NUMERIC, strategy="median").fit(train)
    filled = imp.transform(fs).withColumns({c: F.col(c).cast("double") for c in NUMERIC})
    sc = I.PopulationScaler(inputCols=NUMERIC).fit(filled.filter(F.col("split") == "train"))
    out = sc.transform(filled)
    return out.select("subject_id", *[F.round(c, 6).alias(c) for c in NUMERIC])


def _cat_sql_parts():
    """Training categories per column (after mode fill), as (col_name, value)."""
    parts = []
    for c in CATEGORICAL:
        parts.append(
            f"SELECT '{c}' AS col_name, CAST(coalesce(CAST({c} AS VARCHAR), (SELECT CAST({c} AS VARCHAR) FROM fs "
            f"WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 1)) AS VARCHAR) AS value, "
            f"subject_id, split FROM fs")
    return "\nUNION ALL\n".join(parts)


_CATS = W_FS.rstrip() + f",\nlongv AS ({_cat_sql_parts()}),\ncats AS (SELECT DISTINCT col_name, value FROM longv WHERE split = 'train')\n"


@query("onehot_long", _CATS + "SELECT l.subject_id, concat(l.col_name, '_', l.value) AS feature FROM longv l "
       "JOIN cats c ON l.col_name = c.col_name AND l.value = c.value")
def q_onehot_long(spark, sf):
    fs = split_features(spark, sf)
    model = I.preprocessor(NUMERIC, CATEGORICAL).fit(fs.filter(F.col("split") == "train"))
    out = model.transform(fs)
    # active one-hot slots: category index below the number of known labels
    recs = []
    from pyspark.ml.feature import StringIndexerModel
    si = [s for s in model.stages if isinstance(s, StringIndexerModel)][0]
    for c, labels in zip(CATEGORICAL, si.labelsArray):
        lab = F.array(*[F.lit(f"{c}_{v}") for v in labels])
        idx = F.col(c + "__i").cast("int")
        recs.append(F.when(idx < len(labels), F.element_at(lab, idx + 1)))
    return out.select("subject_id", F.explode(F.filter(F.array(*recs), lambda x: x.isNotNull())).alias("feature"))


_ORDER = ", ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(CATEGORICAL))


@query("encoded_names", _CATS + f"""SELECT CAST(position AS INT) AS position, feature_name FROM (
  SELECT {len(NUMERIC)} + row_number() OVER (ORDER BY CASE col_name {_ORDER.replace(',', '')} END, value) AS position,
    concat(col_name, '_', value) AS feature_name FROM cats
  UNION ALL {' UNION ALL '.join(f"SELECT {i + 1}, '{c}'" for i, c in enumerate(NUMERIC))}) z""")
def q_encoded_names(spark, sf):
    fs = split_features(spark, sf)
    model = I.preprocessor(NUMERIC, CATEGORICAL).fit(fs.filter(F.col("split") == "train"))
    names = I.encoded_names(model, NUMERIC, CATEGORICAL)
    # the names are model metadata (one per vector slot); as a table, anchored on the fitted rows
    rows = [(i + 1, n) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "position int, feature_name string")


def _assembled_sql():
    """Assembled vector = standardised numerics, then one slot per training category (1 if
    the row's filled value is a training category, else all zeros): its non-zero count
    and sum from the standardise and category CTEs."""
    head = W_FS.rstrip()
    std_ctes = _STD_SQL[len(head):_STD_SQL.index("\nSELECT subject_id, round(")]
    cat_ctes = _CATS[len(head):].rstrip()
    z = ", ".join(f"({c} - {m}_m) / CASE WHEN {m}_s = 0 THEN 1 ELSE {m}_s END AS {c}"
                  for c, m in zip(NUMERIC, ("a", "f", "s", "p", "z")))
    nz = " + ".join(f"CASE WHEN z.{c} <> 0 THEN 1 ELSE 0 END" for c in NUMERIC)
    total = " + ".join(f"z.{c}" for c in NUMERIC)
    return head + std_ctes + cat_ctes + f""",
z AS (SELECT subject_id, split, {z} FROM x CROSS JOIN st),
k AS (SELECT l.subject_id, count(*) AS n_known FROM longv l JOIN cats c ON l.col_name = c.col_name AND l.value = c.value
  GROUP BY l.subject_id)
SELECT z.subject_id, z.split, CAST({nz} + coalesce(k.n_known, 0) AS INT) AS n_nonzero,
  round({total} + coalesce(k.n_known, 0), 6) AS row_sum
FROM z LEFT JOIN k ON z.subject_id = k.subject_id"""


@query("assembled_vectors", _assembled_sql())
def q_assembled(spark, sf):
    fs = split_features(spark, sf)
    model = I.preprocessor(NUMERIC, CATEGORICAL).fit(fs.filter(F.col("split") == "train"))
    out = model.transform(fs)
    arr = vector_to_array("features")
    return out.select("subject_id", "split", F.size(F.filter(arr, lambda x: x != 0)).alias("n_nonzero"),
                      F.round(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x), 6).alias("row_sum"))
