"""Validation, defaults and scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import features as FF
from tessera.operators import score as X
from tessera.plans.catalog import query, scored, subjects
from tessera.plans.views import with_views
from tessera.sources import fixtures
from tessera.sources.tables import read_table, table_path
from tessera.spec import PRESET_A, SUBJECT_GROUPS
from tessera.streaming import score_stream

W_F = with_views("features")
_GROUPS_SQL = ", ".join(f"'{g.lower()}'" for g in SUBJECT_GROUPS)
_RULES_SQL = [
    ("tier_missing", "tier IS NULL"), ("tier_range", "tier < 1 OR tier > 3"), ("grp_missing", "grp IS NULL"),
    ("grp_value", f"lower(grp) NOT IN ({_GROUPS_SQL})"), ("age_missing", "age IS NULL"),
    ("age_range", "age < 0 OR age > 100"), ("sibsp_negative", "sibsp < 0"), ("parch_negative", "parch < 0"),
    ("fare_missing", "fare IS NULL"), ("fare_negative", "fare < 0"),
    ("port_value", "port IS NOT NULL AND upper(port) NOT IN ('C', 'Q', 'S')"),
]
VALID_WHERE = " AND ".join(f"NOT coalesce({c}, false)" for _, c in _RULES_SQL)
_REQ = "req AS (SELECT subject_id, tier, grp, age, sibsp, parch, fare, port, title FROM features)"
_VALID = f"v AS (SELECT subject_id, tier, lower(grp) AS grp, age, sibsp, parch, fare, upper(port) AS port, title " \
         f"FROM req WHERE {VALID_WHERE})"
_DEFAULTS = """d AS (SELECT subject_id, coalesce(sibsp, 0) AS sibsp, coalesce(parch, 0) AS parch, coalesce(port, 'S') AS port,
  coalesce(title, 'Mr') AS title, CAST(coalesce(sibsp, 0) + coalesce(parch, 0) + 1 AS INT) AS family_size,
  CAST(CASE WHEN coalesce(sibsp, 0) + coalesce(parch, 0) + 1 = 1 THEN 1 ELSE 0 END AS INT) AS is_alone,
  coalesce(CASE WHEN age >= 0 AND age < 12 THEN 'Child' WHEN age >= 12 AND age < 18 THEN 'Teen'
       WHEN age >= 18 AND age < 35 THEN 'Young Adult' WHEN age >= 35 AND age < 60 THEN 'Adult'
       WHEN age >= 60 AND age < 100 THEN 'Senior' END, 'Adult') AS age_group, 'U' AS deck, grp, tier, age, fare FROM v)"""


def _w(*ctes: str) -> str:
    return W_F.rstrip() + ",\n" + ",\n".join(ctes) + "\n"


def requests(spark, sf):
    """Score requests: the raw request fields of each subject (title parsed from the name)."""
    s = subjects(spark, sf)
    return s.select("subject_id", "tier", "grp", "age", "sibsp", "parch", "fare", "port",
                    FF.title_mapped("full_name", PRESET_A).alias("title"))


def rules():
    return X.default_rules(SUBJECT_GROUPS)


@query("validate_rows", _w(_REQ, _VALID) + "SELECT * FROM v")
def q_validate(spark, sf):
    return X.valid_rows(requests(spark, sf), rules())


@query("rejected_rows", _w(_REQ) + "SELECT subject_id, concat_ws(',', " +
       ", ".join(f"CASE WHEN {c} THEN '{k}' END" for k, c in _RULES_SQL) + ") AS reasons, CAST(" +
       " + ".join(f"(CASE WHEN {c} THEN 1 ELSE 0 END)" for _, c in _RULES_SQL) + " AS INT) AS n_reasons FROM req WHERE NOT (" +
       VALID_WHERE + ")")
def q_rejected(spark, sf):
    return X.rejected_rows(requests(spark, sf), rules())


@query("serve_defaults", _w(_REQ, _VALID, _DEFAULTS) +
       "SELECT subject_id, sibsp, parch, port, title, family_size, is_alone, age_group, deck FROM d")
def q_defaults(spark, sf):
    v = X.valid_rows(requests(spark, sf), rules())
    d = X.apply_defaults(v, PRESET_A, mode="derive")
    return d.select("subject_id", "sibsp", "parch", "port", "title", "family_size", "is_alone", "age_group", "deck")


@query("score_verdict", with_views("scored") + "SELECT model, subject_id, round(score, 4) AS probability, "
       "CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred, "
       "CASE WHEN score >= 0.5 THEN 'Survived' ELSE 'Did not survive' END AS verdict FROM scored")
def q_score_verdict(spark, sf):
    s = scored(spark, sf)
    return s.select("model", "subject_id", *X.verdict(F.col("score")))


# The stream is scored by the stand-in 'logistic' model of the scored view (integer arithmetic).
_STANDIN = dict((m, (k, lift)) for m, k, lift in fixtures.STANDIN_MODELS)["logistic"]


_STREAM_SQL = with_views("subjects", "features").rstrip() + ",\n" + ",\n".join([_REQ, _VALID, _DEFAULTS]) + \
    f""",
sc AS (SELECT d.subject_id, d.title, d.age_group, d.port, d.grp,
  CAST((d.subject_id * {_STANDIN[0]}) % (101 - {_STANDIN[1]}) + {_STANDIN[1]} * s.label AS DOUBLE) / 100 AS score
  FROM d JOIN subjects s ON d.subject_id = s.subject_id)
SELECT subject_id, title, age_group, port, grp, round(score, 4) AS probability, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred,
  CASE WHEN score >= 0.5 THEN 'Survived' ELSE 'Did not survive' END AS verdict FROM sc"""


@query("stream_score", _STREAM_SQL)
def q_stream_score(spark, sf):
    """Orders arrive as a file stream; each micro-batch joins the static customer table,
    derives the request, validates, fills defaults and scores. Output = batch result."""
    return score_stream.run_available(spark, order_stream(spark, sf),
                                      lambda s: stand_in_scores(X.valid_rows(stream_requests(spark, sf, s), rules())), name="stream_score")


def order_stream(spark, sf, max_files_per_trigger=None):
    return score_stream.file_stream(spark, table_path(sf, "orders").replace("orders.parquet", "orders*.parquet"),
                                    fixtures.ORDER_SCHEMA, max_files_per_trigger)


def stream_requests(spark, sf, orders):
    """Score requests of orders as they arrive, each with its customer's group."""
    customer = read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment"])
    s = fixtures.subjects_from(orders.select(*fixtures.ORDER_COLS), customer)
    return s.select("subject_id", "label", "tier", "grp", "age", "sibsp", "parch", "fare", "port",
                    FF.title_mapped("full_name", PRESET_A).alias("title"))


def stand_in_scores(valid):
    d = X.apply_defaults(valid, PRESET_A, mode="derive")
    k, lift = _STANDIN
    score = ((F.col("subject_id") * k) % (101 - lift) + lift * F.col("label")).cast("double") / 100
    return d.select("subject_id", "title", "age_group", "port", "grp", *X.verdict(score))


@query("stream_rejects", _STREAM_SQL.rsplit("SELECT", 1)[0].rstrip() + ",\nrej AS (SELECT subject_id, concat_ws(',', " +
       ", ".join(f"CASE WHEN {c} THEN '{k}' END" for k, c in _RULES_SQL) + f""") AS reasons FROM req WHERE NOT ({VALID_WHERE}))
SELECT subject_id, 'scored' AS sink, round(score, 4) AS probability,
  CASE WHEN score >= 0.5 THEN 'Survived' ELSE 'Did not survive' END AS outcome FROM sc
UNION ALL SELECT subject_id, 'rejected', NULL, reasons FROM rej""")
def q_stream_rejects(spark, sf):
    """The same stream with a table for scored and one for rejected rows: every order lands in exactly one of them."""
    split = score_stream.checked_parts(rules(), stand_in_scores)
    t = score_stream.run_available_parts(spark, order_stream(spark, sf), lambda b: split(stream_requests(spark, sf, b)), name="stream_rejects")
    scored_rows = t["scored"].select("subject_id", F.lit("scored").alias("sink"), "probability", F.col("verdict").alias("outcome"))
    return scored_rows.union(t["rejected"].select("subject_id", F.lit("rejected"), F.lit(None).cast("double"), "reasons"))
