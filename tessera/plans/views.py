"""SQL text of the stand-in views, valid in both Spark SQL and DuckDB.

Oracle queries only see the base tables, so each one carries the views it needs as a
leading ``WITH``; :func:`with_views` assembles that prefix (dependencies first).
"""

from __future__ import annotations

SUBJECTS = """SELECT o.o_orderkey AS subject_id,
  CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
  CASE WHEN substring(o.o_orderpriority,1,1) = '1' THEN 1
       WHEN substring(o.o_orderpriority,1,1) IN ('2','3') THEN 2 ELSE 3 END AS tier,
  c.c_mktsegment AS grp,
  concat('Doe', CAST(o.o_custkey AS VARCHAR(20)), ', ',
    CASE CAST(o.o_orderkey % 12 AS INT) WHEN 0 THEN 'Miss' WHEN 1 THEN 'Mrs' WHEN 2 THEN 'Master' WHEN 3 THEN 'Ms'
      WHEN 4 THEN 'Mlle' WHEN 5 THEN 'Dr' WHEN 6 THEN 'Prof' ELSE 'Mr' END,
    CASE WHEN o.o_orderkey % 50 = 7 THEN ' Pat' ELSE '. Pat' END) AS full_name,
  CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE CAST(o.o_custkey % 101 AS DOUBLE) END AS age,
  CAST(o.o_orderkey % 4 AS INT) AS sibsp,
  CAST(o.o_custkey % 3 AS INT) AS parch,
  CASE WHEN o.o_orderkey % 891 = 0 THEN NULL ELSE o.o_totalprice END AS fare,
  CASE WHEN o.o_orderkey % 4 <> 0 THEN NULL
       ELSE concat(substring('ABCDEFGT', CAST(1 + o.o_custkey % 8 AS INT), 1), CAST(o.o_custkey AS VARCHAR(20))) END AS cabin,
  CASE WHEN o.o_orderkey % 445 = 0 THEN NULL WHEN o.o_orderkey % 10 < 7 THEN 'S'
       WHEN o.o_orderkey % 10 < 9 THEN 'C' ELSE 'Q' END AS port
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""

SCORED = """WITH m AS (SELECT 'logistic' AS model, 7919 AS k, 30 AS lift UNION ALL SELECT 'forest', 6101, 20
  UNION ALL SELECT 'boosted', 5003, 10),
s AS (SELECT m.model, u.subject_id, u.label, u.tier, u.grp,
        CAST((u.subject_id * m.k) % (101 - m.lift) + m.lift * u.label AS DOUBLE) / 100 AS score
      FROM subjects u CROSS JOIN m)
SELECT model, subject_id, label, tier, grp, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred FROM s"""

RUNS = """SELECT s_suppkey AS run_id, concat('run_', CAST(s_suppkey AS VARCHAR(20))) AS run_name,
  CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_suppkey - s_suppkey % 4 END AS parent_run_id
FROM supplier"""

RUN_METRICS = """WITH k AS (SELECT 'accuracy' AS metric, 37 AS a UNION ALL SELECT 'f1_macro', 53
  UNION ALL SELECT 'roc_auc', 71 UNION ALL SELECT 'train_time_s', 29),
t AS (SELECT 0 AS ts UNION ALL SELECT 1)
SELECT s.s_suppkey AS run_id, k.metric, t.ts, CAST((s.s_suppkey * k.a + 13 * t.ts) % 1009 AS DOUBLE) / 1009 AS value
FROM supplier s CROSS JOIN k CROSS JOIN t
WHERE NOT (s.s_suppkey % 20 = 8 AND k.metric = 'roc_auc') AND NOT (t.ts = 1 AND s.s_suppkey % 3 <> 0)"""

RUN_ARTIFACTS = """WITH p AS (SELECT 0 AS i, 'baseline_model' AS path UNION ALL SELECT 1, 'random_forest_model'
  UNION ALL SELECT 2, 'gradient_boosting_model' UNION ALL SELECT 3, 'GradientBoosting_Best'
  UNION ALL SELECT 4, 'other/model.pkl' UNION ALL SELECT 5, 'plots/curve.png')
SELECT s.s_suppkey AS run_id, p.path FROM supplier s CROSS JOIN p WHERE p.i = s.s_suppkey % 6 OR p.i = 5"""

# Stratified 80/20 hold-out, seed 42: rank per class by md5 of seed and id, quotas by
# largest remainder. Used by every oracle that needs train/test.
SPLIT = """WITH r AS (SELECT subject_id, label, row_number() OVER (PARTITION BY label
        ORDER BY md5(concat('42-', CAST(subject_id AS VARCHAR(20)))), subject_id) AS rn FROM subjects),
n AS (SELECT label, count(*) AS n_c FROM subjects GROUP BY label), t AS (SELECT sum(n_c) AS n FROM n),
q AS (SELECT label, n_c, CAST(ceil(CAST(n AS DOUBLE) * 0.2) AS BIGINT) AS n_test,
  (n_c * CAST(ceil(CAST(n AS DOUBLE) * 0.2) AS BIGINT)) % CAST(n AS BIGINT) AS rem,
  CAST(floor(CAST(n_c * CAST(ceil(CAST(n AS DOUBLE) * 0.2) AS BIGINT) AS DOUBLE) / CAST(n AS DOUBLE)) AS BIGINT) AS base
  FROM n CROSS JOIN t),
z AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, label)
        <= max(n_test) OVER () - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM q)
SELECT CAST(r.subject_id AS BIGINT) AS subject_id, r.label, r.rn, z.quota,
  CASE WHEN r.rn <= z.quota THEN 'test' ELSE 'train' END AS split
FROM r JOIN z ON r.label = z.label"""

# Preset A feature frame (title map, bands, deck) over subjects.
FEATURES = """SELECT subject_id, label, tier, grp, age, sibsp, parch, fare, port,
  COALESCE(CASE nullif(regexp_extract(full_name, ' ([A-Za-z]+)\\.', 1), '')
    WHEN 'Mr' THEN 'Mr' WHEN 'Miss' THEN 'Miss' WHEN 'Mrs' THEN 'Mrs' WHEN 'Master' THEN 'Master'
    WHEN 'Ms' THEN 'Miss' WHEN 'Mlle' THEN 'Miss' WHEN 'Mme' THEN 'Mrs' END, 'Rare') AS title,
  CAST(sibsp + parch + 1 AS INT) AS family_size,
  CAST(CASE WHEN sibsp + parch + 1 = 1 THEN 1 ELSE 0 END AS INT) AS is_alone,
  CASE WHEN age >= 0 AND age < 12 THEN 'Child' WHEN age >= 12 AND age < 18 THEN 'Teen'
       WHEN age >= 18 AND age < 35 THEN 'Young Adult' WHEN age >= 35 AND age < 60 THEN 'Adult'
       WHEN age >= 60 AND age < 100 THEN 'Senior' END AS age_group,
  COALESCE(nullif(substring(cabin, 1, 1), ''), 'U') AS deck
FROM subjects"""

# Preset B (dashboard) feature frame.
FEATURES_B = """SELECT subject_id, label, tier, grp, age, sibsp, parch, fare, port,
  COALESCE(CASE nullif(trim(split_part(split_part(full_name, ',', 2), '.', 1)), '')
    WHEN 'Mr' THEN 'Mr' WHEN 'Miss' THEN 'Miss' WHEN 'Mrs' THEN 'Mrs' WHEN 'Master' THEN 'Master' END, 'Rare') AS title,
  CAST(sibsp + parch + 1 AS INT) AS family_size,
  CAST(CASE WHEN sibsp + parch + 1 = 1 THEN 1 ELSE 0 END AS INT) AS is_alone,
  CASE WHEN age > 0 AND age <= 12 THEN 'Child' WHEN age > 12 AND age <= 18 THEN 'Teen'
       WHEN age > 18 AND age <= 35 THEN 'Adult' WHEN age > 35 AND age <= 60 THEN 'Middle'
       WHEN age > 60 AND age <= 100 THEN 'Senior' END AS age_group,
  COALESCE(nullif(substring(cabin, 1, 1), ''), 'Unknown') AS deck,
  fare / (sibsp + parch + 1) AS fare_per_person
FROM subjects"""

_DEPS = {
    "subjects": (SUBJECTS, []),
    "scored": (SCORED, ["subjects"]),
    "runs": (RUNS, []),
    "run_metrics": (RUN_METRICS, []),
    "run_artifacts": (RUN_ARTIFACTS, []),
    "split": (SPLIT, ["subjects"]),
    "features": (FEATURES, ["subjects"]),
    "features_b": (FEATURES_B, ["subjects"]),
}


def with_views(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` prefix holding the named views (and their dependencies), then ``extra`` CTEs."""
    order: list[str] = []

    def visit(n):
        for d in _DEPS[n][1]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({_DEPS[n][0]})" for n in order]
    parts += [f"{n} AS ({sql})" for n, sql in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n"
