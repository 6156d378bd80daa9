"""Catalog queries against their DuckDB oracle on the smallest tables (the driver runs all at sf0.01)."""
import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_oracle import digest
from tessera.sources.tables import TABLES

KEYS = ["profile_describe", "feature_frame", "stratified_split", "stratified_kfold", "impute_median", "onehot_long",
        "roc_auc", "pr_curve", "classification_report", "fairness_audit", "leaderboard", "registry_promote",
        "rejected_rows", "attribution_breakdown", "learning_curve_sizes", "csv_scan_na", "roc_curve",
        "assembled_vectors", "impute_group_median", "impute_whole_table"]


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, sf_small, key):
    s = entry.queries()[key](spark, sf_small).toPandas()
    d = con.execute(entry.oracle_sql()[key]).df()
    assert digest(s) == digest(d)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
