"""The query catalog: each registered query is a Spark callable ``(spark, sf_dir) -> DataFrame``
with, where SQL can express it, the equivalent DuckDB/ANSI SQL text next to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.functions.features import feature_frame
from tessera.sources import fixtures
from tessera.spec import PRESET_A, PRESET_B

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query (and its oracle SQL, if any) under ``name``."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# Shared inputs -------------------------------------------------------------------------

def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.subjects(spark, sf_dir)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_frame(fixtures.subjects(spark, sf_dir), PRESET_A)


def split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature frame with the stratified ``split`` column, checkpointed to the shared folder.

    Fits read it several times and the result once more: written once, it spares every
    later pass the source join and the split, and it survives executor loss."""
    from tessera.operators.split import stratified_split
    from tessera.session import checkpointed
    return checkpointed(stratified_split(features(spark, sf_dir)))


def features_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_frame(fixtures.subjects(spark, sf_dir), PRESET_B)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.scored(spark, sf_dir)


def load_all() -> None:
    """Import every query module so their registrations run."""
    from tessera.plans import (  # noqa: F401
        q_eval,
        q_explain,
        q_features,
        q_holdout,
        q_io,
        q_prep,
        q_profile,
        q_runs,
        q_score,
        q_split,
        q_train,
    )
