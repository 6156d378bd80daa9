"""Projection and schema operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    return df.drop(*cols)


def select_order(df: DataFrame, order: list[str]) -> DataFrame:
    """Project to a fixed column order (fails on a missing column)."""
    return df.select(*order)


def existing(df: DataFrame, cols: list[str]) -> list[str]:
    """Only those names that the frame has (decided on the schema, before planning)."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def schema_rows(df: DataFrame) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "col_name string, dtype string")


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two-way difference of (name, type) sets: rows only on the left or only on the right."""
    lr, rr = schema_rows(left), schema_rows(right)
    return lr.exceptAll(rr).withColumn("side", F.lit("left_only")).unionByName(
        rr.exceptAll(lr).withColumn("side", F.lit("right_only")))


def strip_prefix(col: str | Column, prefix: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, "^" + prefix, "")


def param_grid(params: DataFrame, keys: list[str], key_col: str = "key", value_col: str = "value") -> DataFrame:
    """Cartesian grid of the distinct values of each key (sorted), built with generators.

    One aggregation gathers the (small, grid-sized) value sets; successive ``explode``
    calls expand them. No join.
    """
    sets = params.groupBy().agg(*[
        F.array_sort(F.collect_set(F.when(F.col(key_col) == k, F.col(value_col)))).alias(k) for k in keys])
    out = sets
    for k in keys:
        rest = [c for c in out.columns if c != k]
        out = out.select(*rest, F.explode(k).alias(k))
    return out.select(*keys)
