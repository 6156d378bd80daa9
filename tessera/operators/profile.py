"""Profiling operators: shape, types, null counts, summaries, rates, histograms, correlations.

Every statistic is one aggregation pass (partial aggregation on the map side); one-row
totals reach other rows as scalar subqueries, never through a global window or the driver.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranks import distinct_value_counts, quantiles_from_counts


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_cols"))


def dtypes(df: DataFrame) -> DataFrame:
    """(ordinal, column, dtype) from the schema, as a DataFrame (metadata only, one row per column)."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, col_name string, dtype string")


def head(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First n rows in an explicit order (distributed top-k, no full sort)."""
    return df.orderBy(*order).limit(n)


def _unpivot_counts(aggs: dict[str, Column], df: DataFrame, value_name: str) -> DataFrame:
    wide = df.agg(*[v.alias(k) for k, v in aggs.items()])
    return wide.unpivot([], list(aggs), "col_name", value_name)


def info(df: DataFrame) -> DataFrame:
    """Non-null count and type per column (one pass)."""
    nn = _unpivot_counts({c: F.count(F.col(c)) for c in df.columns}, df, "non_null")
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    return nn.select("col_name", "non_null", F.element_at(types, F.col("col_name")).alias("dtype"))


def null_counts(df: DataFrame) -> DataFrame:
    return _unpivot_counts({c: F.count_if(F.col(c).isNull()) for c in df.columns}, df, "n_null")


def nulls_ranked(df: DataFrame) -> DataFrame:
    return null_counts(df).filter(F.col("n_null") > 0).orderBy(F.desc("n_null"), "col_name")


def null_fraction(df: DataFrame) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    wide = df.agg(*aggs)
    long = wide.unpivot(["_n"], df.columns, "col_name", "n_null")
    return long.select("col_name", "n_null", F.round(F.col("n_null") / F.col("_n"), 6).alias("null_frac"))


def describe(df: DataFrame, cols: list[str], exact: bool = True, digits: int = 6) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (linear interpolation), max per column.

    ``exact=False`` takes the quartiles from a sketch (``percentile_approx``) instead.
    """
    def r(c):
        return F.round(c, digits)
    if exact:
        # one source scan: moments, extremes and quartiles all come from the checkpointed
        # distinct-value table (count-weighted sums; two-pass sum of squared deviations)
        vc = distinct_value_counts(df, cols)
        q = quantiles_from_counts(vc, [0.25, 0.5, 0.75])
        wsum = F.sum(F.col("value") * F.col("c"))
        m = vc.groupBy("col_name").agg(
            F.sum("c").alias("count"), F.try_divide(wsum, F.sum("c").cast("double")).alias("_mean"),
            F.min("value").alias("min"), F.max("value").alias("max"))
        dev = F.col("value") - F.col("_mean")
        # one row a column: broadcast, so that no task takes a whole column
        ss = vc.join(F.broadcast(m.select("col_name", "_mean")), "col_name") \
            .groupBy("col_name").agg(F.sum(F.col("c") * dev * dev).alias("_ss"))
        basic = m.join(ss, "col_name").select(
            "col_name", "count", r(F.col("_mean")).alias("mean"),
            r(F.when(F.col("count") > 1, F.sqrt(F.col("_ss") / (F.col("count") - 1)))).alias("std"), "min", "max")
    else:
        pairs = F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).cast("double").alias("v")) for c in cols])
        long = df.select(F.inline(pairs))
        basic = long.groupBy("col_name").agg(
            F.count("v").alias("count"), r(F.avg("v")).alias("mean"), r(F.stddev_samp("v")).alias("std"),
            F.min("v").alias("min"), F.max("v").alias("max"))
        q = long.groupBy("col_name").agg(F.percentile_approx("v", [0.25, 0.5, 0.75], 10_000).alias("a")) \
            .select("col_name", F.inline(F.arrays_zip(F.array(*[F.lit(x) for x in (0.25, 0.5, 0.75)]).alias("p"),
                                                   F.col("a").cast("array<double>").alias("value"))))
    qw = q.groupBy("col_name").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("value"))
    qw = qw.select("col_name", *[r(F.col(f"`{p}`")).alias(n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    return basic.join(qw, "col_name").select("col_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    return src.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("n"), F.asc_nulls_first("value"))


def normalised_counts(df: DataFrame, col: str, keys: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Counts and share of each value (within ``keys`` when given).

    With keys, the per-key total is a window over the *aggregated* table (one row per
    key and value), never over the data. Without keys the total is a scalar subquery.
    """
    keys = list(keys or [])
    counts = df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("n"))
    if keys:
        from pyspark.sql import Window
        tot = F.sum("n").over(Window.partitionBy(*keys))
    else:
        tot = counts.agg(F.sum("n")).scalar()  # from the counts: their exchange is reused
    return counts.select(*keys, col, "n", F.round(F.col("n") / tot, digits).alias("share"))


def rate(df: DataFrame, label: str, keys: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Mean of a 0/1 label, overall or by keys (null keys dropped, as in a pandas groupby)."""
    keys = list(keys or [])
    src = df.dropna(subset=keys) if keys else df
    return src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(label), digits).alias("rate"))


def rate_grouping_sets(df: DataFrame, label: str, keys: list[str], digits: int = 6) -> DataFrame:
    """Overall rate and rate per key, in one pass (GROUPING SETS ((), (k1), (k2), ...))."""
    sets = [[]] + [[F.col(k)] for k in keys]
    g = df.groupingSets(sets, *[F.col(k) for k in keys])
    return g.agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"), F.round(F.avg(label), digits).alias("rate"))


def corr_matrix(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Pairwise-complete Pearson correlations, long form (a, b, r), both triangles + diagonal."""
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    recs = []
    for a, b in pairs:
        v = F.round(F.col(f"`{a}|{b}`"), digits)
        recs += [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), v.alias("r")),
                 F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), v.alias("r"))]
    recs += [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("r")) for c in cols]
    return wide.select(F.inline(F.array(*recs)))


def hist_fixed(df: DataFrame, col: str, edges: list[float], by: str) -> DataFrame:
    """Counts per fixed bin and ``by`` value; the last bin is closed, outside values dropped.

    Bins with no rows appear with n = 0 (conditional counts, no grid join).
    """
    x = F.col(col)
    nb = len(edges) - 1
    conds = []
    for i in range(nb):
        lo, hi = edges[i], edges[i + 1]
        cond = (x >= lo) & ((x <= hi) if i == nb - 1 else (x < hi))
        conds.append(F.count_if(cond).alias(f"b{i}"))
    wide = df.filter(F.col(by).isNotNull()).groupBy(by).agg(*conds)
    recs = [F.struct(F.lit(float(edges[i])).alias("bin_lo"), F.lit(float(edges[i + 1])).alias("bin_hi"),
                     F.col(f"b{i}").alias("n")) for i in range(nb)]
    return wide.select(by, F.inline(F.array(*recs)))


def hist_log(df: DataFrame, col: str, bins: int, by: str, digits: int = 6) -> DataFrame:
    """Histogram of log10(col) with ``bins`` equal bins spanning min..max; values <= 0 dropped."""
    lv = df.filter((F.col(col) > 0) & F.col(by).isNotNull()).select(by, F.log10(col).alias("lv"))
    stats = lv.agg(F.struct(F.min("lv").alias("lo"), F.max("lv").alias("hi")).alias("s")).scalar()
    lo, hi = stats.getField("lo"), stats.getField("hi")
    width = (hi - lo) / bins
    raw = F.floor((F.col("lv") - lo) / F.when(hi > lo, width).otherwise(F.lit(1.0))).cast("int")
    b = F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1))
    counts = lv.groupBy(by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(by, "bin", F.round(lo + F.col("bin") * width, digits).alias("bin_lo"),
                         F.round(lo + (F.col("bin") + 1) * width, digits).alias("bin_hi"), "n")


def facet_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def facet_cube(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.cube(*keys).agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(F.col(col).alias("value")).distinct()


def format_percent(x: Column, decimals: int = 2) -> Column:
    return F.format_string(f"%.{decimals}f%%", x * 100)
