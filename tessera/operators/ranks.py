"""Exact ranks, running totals and quantiles without a window over a whole table.

A ``Window.orderBy`` without ``partitionBy`` moves every row into one task; partitioning
only by a binary label gives two giant tasks. Instead:

1. give every row a *bucket*: a small integer that is monotone in the order key
   (quantile edges from a sketch, or leading hex digits of a hash, which are uniform);
2. aggregate per (key, bucket) into a small table (|keys| x buckets rows) and take the
   running total over buckets there: these are the exact offsets of each bucket;
3. join the offsets back (AQE broadcasts the small side when its measured size allows)
   and finish with a window partitioned by (key, bucket): many balanced tasks.

The result is exact. Hot order values are collapsed before step 1 (pre-aggregation by
distinct value, checkpointed), so one value holding a third of the rows is one row, and
the sketch for the bucket edges reads that collapsed table, not the source.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tessera.session import checkpointed

BUCKET = "_bucket"


def parallel_buckets(spark) -> int:
    """Bucket count that follows the configured shuffle parallelism (2 per partition)."""
    try:
        sp = int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # noqa: BLE001
        sp = 200
    return max(8, 2 * sp)


# Sketch accuracy for bucket edges: 50 per bucket, at most this. The final merge of the
# partial sketches is one task per column whose cost grows with the accuracy; edges only
# balance buckets (results stay exact), and at the cap the rank error (1e-5) is a small
# part of a bucket even with tens of thousands of buckets.
MAX_SKETCH_ACCURACY = 100_000


def sketch_accuracy(n_buckets: int) -> int:
    return min(MAX_SKETCH_ACCURACY, max(1_000, 50 * n_buckets))


def quantile_edges(df: DataFrame, cols: list[str], n_buckets: int, accuracy: int | None = None) -> dict[str, list[float]]:
    """Approximate quantile edges per column (one aggregation, sketch-sized result).

    Edges only balance the buckets (exactness comes later), so the sketch accuracy
    follows the bucket count."""
    if n_buckets <= 1:
        return {c: [] for c in cols}
    accuracy = accuracy or sketch_accuracy(n_buckets)
    probs = [i / n_buckets for i in range(1, n_buckets)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(c) for c in cols]).first()
    out = {}
    for c in cols:
        edges = sorted({float(x) for x in (row[c] or []) if x is not None and not math.isnan(x)})
        out[c] = edges
    return out


def with_quantile_buckets(df: DataFrame, cols: list[str], n_buckets: int, suffix: str = "__b") -> DataFrame:
    """Add ``<col><suffix>`` bucket ids, monotone in each column (JVM binary search)."""
    edges = quantile_edges(df, cols, n_buckets)
    # Bucketizer wants >= 3 splits; a column without interior edges (all null / constant)
    # gets one neutral split, which keeps the buckets monotone
    splits = [[-math.inf] + (edges[c] or [0.0]) + [math.inf] for c in cols]
    b = Bucketizer(splitsArray=splits, inputCols=cols, outputCols=[c + suffix for c in cols], handleInvalid="keep")
    out = b.transform(df)
    return out.withColumns({c + suffix: F.col(c + suffix).cast("int") for c in cols})


def running_totals(df: DataFrame, keys: list[str], bucket: str, order: list[Column], sums: list[str],
                   prefix: str = "cum_", next_cols: list[str] | tuple = (),
                   bucket_totals: DataFrame | None = None) -> DataFrame:
    """Inclusive running sums of ``sums`` within ``keys``, in ``order`` (a total order).

    ``bucket`` must be monotone in ``order`` within each key. Adds ``cum_<c>`` columns and
    ``tot_<c>`` (the key total). ``next_cols`` adds ``next_<c>``, the value in the following
    row of the key (null after the last): a lead inside each (key, bucket) window, and for
    a bucket's last row the first row of the next non-empty bucket, carried by the same
    small per-bucket table as the offsets. ``bucket_totals`` passes that table when the
    caller already has it (keys, bucket, ``_b_<c>`` per sum; no ``next_cols``), which
    spares a pass over ``df``.
    """
    if bucket_totals is not None and not next_cols:
        small = bucket_totals
    else:
        aggs = [F.sum(c).alias("_b_" + c) for c in sums]
        if next_cols:
            aggs.append(F.min_by(F.struct(*next_cols), F.struct(*order)).alias("_first"))
        small = df.groupBy(*keys, bucket).agg(*aggs)
    wb = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    wt = Window.partitionBy(*keys)
    nb = [F.lead("_first").over(Window.partitionBy(*keys).orderBy(bucket)).alias("_nb")] if next_cols else []
    offs = small.select(*keys, bucket,
                        *[F.coalesce(F.sum("_b_" + c).over(wb), F.lit(0)).alias("_off_" + c) for c in sums],
                        *[F.sum("_b_" + c).over(wt).alias("tot_" + c) for c in sums], *nb)
    # keys may be null: a null key is a group like any other
    offs = offs.withColumnsRenamed({k: "_k_" + k for k in [*keys, bucket]})
    same = F.lit(True)
    for k in [*keys, bucket]:
        same = same & F.col(k).eqNullSafe(F.col("_k_" + k))
    j = df.join(offs, same, how="inner")
    wi = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wl = Window.partitionBy(*keys, bucket).orderBy(*order)
    last_in_bucket = F.lead(F.lit(1)).over(wl).isNull()
    nxt = [F.when(last_in_bucket, F.col("_nb")[c]).otherwise(F.lead(c).over(wl)).alias("next_" + c)
           for c in next_cols]
    return j.select(*df.columns,
                    *[(F.col("_off_" + c) + F.sum(c).over(wi)).alias(prefix + c) for c in sums],
                    *[F.col("tot_" + c) for c in sums], *nxt)


def value_buckets(df: DataFrame, value: str, n_buckets: int, by: str | None = None, out: str = BUCKET) -> DataFrame:
    """Add ``out``: a bucket id monotone in ``value`` within each ``by`` group (-1 for null).

    Meant for a collapsed table (one row per distinct value): its sketch edges balance the
    buckets by the rows the running totals actually process, and the sketch reads that
    small table, not the source. The edges (groups x buckets numbers) reach the driver;
    each row is placed by a JVM binary search.
    """
    if by is None:
        groups = {None: quantile_edges(df, [value], n_buckets)[value]}
    else:
        probs = [i / n_buckets for i in range(1, n_buckets)] if n_buckets > 1 else [0.5]
        acc = sketch_accuracy(n_buckets)
        rows = df.groupBy(by).agg(F.percentile_approx(F.col(value).cast("double"), probs, acc).alias("_e")).collect()
        groups = {r[by]: sorted({float(x) for x in (r["_e"] or []) if x is not None and not math.isnan(x)})
                  if n_buckets > 1 else [] for r in rows}
    names = list(groups)
    if not names:  # no rows: nothing to place
        return df.select(*df.columns, F.lit(-1).alias(out))
    tmp_in = [f"_bv{i}" for i in range(len(names))]
    tmp_out = [f"_bb{i}" for i in range(len(names))]
    # Bucketizer wants >= 3 splits; a group without interior edges gets one neutral split
    splits = [[-math.inf] + (groups[g] or [0.0]) + [math.inf] for g in names]
    src = df.select("*", *[F.col(value).cast("double").alias(t) for t in tmp_in])
    b = Bucketizer(splitsArray=splits, inputCols=tmp_in, outputCols=tmp_out, handleInvalid="keep").transform(src)
    if by is None:
        bucket = F.col(tmp_out[0])
    else:
        bucket = F.coalesce(*[F.when(F.col(by).eqNullSafe(F.lit(g)), F.col(t)) for g, t in zip(names, tmp_out)])
    bucket = F.when(F.col(value).isNull(), F.lit(-1)).otherwise(bucket.cast("int"))
    return b.select(*df.columns, bucket.alias(out))


def distinct_value_counts(df: DataFrame, cols: list[str], keys: list[str] | None = None,
                          n_buckets: int | None = None) -> DataFrame:
    """Rows ``(*keys, col_name, value, c, _bucket)``: every distinct non-null value of each
    column (as double) with its count, plus one zero-count null row where a column has
    missing values, and a bucket monotone in the value per column.

    One shuffle, map-side combined (a hot value is one row per task), checkpointed to the
    shared folder: quantiles and moments are all read from it, never from the source.
    """
    keys = list(keys or [])
    if n_buckets is None:
        n_buckets = parallel_buckets(df.sparkSession)
    pairs = F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).cast("double").alias("value")) for c in cols])
    long = df.select(*keys, F.inline(pairs))
    # NaN counts as missing; a missing value stays as one zero-weight row so that an
    # all-null column still yields its (null) result without another pass
    value = F.when(F.isnan("value"), F.lit(None).cast("double")).otherwise(F.col("value"))
    long = long.select(*keys, "col_name", value.alias("value"))
    vc = checkpointed(long.groupBy(*keys, "col_name", "value").agg(F.count("value").alias("c")))
    return value_buckets(vc, "value", n_buckets, by="col_name")


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], keys: list[str] | None = None,
                    n_buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy 'linear' / SQL ``quantile_cont``).

    Returns long rows ``(*keys, col_name, p, value)``; nulls are skipped, an all-null
    column gives a null value. Plan: :func:`distinct_value_counts` (the only source scan;
    bucket edges from a sketch over the collapsed table), then running totals per (key,
    column, bucket). No task ever holds a whole column.
    """
    return quantiles_from_counts(distinct_value_counts(df, cols, keys, n_buckets), probs, keys)


def quantiles_from_counts(vc: DataFrame, probs: list[float], keys: list[str] | None = None) -> DataFrame:
    """Exact quantiles from a :func:`distinct_value_counts` table."""
    keys = list(keys or [])
    kk = keys + ["col_name"]
    ranked = running_totals(vc, kk, BUCKET, [F.col("value")], ["c"])
    # a value occupies 0-based ranks [cum_c - c, cum_c - 1]; n = tot_c
    p_arr = F.array(*[F.lit(float(p)) for p in probs])
    n = F.col("tot_c")
    lo_r, hi_r = F.col("cum_c") - F.col("c"), F.col("cum_c") - 1

    def covers(r):
        return (r >= lo_r) & (r <= hi_r)
    hit = F.exists(p_arr, lambda p: covers(F.floor(p * (n - 1))) | covers(F.ceil(p * (n - 1))))
    cand = ranked.filter(hit | F.col("value").isNull()) \
        .select(*kk, "value", "c", "cum_c", "tot_c", F.explode(p_arr).alias("p"))
    h = F.col("p") * (F.col("tot_c") - 1)
    agg = cand.groupBy(*kk, "p").agg(
        F.max(F.when(covers(F.floor(h)), F.col("value"))).alias("x_lo"),
        F.max(F.when(covers(F.ceil(h)), F.col("value"))).alias("x_hi"),
        F.max(h - F.floor(h)).alias("frac"),
    )
    return agg.select(*kk, "p", (F.col("x_lo") + (F.col("x_hi") - F.col("x_lo")) * F.col("frac")).alias("value"))
