"""Exact, seeded stratified hold-out split and stratified k-fold assignment.

Rows are ordered inside each class by ``md5('<seed>-' || id)`` (ties by id). The test
quota per class follows the largest-remainder rule, so the test size is exactly
``ceil(test_frac * n)``. Ranks come from :mod:`tessera.operators.ranks`: the hash's
leading hex digits are a uniform, order-preserving bucket, so the rank windows run per
(class, bucket) — a class holding most rows is still spread over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ranks import running_totals
from tessera.session import checkpointed

HASH = "_h"


def order_hash(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string")))


def class_quotas(counts: dict, test_frac: float) -> dict:
    """Largest-remainder allocation of ceil(test_frac * n) test rows over classes."""
    if None in counts:
        raise ValueError("stratified split: the label has nulls; drop or fill them first")
    n = sum(counts.values())
    n_test = int(math.ceil(float(n) * test_frac))
    base = {k: (c * n_test) // n for k, c in counts.items()}
    rem = {k: (c * n_test) % n for k, c in counts.items()}
    extra = n_test - sum(base.values())
    order = sorted(counts, key=lambda k: (-rem[k], k))
    return {k: base[k] + (1 if i < extra else 0) for i, k in enumerate(order)}


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class (one row per class reaches the driver)."""
    return {r[0]: r[1] for r in df.groupBy(label).count().collect()}


SPLIT_HEX_DIGITS = 4  # 65536 hash buckets per class
# The (class, bucket) offsets table has at most classes x 16**SPLIT_HEX_DIGITS rows; it
# is broadcast when that bound is below this many rows (about 40 bytes a row).
BROADCAST_MAX_ROWS = 2_000_000


def stratified_split(df: DataFrame, id_col: str = "subject_id", label: str = "label", test_frac: float = 0.2,
                     seed: int = 42, split_col: str = "split", keep_rank: bool = False) -> DataFrame:
    """Add ``split`` = 'test' | 'train' with exact per-class quotas.

    Rows are bucketed by the leading hex digits of their order hash. One scan builds the
    (class, bucket) count table — tiny, checkpointed — which also gives the class counts
    and quotas. A bucket that ends before its class quota is all test, one that starts
    after it is all train; only the single boundary bucket per class is ranked row by
    row. ``keep_rank=True`` ranks every row (needed for folds).
    """
    if keep_rank:
        return _split_with_ranks(df, id_col, label, test_frac, seed, split_col)
    h = df.withColumn(HASH, order_hash(id_col, seed))
    h = h.withColumn("_bucket", F.conv(F.substring(HASH, 1, SPLIT_HEX_DIGITS), 16, 10).cast("int"))
    small = checkpointed(h.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_bn")))
    counts = {r[0]: r[1] for r in small.groupBy(label).agg(F.sum("_bn")).collect()}
    quotas = class_quotas(counts, test_frac)
    qmap = F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv])
    q = F.element_at(qmap, F.col(label))
    w = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offs = small.select(label, "_bucket", "_bn", F.coalesce(F.sum("_bn").over(w), F.lit(0)).alias("_off"))
    offs = offs.withColumn("_state", F.when(F.col("_off") + F.col("_bn") <= q, F.lit("test"))
                           .when(F.col("_off") >= q, F.lit("train")).otherwise(F.lit("boundary")))
    offs = offs.select(label, "_bucket", "_off", "_state")
    if len(counts) * 16 ** SPLIT_HEX_DIGITS <= BROADCAST_MAX_ROWS:
        offs = F.broadcast(offs)  # size bound proven above: rows are not shuffled to meet it
    j = h.join(offs, on=[label, "_bucket"], how="inner")
    decided = j.filter(F.col("_state") != "boundary").withColumn(split_col, F.col("_state"))
    wb = Window.partitionBy(label, "_bucket").orderBy(HASH, id_col)
    bnd = j.filter(F.col("_state") == "boundary").withColumn(
        split_col, F.when(F.col("_off") + F.row_number().over(wb) <= q, F.lit("test")).otherwise(F.lit("train")))
    return decided.unionByName(bnd).select(*df.columns, split_col)


def _split_with_ranks(df, id_col, label, test_frac, seed, split_col):
    # every row needs its rank: the (class, bucket) count table — one scan, checkpointed —
    # gives the class counts (quotas) and is the offsets table of the running totals
    h = df.withColumn(HASH, order_hash(id_col, seed))
    h = h.withColumn("_bucket", F.conv(F.substring(HASH, 1, SPLIT_HEX_DIGITS), 16, 10).cast("int")) \
        .withColumn("_one", F.lit(1))
    small = checkpointed(h.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_b__one")))
    counts = {r[0]: r[1] for r in small.groupBy(label).agg(F.sum("_b__one")).collect()}
    quotas = class_quotas(counts, test_frac)
    qmap = F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv])
    r = running_totals(h, [label], "_bucket", [F.col(HASH), F.col(id_col)], ["_one"], bucket_totals=small)
    r = r.withColumnRenamed("cum__one", "rank_in_class").drop("tot__one", "_one", "_bucket")
    q = F.element_at(qmap, F.col(label))
    nmap = F.create_map(*[F.lit(x) for kv in counts.items() for x in kv])
    out = r.withColumn(split_col, F.when(F.col("rank_in_class") <= q, F.lit("test")).otherwise(F.lit("train")))
    return out.withColumns({"quota": q.cast("bigint"), "class_n": F.element_at(nmap, F.col(label)).cast("bigint")})


def stratified_folds(df: DataFrame, k: int = 5, id_col: str = "subject_id", label: str = "label",
                     test_frac: float = 0.2, seed: int = 42, fold_col: str = "fold") -> DataFrame:
    """Training rows of the hold-out split with fold = (rank among the class's training rows - 1) mod k.

    Also carries ``class_train``, the number of training rows of the row's class (a
    constant per class, known from the split's count table), so later steps need no
    counting pass."""
    s = stratified_split(df, id_col, label, test_frac, seed, keep_rank=True)
    tr = s.filter(F.col("split") == "train")
    tr_rank = F.col("rank_in_class") - F.col("quota")
    return tr.withColumns({"train_rank": tr_rank, fold_col: ((tr_rank - 1) % k).cast("int"),
                           "class_train": F.col("class_n") - F.col("quota")}) \
        .drop("quota", "class_n", "split", HASH)


def fold_places(folds: DataFrame, k: int = 5, id_col: str = "subject_id", seed: int = 42, fold_col: str = "fold") -> DataFrame:
    """``folds`` with ``place_<f>`` for every fold f: the row's place, in one order over all classes, among the training rows
    of f (those of the other folds). Running counts per fold give all of them in one pass over hash buckets."""
    h = folds.withColumn(HASH, order_hash(id_col, seed))
    h = h.withColumn("_bucket", F.conv(F.substring(HASH, 1, SPLIT_HEX_DIGITS), 16, 10).cast("int"))
    h = h.withColumn("_all", F.lit(0)).withColumns({f"_f{f}": (F.col(fold_col) == f).cast("int") for f in range(k)})
    r = running_totals(h, ["_all"], "_bucket", [F.col(HASH), F.col(id_col)], [f"_f{f}" for f in range(k)])
    own = lambda f: sum((F.col(f"cum__f{g}") for g in range(k) if g != f), F.lit(0))
    return r.select(*folds.columns, *[own(f).cast("long").alias(f"place_{f}") for f in range(k)])


def learning_curve_sizes(folds: DataFrame, k: int = 5, steps: int = 10, label: str = "label", id_col: str = "subject_id") -> DataFrame:
    """Per (validation fold, step): rows and positives of the growing training subset. Step s is the first
    floor(s / steps * n) of the fold's training rows in one order over all classes, where n is the number of training rows
    of fold 0; so a step has one size in all folds (a fold with fewer rows gives all it has)."""
    placed = checkpointed(fold_places(folds.select(id_col, label, "fold"), k, id_col))
    n = placed.agg(F.count_if(F.col("fold") != 0)).scalar()
    grid = placed.select(label, "fold", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"place_{f}").alias("place"))
                                                            for f in range(k)])).alias("g")).filter(F.col("g.f") != F.col("fold"))
    # the first step that takes the row in; floor(s * n / steps) >= place, in whole numbers
    entry = F.ceil(F.col("g.place") * steps / n)
    entry = F.when(F.floor((entry - 1) * n / steps) >= F.col("g.place"), entry - 1).when(
        F.floor(entry * n / steps) < F.col("g.place"), entry + 1).otherwise(entry).cast("int")
    per = grid.groupBy(F.col("g.f").alias("fold"), entry.alias("entry"), label).agg(F.count(F.lit(1)).alias("n"))
    taken = per.filter(F.col("entry") <= steps).select("fold", label, "n", F.explode(F.sequence("entry", F.lit(steps))).alias("step"))
    return taken.groupBy("fold", "step").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col(label) == 1, F.col("n")).otherwise(0)).alias("n_pos"))
