"""Operator 3: exact top-k by inner product with a pivot table.

Every vector's distances to ``PIVOTS`` pivots are computed once and kept in a table beside the vectors, in blocks. By the
triangle inequality d(q, x) is at least |d(q, p) - d(x, p)| for every pivot p; the largest of these lower bounds gives an
upper bound of the inner product, (|q|^2 + |x|^2 - d^2) / 2. A query takes a block's candidates in order of their bounds and
stops for good when the best bound left is below its k-th best score so far. They are taken in a few steps of the order, each
scored at once. The k-th best score starts from ``SEEDS`` exact scores, so stopping works in every block. Pivots are chosen farthest-first from a bounded sample, the origin among them (its bound is that of
the norms); the choice changes the work only, never the result.

The stated queries meet all rows block by block: a task holds one block of vectors and up to ``QUERY_BLOCKS`` blocks of queries,
dealt by the pair of them. Blocks grow with the table up to ``BLOCK_ROWS``, so small tables use all cores too. Each pair
of blocks gives at most k rows a query, and a window over those gives the answer.

Defined results: vectors that are null or hold null or non-finite components take no part; rows without an id are candidates,
but no queries; a query meets candidates of its own length only; ties go to the smaller id (none last); repeated ids are
rows of their own (a query's own row alone is left out); with fewer than k candidates all are returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, read, written

PIVOTS, SAMPLE, SEEDS = 32, 2000, 500
BLOCK_ROWS, QUERY_ROWS, QUERY_BLOCKS = 1 << 16, 512, 16
#: Stands for a row without an id.
NO_ID = np.iinfo(np.int64).max
BLOCK = "dim int, ids binary, nulls binary, rows binary, vectors binary, pivots binary"
FOUND = "query_row long, query_id long, vec_id long, row long, score long"


def usable(vector: str) -> Column:
    return (F.col(vector).isNotNull()
            & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf")))))


def choose_pivots(sample: pd.DataFrame, count: int = PIVOTS) -> dict[int, np.ndarray]:
    """Farthest-first pivots for each vector length in the sample, the origin first."""
    out = {}
    for dim, part in sample.groupby(sample["v"].map(len)):
        x = np.array(part["v"].tolist(), np.float64).reshape(len(part), dim)
        pivots, near = [np.zeros(dim)], (x ** 2).sum(1)
        while len(pivots) < count and len(x) and near.max() > 0:
            pivots.append(x[near.argmax()])
            near = np.minimum(near, ((x - pivots[-1]) ** 2).sum(1))
        out[int(dim)] = np.array(pivots)
    return out


def pivot_table(vectors: DataFrame, pivots: dict[int, np.ndarray], rows: int) -> DataFrame:
    """``vectors`` (row, vec_id, v) in blocks of ``rows`` or a batch more, with the distances of each to the pivots."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[pd.DataFrame]] = {}
        for pdf in batches:
            for dim, part in pdf.groupby(pdf["v"].map(len)):
                held.setdefault(int(dim), []).append(part)
                if sum(map(len, held[int(dim)])) >= rows:
                    yield block(int(dim), held.pop(int(dim)))
        for dim, parts in held.items():
            yield block(dim, parts)

    def block(dim: int, parts: list[pd.DataFrame]) -> pd.DataFrame:
        some = pd.concat(parts)
        x = np.array(some["v"].tolist(), np.int64).reshape(len(some), dim)
        d = np.stack([np.sqrt(((x - p) ** 2).sum(1, dtype=np.float64)) for p in pivots.get(dim, np.zeros((1, dim)))], 1)
        return pd.DataFrame({"dim": [dim], "ids": [some["vec_id"].to_numpy(np.int64).tobytes()],
                             "nulls": [some["none"].to_numpy(np.uint8).tobytes()], "rows": [some["row"].to_numpy(np.int64).tobytes()], "vectors": [x.tobytes()], "pivots": [d.tobytes()]})

    some = vectors.select("row", F.coalesce("vec_id", F.lit(int(NO_ID))).alias("vec_id"), F.col("vec_id").isNull().alias("none"), "v")
    return some.mapInPandas(pack, BLOCK)


def exact_type(dim: int, most: float):
    """The cheapest type in which all inner products are exact."""
    bound = max(1, dim) * most * most
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64


def upper_bounds(q: dict, x: dict) -> np.ndarray:
    """For every query and vector a number that their inner product doesn't pass, from the largest difference of their
    distances to a pivot; widened for rounding in single precision."""
    far = np.add.outer(q["p"].max(1), x["p"].max(1))
    kind = np.float32 if far.max() < 1e15 else np.float64
    low = np.zeros(far.shape, kind)
    work = np.empty_like(low)
    for a, b in zip(q["p"].T.astype(kind), x["p"].T.astype(kind)):
        np.subtract(b[None, :], a[:, None], out=work)
        np.abs(work, out=work)
        np.maximum(low, work, out=low)
    np.square(low, out=low)
    norms = np.add.outer(q["p"][:, 0] ** 2, x["p"][:, 0] ** 2)  # the first pivot is the origin
    return (norms - low) / 2 + 1e-6 * far * far + 1e-3


def search(q: dict, x: dict, k: int, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query place, candidate places, scores) of each query's k best in the block, those that can be among its k best at
    all; ``least`` holds scores that k candidates are known to reach."""
    kind = exact_type(q["v"].shape[1], max(np.abs(q["v"]).max(initial=0), np.abs(x["v"]).max(initial=0)))
    qv, xv, n = q["v"].astype(kind), x["v"].astype(kind), len(x["ids"])
    order = np.lexsort((x["rows"], x["nulls"], x["ids"]))
    tie = np.empty(n, np.int64)
    tie[order] = np.arange(n)  # among equal scores
    steps = [s for s in (16 * k, 128 * k) if s < n]
    part = max(1, (1 << 18) // max(n, 1))
    for at in range(0, len(qv), part):
        some = {"p": q["p"][at: at + part]}
        for i, bound in enumerate(upper_bounds(some, x), at):
            bound[x["rows"] == q["rows"][i]] = -np.inf
            ranked = np.argpartition(-bound, steps) if steps else np.arange(n)
            places, scores, kth = ranked[:0], np.empty(0, np.int64), least[i]
            for a, b in zip([0, *steps], [*steps, n]):
                new = ranked[a:b]
                new = new[(bound[new] >= kth) & (bound[new] > -np.inf)]
                if not len(new):
                    break  # no later bound is higher
                got = (xv[new] @ qv[i]).astype(np.int64) if 2 * len(new) < n else (xv @ qv[i]).astype(np.int64)[new]
                new, got = new[got >= kth], got[got >= kth]  # what is below the k-th best is out for good
                places, scores = np.concatenate([places, new]), np.concatenate([scores, got])
                if len(scores) > k:
                    sure = np.flatnonzero(scores >= -np.partition(-scores, k - 1)[k - 1])
                    best = sure[np.lexsort((tie[places[sure]], -scores[sure]))[:k]]
                    places, scores = places[best], scores[best]
                if len(scores) == k:
                    kth = max(kth, scores.min())
            yield i, places, scores


def unpacked(row) -> dict:
    ids = np.frombuffer(row.ids, np.int64)
    return {"ids": ids, "nulls": np.frombuffer(row.nulls, np.uint8), "rows": np.frombuffer(row.rows, np.int64),
            "v": np.frombuffer(row.vectors, np.int64).reshape(len(ids), -1),
            "p": np.frombuffer(row.pivots, np.float64).reshape(len(ids), -1)}


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``vectors`` (vec_id long, v array<long>); ``is_query`` picks the queries."""
    spark = vectors.sparkSession
    bounded_batches(spark)  # by bytes too: a row below can be a pair of blocks
    rows = written(vectors.filter(usable("v")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    sample = rows.select("v", F.xxhash64("row").alias("_o")).orderBy("_o").limit(SAMPLE).toPandas()
    sent = spark.sparkContext.broadcast((choose_pivots(sample), sample["v"].tolist()[:SEEDS]))  # a few hundred vectors
    # Three blocks a core at least, so that all work; blocks of BLOCK_ROWS from there on.
    block = int(min(BLOCK_ROWS, max(1024, rows.count() // (3 * spark.sparkContext.defaultParallelism))))
    number = F.row_number().over(W.partitionBy("dim").orderBy("place")) - 1
    table = written(pivot_table(rows, sent.value[0], block).withColumn("place", F.monotonically_increasing_id()), "pivot-table")
    queries = written(pivot_table(rows.filter(is_query), sent.value[0], QUERY_ROWS)
                      .withColumn("place", F.monotonically_increasing_id()), "query-blocks")
    # Numbers of the blocks: ranked without their vectors, a row a block.
    x_side = table.select("dim", "place").withColumn("x", number)
    q_side = queries.select("dim", "place").withColumn("q", F.floor(number / QUERY_BLOCKS))
    counts = x_side.groupBy("dim").agg(F.max("x").alias("last_x")).join(q_side.groupBy("dim").agg(F.max("q").alias("last_q")), "dim")
    x_side = x_side.join(F.broadcast(counts), "dim").select("place", "x", F.explode(F.sequence(F.lit(0), F.col("last_q"))).alias("q"))
    q_side = q_side.join(F.broadcast(counts), "dim").select("place", "q", F.explode(F.sequence(F.lit(0), F.col("last_x"))).alias("x"))

    def compare(x_blocks: pd.DataFrame, q_blocks: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "row": [], "score": []}, dtype="int64")]
        for xr in x_blocks.itertuples():
            x, v = unpacked(xr), [v for v in sent.value[1] if len(v) == xr.dim]
            known = np.array(v, np.int64).reshape(len(v), xr.dim)
            for qr in q_blocks.itertuples():
                q = unpacked(qr)
                least = np.full(len(q["ids"]), np.iinfo(np.int64).min)
                if len(known) > k:  # one of them may be the query itself: its (k + 1)-th score is sure
                    kind = exact_type(q["v"].shape[1], max(np.abs(q["v"]).max(initial=0), np.abs(known).max(initial=0)))
                    least = -np.partition(-(q["v"].astype(kind) @ known.T.astype(kind)), k, axis=1)[:, k].astype(np.int64)
                for i, places, scores in search(q, x, k, least):
                    out.append(pd.DataFrame({"query_row": q["rows"][i], "query_id": q["ids"][i], "vec_id": x["ids"][places],
                                             "row": x["rows"][places], "score": scores}))
        return pd.concat(out)

    # A stated query set against all rows, in blocks of both; dealt by (length, vector block, group of query blocks).
    xs = table.join(x_side, "place").groupBy("dim", "x", "q")
    qs = queries.join(q_side, "place").groupBy("dim", "x", "q")
    found = xs.cogroup(qs).applyInPandas(compare, FOUND)
    best = W.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    found = found.withColumn("vec_id", F.nullif("vec_id", F.lit(int(NO_ID))))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each query's 20 best by the inner product of floor(64 * x)."""
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding").filter(usable("embedding")).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 64).cast("long")).alias("v"))
    return top_k(vectors, F.col("vec_id") % 20 == 0)


OP3_SQL = """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.row, c.row AS other, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v AS q JOIN v AS c ON q.row <> c.row AND q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST, other) AS rank FROM s) WHERE rank <= 20
"""
