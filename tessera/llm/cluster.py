"""Operator 11: exact k-means by shallot search.

Every vector remembers its centroid, the second nearest one, an upper bound of its distance to the first and a lower bound
of its distance to all others. When centroids move, the bounds are widened by how far they moved; a vector whose upper bound
stays below its lower bound, or below half the distance from its centroid to the next centroid, keeps its centroid unread.
The others measure their two remembered centroids and start from the closer one: a nearer centroid than the second nearest
must lie in the ball of radius d(x, start) + d(x, second) around the start, so the start's neighbours are met in order of
their distance from it and the ball shrinks with every nearer second. Bounds are floats, widened for rounding, and only
decide what is compared; whatever survives them is compared as exact integer squared distances, ties to the smaller number.

Vectors travel in blocks (rows of a Parquet table in the shared folder) with their bounds. A round is one pass over the
blocks: it writes the blocks with new bounds and, in a partition folder of its own, each task's integer sums by centroid.
Only those sums (centroids x components) are aggregated, and only centroids reach the driver, so nothing is shuffled by
centroid and a centroid that owns a third of all vectors is no hot key. A lost executor costs its blocks of one round.

Defined results: vectors that are null, of another length than ``dim``, or hold null or non-finite components take no part;
a null vec_id takes part, but starts a centroid only if there are too few others (by its components then); repeated ids are
rows of their own (as starting points in order of their components); with fewer vectors than ``k`` there are fewer
centroids; an empty centroid stays where it is; an empty table gives no rows; other columns are ignored, whatever their
names. Components must be below 2^27 in size, so that squared distances are exact longs; a larger one raises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, read
from tessera.session import new_scratch_path

BLOCK_ROWS = 4096
LARGEST = 1 << 27
#: Relative widening of every float bound; distances are roots of integers, exact to a few parts in 2^53.
SLACK = 1e-12
TABLE = ("ids binary, nulls binary, vectors binary, near binary, cluster int, n long, total array<long>, distance long, "
         "compared long, part string")


def usable(vector: str, dim: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dim) & finite, F.lit(False))


class Search:
    """Centroids with each one's neighbours in order of distance, and exact distances of integer vectors to them."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None = None):
        self.c, self.k = centroids, len(centroids)
        self.largest = int(np.abs(centroids).max(initial=0))
        gaps = np.sqrt(np.array([((centroids - c) ** 2).sum(1) for c in centroids], np.float64).reshape(self.k, self.k))
        np.fill_diagonal(gaps, -1)
        self.order = np.argsort(gaps, axis=1, kind="stable")[:, 1:]
        self.gaps = np.take_along_axis(gaps, self.order, 1) * (1 - SLACK)
        self.half = self.gaps[:, 0] / 2 if self.k > 1 else np.full(self.k, np.inf)
        moved = np.zeros(self.k) if before is None else np.sqrt(((centroids - before) ** 2).sum(1).astype(np.float64))
        self.moved = moved * (1 + SLACK)
        most = np.sort(self.moved)[::-1]
        self.others = np.where(self.moved == most[0], most[1], most[0]) if self.k > 1 else np.zeros(self.k)

    def distances(self, x: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Exact squared distances of rows to one centroid each, or to a single centroid."""
        c = self.c[to]
        most = max(self.largest, int(np.abs(x).max(initial=0)))
        if 4 * x.shape[1] * most * most < 1 << 53:  # every step below is an integer that a double holds
            d = x.astype(np.float64) - c
            return np.einsum("ij,ij->i", d, d).astype(np.int64)
        return ((x.astype(np.int64) - c) ** 2).sum(1)

    def start(self, n: int) -> np.ndarray:
        """Bounds of vectors that nothing is known of."""
        near = np.zeros(n, [("a", np.int32), ("b", np.int32), ("upper", np.float64), ("lower", np.float64)])
        near["b"], near["upper"] = min(1, self.k - 1), np.inf
        return near

    def assign(self, x: np.ndarray, near: np.ndarray) -> int:
        """Bring ``near`` up to date with the centroids; returns how many distances were computed."""
        near["upper"] += self.moved[near["a"]]
        near["lower"] -= self.others[near["a"]]
        near["upper"] *= 1 + SLACK
        near["lower"] -= np.abs(near["lower"]) * SLACK
        loose = np.flatnonzero(near["upper"] >= np.maximum(near["lower"], self.half[near["a"]]))
        one = self.distances(x[loose], near["a"][loose])
        near["upper"][loose] = np.sqrt(one) * (1 + SLACK)
        still = near["upper"][loose] >= np.maximum(near["lower"][loose], self.half[near["a"][loose]])
        rows, d1 = loose[still], one[still]
        if self.k < 2 or not len(rows):
            return len(loose)
        a, b = near["a"][rows].copy(), near["b"][rows].copy()
        d2 = self.distances(x[rows], b)
        swap = (d2 < d1) | ((d2 == d1) & (b < a))
        a[swap], b[swap], d1[swap], d2[swap] = b[swap], a[swap], d2[swap], d1[swap]
        done = self._scan(x[rows], a, b, d1, d2)
        near["a"][rows], near["b"][rows] = a, b
        near["upper"][rows], near["lower"][rows] = np.sqrt(d1) * (1 + SLACK), np.sqrt(d2) * (1 - SLACK)
        return len(loose) + len(rows) + done

    def _scan(self, x, a, b, d1, d2) -> int:
        """Meet the neighbours of every row's closer centroid inside the shrinking ball; updates the arrays in place."""
        done, start, from_start = 0, a.copy(), np.sqrt(d1)
        for s in np.unique(start).tolist():
            live = np.flatnonzero(start == s)
            for j, gap in zip(self.order[s].tolist(), self.gaps[s].tolist()):
                live = live[gap <= (from_start[live] + np.sqrt(d2[live])) * (1 + SLACK)]
                if not len(live):
                    break
                new = live[(a[live] != j) & (b[live] != j)]
                d = self.distances(x[new], np.int64(j))
                done += len(new)
                first = (d < d1[new]) | ((d == d1[new]) & (j < a[new]))
                second = ~first & (d < d2[new])
                up = new[first]
                b[up], d2[up], a[up], d1[up] = a[up], d1[up], j, d[first]
                b[new[second]], d2[new[second]] = j, d[second]
        return done


def _blocks(batches: Iterator[pd.DataFrame], dim: int) -> Iterator[tuple]:
    """(ids, nulls, vectors) of up to ``BLOCK_ROWS`` rows and a batch more."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        held.append(pdf)
        if sum(map(len, held)) >= BLOCK_ROWS:
            yield _block(held, dim)
            held = []
    if sum(map(len, held)):
        yield _block(held, dim)


def _block(held: list[pd.DataFrame], dim: int) -> tuple:
    some = pd.concat(held)
    x = np.array(some["v"].tolist(), np.int64).reshape(len(some), dim)
    if np.abs(x).max(initial=0) >= LARGEST:
        raise ValueError(f"components must be below {LARGEST} in size")
    return some["vec_id"].to_numpy(np.int64), some["none"].to_numpy(np.uint8), x.astype(np.int32)


def _pass(dim: int, sent, first: bool):
    """One round over the blocks of a partition: new bounds, then the partition's sums by centroid."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search: Search = sent.value
        n, total = np.zeros(search.k, np.int64), np.zeros((search.k, dim), np.int64)
        far, compared = np.zeros(search.k, np.int64), 0
        if first:
            parts = ((*b, None) for b in _blocks(batches, dim))
        else:
            parts = ((r.ids, r.nulls, np.frombuffer(r.vectors, np.int32).reshape(-1, dim), r.near)
                     for pdf in batches for r in pdf.itertuples())
        for ids, nulls, x, near in parts:
            empty = search.start(len(x))
            near = empty if near is None else np.frombuffer(near, empty.dtype).copy()
            compared += search.assign(x, near)
            a = near["a"]
            order = np.argsort(a, kind="stable")
            used, at, count = np.unique(a[order], return_index=True, return_counts=True)
            n[used] += count
            total[used] += np.add.reduceat(x[order].astype(np.int64), at, axis=0)
            np.add.at(far, a, search.distances(x, a))
            yield pd.DataFrame({"ids": [bytes(ids)], "nulls": [bytes(nulls)], "vectors": [x.tobytes()], "near": [near.tobytes()],
                                "cluster": [None], "n": [None], "total": [None], "distance": [None], "compared": [None],
                                "part": ["blocks"]}).astype({"cluster": "Int32", "n": "Int64", "distance": "Int64", "compared": "Int64"})
        used = np.flatnonzero(n)
        if len(used):
            yield pd.DataFrame({"ids": None, "nulls": None, "vectors": None, "near": None, "cluster": used.astype(np.int32),
                                "n": n[used], "total": list(total[used]), "distance": far[used],
                                "compared": np.where(used == used[0], compared, 0), "part": "sums"})
    return run


def _written(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Blocks and sums of a pass, written to the shared folder in a partition folder each."""
    path = new_scratch_path(df.sparkSession, name)
    df.write.partitionBy("part").option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    return table.filter("part = 'blocks'").select("ids", "nulls", "vectors", "near"), table.filter("part = 'sums'")


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """Vectors with the smallest sha256 of ``seed:vec_id``, in that order."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(h.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def shallot(vectors: DataFrame, dim: int, k: int = 16, rounds: int = 3, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """``vectors`` (vec_id long, v array<long> of ``dim`` components) in ``k`` clusters: each vector's (vec_id, cluster,
    distance), and of each centroid in use (cluster, n, distance over all of its vectors, centroid, compared), where
    ``compared`` is the number of distances that the last assignment computed, given with one of the centroids."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    centroids, blocks, before = first_centroids(vectors, k, seed), None, None
    if not len(centroids):
        none = spark.createDataFrame([], "vec_id long, cluster int, distance long")
        return none, spark.createDataFrame([], "cluster int, n long, distance long, centroid array<long>, compared long")
    source = vectors.select(F.coalesce("vec_id", F.lit(0)).alias("vec_id"), F.col("vec_id").isNull().alias("none"), "v")
    for r in range(rounds + 1):
        sent = spark.sparkContext.broadcast(Search(centroids, before))  # k centroids and k x k gaps
        blocks, sums = _written((source if r == 0 else blocks).mapInPandas(_pass(dim, sent, r == 0), TABLE), "clusters")
        if r < rounds:
            before, centroids = centroids, _moved(sums, centroids)
    last = sent
    final = sums.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).cast("long").alias("distance"),
                                        F.sum("compared").alias("compared")).collect()  # a row a centroid
    stats = spark.createDataFrame([(r["cluster"], r["n"], r["distance"], centroids[r["cluster"]].tolist(), r["compared"]) for r in final],
                                  "cluster int, n long, distance long, centroid array<long>, compared long")

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for b in pdf.itertuples():
                x, a = np.frombuffer(b.vectors, np.int32).reshape(-1, dim), np.frombuffer(b.near, last.value.start(0).dtype)["a"]
                ids = pd.array(np.frombuffer(b.ids, np.int64), "Int64")
                ids[np.frombuffer(b.nulls, np.uint8) == 1] = pd.NA
                yield pd.DataFrame({"vec_id": ids, "cluster": a, "distance": last.value.distances(x, a)})

    return blocks.mapInPandas(unpack, "vec_id long, cluster int, distance long"), stats


def _moved(sums: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise exact floor(sum / count) of every centroid in use."""
    long = sums.select("cluster", "n", F.posexplode("total").alias("i", "x"))
    out = centroids.copy()
    for r in long.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect():
        out[r["cluster"], r["i"]] = int(r["x"]) // r["n"]
    return out


def op11_shallot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of floor(64 * x) of the 64-component vectors, with inertia and a digest of each centroid."""
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding").filter(usable("embedding", 64)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 64).cast("long")).alias("v"))
    rows, centroids = shallot(vectors, 64)
    whole = centroids.agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("long")).scalar()
    named = centroids.select("cluster", F.col("distance").alias("cluster_inertia"), whole.alias("inertia"),
                             F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))
    return rows.join(F.broadcast(named), "cluster").select(  # a row a centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(k: int = 16, rounds: int = 3) -> str:
    """The rounds as a chain of tables."""
    parts = ["""v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id,
  list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""c0 AS MATERIALIZED (SELECT CAST(k - 1 AS INTEGER) AS cluster, v FROM
  (SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) AS k FROM v) WHERE k <= {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, v, cluster, distance FROM (SELECT *, row_number() OVER (PARTITION BY row
  ORDER BY distance, cluster) AS k FROM (SELECT v.row, v.vec_id, v.v, c{r}.cluster, CAST(list_sum(list_transform(list_zip(v.v, c{r}.v),
  lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance FROM v CROSS JOIN c{r})) WHERE k = 1)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT c{r}.cluster, coalesce(m.v, c{r}.v) AS v FROM c{r} LEFT JOIN (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (SELECT cluster, i, sum(x) AS s, count(*) AS n
  FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS i FROM a{r}) GROUP BY cluster, i) GROUP BY cluster) AS m USING (cluster))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, a.cluster, distance, CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS c ON a.cluster = c.cluster"""


OP11_SQL = _sql()
