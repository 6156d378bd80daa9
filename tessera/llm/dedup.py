"""Operator 2: near-duplicate classes by improved consistent weighted sampling (ICWS) over TF-IDF shingles.

A document is its multiset of shingles of ``SHINGLE`` words (all its words, if fewer), weighted tf * idf. Document
frequencies are counted over all documents in ``DF_BUCKETS`` hash buckets (the hashing trick, so the table sent to the
tasks has a fixed size); idf = 1 + IDF_SPAN * ln((N + 1) / (df + 1)) / ln(N + 1) is kept in a narrow band so that what
a large group of copies shares doesn't weigh much less than what one of them changed. ICWS draws ``BANDS * ROWS`` samples
(shingle, level) whose collision probability is the weighted Jaccard similarity; bands of ``ROWS`` samples propose
candidates, and a link stands only if the weighted Jaccard similarity of the two whole texts is at least ``SIMILARITY``.

Scale. Equal texts are collapsed first, however many there are. Documents that share a band's bucket are joined to the
bucket's smallest member only (no pairs are made); the connected components of these proposals are candidate clusters, so
each text travels to its cluster once. Inside a cluster, all pairs are compared by samples and the likely ones by
their texts, likeliest first, skipping pairs already connected: a task emits tree links, at most one less than its
members. A large cluster is cut into blocks, and every pair of blocks is a task of its own, so no task holds more than
two blocks. The final classes are the connected components of the verified links.

Defined results: one row a document, repeated rows and null ids included; a null text is a class of its own; equal
texts, empty ones included, are one class; texts without words are otherwise alone; the class id is the least doc_id in
it, and one row of each class (least doc_id, nulls last) is marked ``keep``; an empty table gives no rows; other
columns are ignored (and kept by ``drop_near_duplicates``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import fresh, read, written
from tessera.llm.graph import components
from tessera.llm.hashing import PLACE_VALUES, Words, groups, mix

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
DF_BUCKETS = 1 << 18
IDF_SPAN = 0.2
#: Share of equal samples below which a pair isn't compared by text: 3.5 standard deviations under 0.8.
LIKELY = 0.62
BLOCK_DOCS, BLOCK_CHARS = 512, 8 << 20
BROADCAST_ROWS = 1_000_000


def document_shingles(texts: list) -> Iterator[np.ndarray]:
    """Hashes of each text's shingles, sorted, repeats included."""
    found = Words(texts)
    hashes, at = found.shingles(SHINGLE)
    cuts = np.searchsorted(at, found.first)
    for k, n in enumerate(found.counts.tolist()):
        if n >= SHINGLE or not n:
            yield np.sort(hashes[cuts[k]: cuts[k + 1]])
        else:
            own = found.hashes[found.first[k]: found.first[k + 1]]
            yield mix(np.array([(own * PLACE_VALUES[:n]).sum() + np.uint64(n)], np.uint64))


def weighted(shingles: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (sorted) and their tf * idf."""
    if not len(shingles):
        return shingles, np.empty(0, np.float32)
    edge = np.flatnonzero(np.concatenate([[True], shingles[1:] != shingles[:-1]]))
    distinct = shingles[edge]
    tf = np.diff(np.append(edge, len(shingles)))
    return distinct, (tf * idf[bucket(distinct)]).astype(np.float32)


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(DF_BUCKETS - 1)).astype(np.int64)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """idf of each hash bucket, from the document frequencies over all documents."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(DF_BUCKETS, np.int64), 0
        for pdf in batches:
            for part in groups(pdf):
                lists = list(document_shingles(list(part["text"])))
                n += len(lists)
                own = np.repeat(np.arange(len(lists)), [len(x) for x in lists]) * DF_BUCKETS
                keys = np.sort(own + bucket(np.concatenate(lists)))
                keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
                df += np.bincount(keys % DF_BUCKETS, minlength=DF_BUCKETS)
        seen = np.flatnonzero(df)
        yield pd.DataFrame({"bucket": np.append(seen, -1), "n": np.append(df[seen], n)})

    got = (docs.select("text").mapInPandas(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
           .toPandas())  # DF_BUCKETS + 1 rows at most
    total = int(got.loc[got["bucket"] < 0, "n"].sum())
    df = np.zeros(DF_BUCKETS)
    got = got[got["bucket"] >= 0]
    df[got["bucket"]] = got["n"]
    return (1 + IDF_SPAN * np.log((total + 1) / (np.minimum(df, total) + 1)) / max(np.log(total + 1), 1)).astype(np.float32)


class Sampler:
    """ICWS: for sample k, shingle s of weight w has level t = floor(ln w / r + beta) and rank
    ln c - r * (t - beta + 1) with r, c ~ Gamma(2, 1) and beta ~ U(0, 1); the least rank's (s, t) is the sample. The
    triples (r, c, beta) are drawn from a fixed table by a hash of (s, k)."""

    TABLE = 1 << 16

    def __init__(self, samples: int = BANDS * ROWS, seed: int = 7):
        rng = np.random.default_rng(seed)
        r = rng.gamma(2, 1, self.TABLE).astype(np.float32) + np.float32(1e-6)
        beta = rng.random(self.TABLE, np.float32)
        self.r, self.beta, self.inverse = r, beta, 1 / r
        self.rest = (np.log(rng.gamma(2, 1, self.TABLE) + 1e-12) + r * beta - r).astype(np.float32)
        self.factors = rng.integers(1, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.level = np.uint64(int(rng.integers(1, 1 << 63)) * 2 + 1)

    def samples(self, shingles: np.ndarray, weights: np.ndarray, block: int = 2048) -> np.ndarray:
        """One 32-bit value a sample; equal values stand for equal (shingle, level)."""
        best = np.full(len(self.factors), np.inf, np.float32)
        out = np.zeros(len(self.factors), np.uint64)
        log_w = np.log(weights)
        column = np.arange(len(self.factors))
        for a in range(0, len(shingles), block):
            s = shingles[a: a + block]
            place = ((s[:, None] * self.factors) >> np.uint64(48)).astype(np.int64)
            t = log_w[a: a + block, None] * self.inverse[place]
            t += self.beta[place]
            np.floor(t, out=t)
            rank = self.rest[place] - self.r[place] * t
            at = rank.argmin(0)
            least = rank[at, column]
            better = least < best
            value = s[at] * self.level + t[at, column].astype(np.int64).astype(np.uint64)
            out[better], best[better] = value[better], least[better]
        return (mix(out) >> np.uint64(32)).astype("<u4")


def signatures(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """(row, doc_id, text_key, n_chars, samples, bands): one row a document, written once so that row numbers stay."""
    sent = docs.sparkSession.sparkContext.broadcast(idf)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler, idf = Sampler(), sent.value
        for pdf in batches:
            for part in groups(pdf):
                rows = []
                for shingles in document_shingles(list(part["text"])):
                    if not len(shingles):
                        rows.append((None, None))
                        continue
                    got = sampler.samples(*weighted(shingles, idf))
                    band = (got.reshape(BANDS, ROWS).astype(np.uint64) * PLACE_VALUES[:ROWS]).sum(1, dtype=np.uint64)
                    rows.append((got.tobytes(), mix(band).view(np.int64)))
                yield pd.DataFrame({"doc_id": part["doc_id"], "text_key": part["text_key"], "n_chars": part["n_chars"],
                                    "samples": [x[0] for x in rows], "bands": [x[1] for x in rows]})

    keyed = docs.select(F.col("doc_id").cast("string"), "text", text_key().alias("text_key"),
                        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"))
    out = keyed.mapInPandas(sign, "doc_id string, text_key string, n_chars long, samples binary, bands array<long>")
    out = out.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("row", F.monotonically_increasing_id())
    # A null text has a key of its own.
    return written(out.withColumn("text_key", F.coalesce("text_key", F.concat(F.lit("null "), F.col("row")))), "signatures")


def text_key():
    return F.md5(F.col("text").cast("binary"))


def proposals(nodes: DataFrame) -> DataFrame:
    """(a, b): every member of a band's bucket and the bucket's smallest member."""
    bands = nodes.filter("bands is not null").select("node", F.posexplode("bands").alias("band", "value"))
    least = bands.groupBy("band", "value").agg(F.min("node").alias("least"), F.count("*").alias("n")).filter("n > 1")
    return bands.join(least, ["band", "value"]).filter("node > least").select(
        F.col("node").alias("a"), F.col("least").alias("b")).distinct()


def verified_links(members: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """(a, b): tree links of similarity or more inside each cell of ``members`` (component, i, j, block, node, samples,
    text). In a cell i = j all pairs count, in others those between its two blocks."""
    sent = members.sparkSession.sparkContext.broadcast(idf)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in batches:
            pdf["cell"] = list(zip(pdf["component"], pdf["i"], pdf["j"]))
            for cell, part in pdf.groupby("cell", sort=False):
                if held and held[0]["cell"].iloc[0] != cell:
                    yield tree_links(pd.concat(held), sent.value, similarity)
                    held = []
                held.append(part)
        if held:
            yield tree_links(pd.concat(held), sent.value, similarity)

    cell = ["component", "i", "j"]
    return (members.repartition(*cell).sortWithinPartitions(*cell)
            .mapInPandas(compare, "a long, b long, similarity double"))


def tree_links(cell: pd.DataFrame, idf: np.ndarray, similarity: float) -> pd.DataFrame:
    node, block = cell["node"].to_numpy(), cell["block"].to_numpy()
    own = bool((cell["i"].to_numpy() == cell["j"].to_numpy())[0])
    samples = np.frombuffer(b"".join(cell["samples"]), "<u4").reshape(len(cell), -1)
    need = int(np.ceil(LIKELY * samples.shape[1]))
    texts, sets, parent = list(cell["text"]), {}, list(range(len(cell)))

    def shingle_set(k: int) -> tuple[np.ndarray, np.ndarray]:
        if k not in sets:
            sets[k] = weighted(next(document_shingles([texts[k]])), idf)
        return sets[k]

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    pairs = []
    for a in range(len(node) - 1):
        equal = (samples[a + 1:] == samples[a]).sum(1)
        b = np.flatnonzero((equal >= need) & (own | (block[a + 1:] != block[a])))
        if len(b):
            pairs.append(np.column_stack([equal[b], np.full(len(b), a), b + a + 1]))
    rows = []
    if pairs:
        pairs = np.concatenate(pairs)
        for _, a, b in pairs[np.argsort(-pairs[:, 0], kind="stable")].tolist():
            if root(a) != root(b):
                value = weighted_jaccard(shingle_set(a), shingle_set(b))
                if value >= similarity:
                    parent[root(a)] = root(b)
                    rows.append((int(node[a]), int(node[b]), value))
    return pd.DataFrame(rows, columns=["a", "b", "similarity"])


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of minima over sum of maxima of the weights; 0 if either has no shingle."""
    (ha, wa), (hb, wb) = a, b
    if not len(ha) or not len(hb):
        return 0.0
    at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    same = hb[at] == ha
    shared = float(np.minimum(wa[same], wb[at[same]]).sum(dtype=np.float64))
    return shared / (float(wa.sum(dtype=np.float64)) + float(wb.sum(dtype=np.float64)) - shared)


def near_duplicate_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(row, doc_id, text_key, class, class_id, class_size, keep) for each document of ``docs`` (doc_id, text)."""
    idf = inverse_frequencies(docs)
    rows = signatures(docs, idf)
    # One node a distinct text: its smallest row.
    nodes = rows.groupBy("text_key").agg(F.min("row").alias("node"), F.first("n_chars").alias("n_chars"),
                                         F.first("samples").alias("samples"), F.first("bands").alias("bands"))
    nodes = written(nodes, "texts")
    cluster = written(components(proposals(nodes), "a", "b"), "clusters")
    members = (nodes.join(cluster, "node")
               .select("node", "component", "samples", "text_key", "n_chars"))
    size = members.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars")).select(
        "component", F.ceil(F.greatest(F.col("n") / BLOCK_DOCS, F.col("chars") / BLOCK_CHARS, F.lit(1))).cast("int")
        .alias("blocks"))
    members = (members.join(size, "component")
               .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    # Texts once: only documents of clusters, one copy of each text, found by row.
    texts = texts_of(docs, members.select("text_key"))
    members = members.join(texts, "text_key")
    cells = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node",
        "samples", "text")
    links = written(verified_links(cells, idf, similarity), "verified-links")
    classes = components(links, "a", "b").select("node", F.col("component").alias("class"))
    by_text = nodes.select("text_key", "node").join(classes, "node", "left").select(
        "text_key", F.coalesce("class", "node").alias("class"))
    found = rows.select("row", "doc_id", "text_key").join(by_text, "text_key")
    heads = found.groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("head"), F.count("*").alias("class_size"))
    return found.join(heads, "class").select(
        "row", "doc_id", "text_key", "class", F.col("head.doc_id").alias("class_id"), "class_size",
        (F.col("row") == F.col("head.row")).alias("keep"))


def texts_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(text_key, text): one copy of each text whose key is asked for."""
    keys = written(keys.distinct(), "text-keys")
    some = docs.filter("text is not null").select(text_key().alias("text_key"), "text").join(
        sized(keys), "text_key", "left_semi")
    return some.groupBy("text_key").agg(F.first("text").alias("text"))


def sized(df: DataFrame) -> DataFrame:
    """A broadcast hint where a count shows that the rows (of a few dozen bytes) are at most ``BROADCAST_ROWS``."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class; all columns are kept."""
    classes = written(near_duplicate_classes(docs, similarity), "classes")
    own = classes.groupBy("doc_id", "text_key").agg(F.max("keep").alias("keep"), F.count("*").alias("n"))
    gone = written(own.filter("not keep").select("doc_id", "text_key"), "gone")
    twice = written(own.filter("keep and n > 1").select("doc_id", "text_key"), "repeated")
    # Null texts and ids are each a class of their own, so never gone unless repeated as wholes.
    key = fresh(docs, "_key")
    left = docs.withColumn(key, F.struct(F.col("doc_id").cast("long").alias("d"), text_key().alias("t")))
    same = lambda k: F.col(f"{key}.d").eqNullSafe(k["doc_id"]) & F.col(f"{key}.t").eqNullSafe(k["text_key"])
    once = left.join(sized(gone), same(gone), "left_anti").join(sized(twice), same(twice), "left_anti")
    again = left.join(sized(twice), same(twice), "left_semi").dropDuplicates([key])
    return once.unionByName(again).drop(key)


def op2_icws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return near_duplicate_classes(read(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "class_id", "class_size", "keep")
