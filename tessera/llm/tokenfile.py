"""Operator 4: token-id files with canonical length-limited Huffman codes.

``write_token_files`` encodes documents, counts every id over all documents, derives one length-limited canonical
code and writes blocks of whole documents in ascending ``doc_id``; ``read_token_files`` decodes them.

A file set is a folder of three Parquet tables (any store that Spark writes to):

* ``codebook``  (id, length): the code lengths; canonical order (length, id) fixes the codes.
* ``blocks``    one row a block: shard, block, start (tokens before it in its shard), doc_ids (as text), doc_tokens, the bits
  of all its ids, and ``checkpoints``, the bit offset of every ``STEP``-th id as little-endian 32-bit integers. A block
  needs nothing but the codebook: it is decoded by table lookup, one lane from each checkpoint, all lanes at once.
* ``manifest``  (shard, start): tokens before each shard in the whole set.

Defined results: null text is empty (one end id); an empty table gives empty tables; documents with equal or null
ids are all kept, nulls first; a text of any length stays whole in one block (a block closes at the first document
end after ``BLOCK_TOKENS`` ids); other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.ids import default_path, token_table, unzipped
from tessera.session import new_scratch_path

MAX_LENGTH = 16
BLOCK_TOKENS = 1 << 18
STEP = 128
BLOCK_SCHEMA = ("shard int, block int, start long, n_tokens long, doc_ids array<string>, doc_tokens array<long>, "
                "bits binary, checkpoints binary")


def code_lengths(counts: np.ndarray, limit: int = MAX_LENGTH) -> np.ndarray:
    """Optimal code length of each symbol with count > 0 (others 0), none above ``limit``: package-merge."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    used = used[np.argsort(counts[used], kind="stable")]
    n = len(used)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols don't fit codes of {limit} bits")
    if n < 2:
        lengths[used] = 1
        return lengths
    leaves = counts[used].astype(np.float64)
    level, kinds = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        order = np.argsort(both, kind="stable")
        kinds.append(order < n)
        level = both[order]
    take, got = 2 * n - 2, np.zeros(n, np.int64)
    for kind in reversed(kinds):
        chosen = int(kind[:take].sum())
        got[:chosen] += 1
        take = 2 * (take - chosen)
    lengths[used] = got
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Code of each symbol: consecutive values in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    size = lengths[order]
    if len(order):
        # In units of the longest code, each symbol takes 2^(longest - length): a running sum gives the codes.
        top = int(size[-1])
        span = np.left_shift(1, top - size)
        codes[order] = ((np.cumsum(span) - span) >> (top - size)).astype(np.uint64)
    return codes


def encode_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bits of the ids, most significant first, and the bit offset of every ``STEP``-th id."""
    size = lengths[ids]
    ends = np.cumsum(size)
    at = ends - size
    word, shift = at >> 5, (64 - size - (at & 31)).astype(np.uint64)
    value = np.left_shift(codes[ids], shift)
    n = int(ends[-1] >> 5) + 2 if len(ids) else 0
    # A code touches two 32-bit words at most and codes don't overlap, so sums are unions (exact below 2^53).
    high = np.bincount(word, weights=(value >> np.uint64(32)).astype(np.float64), minlength=n)
    low = np.bincount(word + 1, weights=(value & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=n)
    return (high + low).astype(">u4").tobytes(), at[::STEP].astype("<u4")


class Decoder:
    """Table-driven decoding of blocks: ``table[next 16 bits]`` holds an id and its code length."""

    def __init__(self, lengths: np.ndarray, limit: int = MAX_LENGTH):
        self.limit = limit
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        entry = (order.astype(np.int64) << 5) | lengths[order]
        table = np.repeat(entry, np.left_shift(1, limit - lengths[order])) if len(order) else np.empty(0, np.int64)
        self.table = np.concatenate([table, np.zeros((1 << limit) - len(table), np.int64)])

    def decode(self, bits: bytes, checkpoints: bytes, n: int) -> np.ndarray:
        """The block's ``n`` ids: every lane starts at a checkpoint and takes ``STEP`` ids."""
        raw = np.frombuffer(bits + b"\0\0\0\0", np.uint8).astype(np.int64)
        peek = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
        at = np.frombuffer(checkpoints, "<u4").astype(np.int64)
        out = np.empty((len(at), STEP), np.uint32)
        last, mask = len(peek) - 1, (1 << self.limit) - 1
        for k in range(STEP):
            entry = self.table[(peek[np.minimum(at >> 3, last)] >> (24 - self.limit - (at & 7))) & mask]
            out[:, k] = entry >> 5
            at += entry & 31
        return out.reshape(-1)[:n]


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = 2) -> None:
    """Write the file set of ``docs`` (doc_id, text) to the folder ``path``."""
    spark = docs.sparkSession
    ids = token_table(docs, tokenizer_path or default_path(), end_id)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        unzip, total = zstandard.ZstdDecompressor(), np.zeros(0, np.int64)
        for pdf in batches:
            if len(pdf):
                got = np.bincount(np.concatenate([unzipped(x, b, unzip) for x, b in zip(pdf["ids"], pdf["id_bytes"])]))
                total = np.pad(total, (0, max(0, len(got) - len(total))))
                total[: len(got)] += got
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"id": seen, "n": total[seen]})

    counted = (ids.select("ids", "id_bytes").mapInPandas(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
               .toPandas())  # a row for each id of the vocabulary at most
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 0, np.int64)
    counts[counted["id"]] = counted["n"]
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id int, length int").coalesce(1).write.parquet(
        f"{path}/codebook")
    codes = canonical_codes(lengths)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        unzip, shard = zstandard.ZstdDecompressor(), TaskContext.get().partitionId()
        number, start = 0, 0
        held_ids, held, size = [], [], 0

        def block() -> pd.DataFrame:
            bits, checkpoints = encode_bits(np.concatenate(held), codes, lengths)
            return pd.DataFrame({"shard": [shard], "block": [number], "start": [start], "n_tokens": [size],
                                 "doc_ids": [held_ids], "doc_tokens": [[len(x) for x in held]], "bits": [bits],
                                 "checkpoints": [checkpoints.tobytes()]})

        for pdf in batches:
            for doc_id, raw, width in zip(pdf["doc_id"], pdf["ids"], pdf["id_bytes"]):
                held_ids.append(doc_id)
                held.append(unzipped(raw, width, unzip))
                size += len(held[-1])
                if size >= BLOCK_TOKENS:
                    yield block()
                    number, start = number + 1, start + size
                    held_ids, held, size = [], [], 0
        if held:
            yield block()

    # A shard is a range of doc_id; ranges and the sort inside them give the ascending order of the whole set.
    (ids.select("doc_id", "ids", "id_bytes").repartitionByRange(F.col("doc_id").asc_nulls_first())
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first())
     .withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(blocks, BLOCK_SCHEMA)
     .write.option("compression", "uncompressed").parquet(f"{path}/blocks"))
    # One row a shard, as many as output files: small whatever the data.
    shards = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks").groupBy("shard").agg(
        F.sum("n_tokens").alias("n_tokens"))
    before = F.sum("n_tokens").over(W.orderBy("shard")) - F.col("n_tokens")
    shards.withColumn("start", before).coalesce(1).write.parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; ids as little-endian 32-bit integers."""
    book = spark.read.schema("id int, length int").parquet(f"{path}/codebook").toPandas()
    lengths = np.zeros(int(book["id"].max()) + 1 if len(book) else 0, np.int64)
    lengths[book["id"]] = book["length"]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = Decoder(lengths)
        for pdf in batches:
            for row in pdf.itertuples():
                got = decoder.decode(row.bits, row.checkpoints, row.n_tokens).astype("<u4")
                sizes = np.asarray(row.doc_tokens, np.int64)
                ends = np.cumsum(sizes)
                raw = got.tobytes()
                yield pd.DataFrame({"shard": row.shard, "local": row.start + ends - sizes, "n_tokens": sizes,
                                    "doc_id": pd.array([None if x is None else int(x) for x in row.doc_ids], "Int64"),
                                    "ids": [raw[4 * (e - s): 4 * e] for s, e in zip(sizes.tolist(), ends.tolist())]})

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks").select(
        "shard", "start", "n_tokens", "doc_ids", "doc_tokens", "bits", "checkpoints")
    docs = blocks.mapInPandas(decode, "shard int, doc_id long, local long, n_tokens long, ids binary")
    manifest = spark.read.schema("shard int, n_tokens long, start long").parquet(f"{path}/manifest").select(
        "shard", F.col("start").alias("before"))
    # The manifest has a row for each shard file: broadcast by the session's own size check.
    return docs.join(manifest, "shard").select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens",
                                               "ids")


def op4_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, from the written and re-read files: start, number and crc32 of its ids."""
    from tessera.llm.common import read
    path = new_scratch_path(spark, "token-files")
    write_token_files(read(spark, sf_dir, "documents", "doc_id", "text"), path)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
