"""Operator 6: order-preserving packing of documents into fixed token windows by dynamic programming.

Documents are taken in ascending ``doc_id`` as one stream of ids, each closed by ``end_id``. Consecutive cuts of the
stream make the sequences, so order is kept and every id lies in exactly one piece. Cuts lie at document ends,
at sentence ends, or, where a sentence runs longer than ``LONG_SENTENCE`` ids, every ``HARD_STEP`` ids inside it.
The cost of a plan is the padding of every sequence (up to ``window``; none where the length is a power of two), a
penalty for each truncated sentence or document, and a small cost a sequence; the plan with the least cost is found
by ``cost[j] = min over i of cost[i] + padding(i, j) + penalty(j)``. As padding is linear in both ends, the minimum
over the last ``window`` ids is kept in a monotone queue, and lengths that are powers of two are looked up besides.

Scale: ranges of ``doc_id`` are packed independently (one unfilled sequence a range), and inside a range the stream
is planned ``CHUNK_TOKENS`` at a time; the last sequence of a chunk is re-planned with the next one.

Defined results: null text is empty (its piece is the end id alone); an empty table gives no rows; equal or null ids
are all kept (nulls first); a text of any length is cut into as many pieces as needed; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import read
from tessera.llm.ids import default_path, encoder, token_table, unzipped

WINDOW = 1024
SENTENCE_COST = 4
HARD_COST = 48
SEQUENCE_COST = 96
LONG_SENTENCE = 128
HARD_STEP = 64
CHUNK_TOKENS = 1 << 20
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def best_cuts(positions: list[int], penalties: list[int], window: int, sequence_cost: int) -> list[int]:
    """Indices of the cheapest cuts through ``positions`` (ascending from 0, no gap above ``window``), from the first
    to the last position."""
    n = len(positions)
    cost, back = [0] * n, [0] * n
    queue, keys, head = [0], [0], 0
    froms, first = power_pairs(np.array(positions), window)
    for j in range(1, n):
        p = positions[j]
        while positions[queue[head]] < p - window:
            head += 1
        i = queue[head]
        best = keys[head] + window - p
        for k in froms[first[j]: first[j + 1]]:
            if cost[k] < best:
                best, i = cost[k], k
        cost[j] = best = best + penalties[j] + sequence_cost
        back[j] = i
        best += p
        while len(queue) > head and keys[-1] >= best:
            queue.pop()
            keys.pop()
        queue.append(j)
        keys.append(best)
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


def power_pairs(positions: np.ndarray, window: int) -> tuple[list[int], list[int]]:
    """For each position, the positions that lie a power of two below ``window`` before it: their indices, and where
    each position's own begin."""
    to, froms = [], []
    for length in (1 << k for k in range(window.bit_length()) if 1 << k < window):
        at = np.searchsorted(positions, positions - length)
        hit = np.flatnonzero(positions[at] == positions - length)
        to.append(hit)
        froms.append(at[hit])
    to, froms = np.concatenate(to), np.concatenate(froms)
    order = np.argsort(to, kind="stable")
    first = np.searchsorted(to[order], np.arange(len(positions) + 1))
    return froms[order].tolist(), first.tolist()


class SentenceEnds:
    """Finds sentence ends in ids: a token that closes a sentence, before one that opens a word or line."""

    def __init__(self, tokenizer_path: str):
        vocab = encoder(tokenizer_path).tokenizer.get_vocab()
        size = max(vocab.values()) + 1
        self.closes, self.line, self.opens = (np.zeros(size, bool) for _ in range(3))
        for token, i in vocab.items():
            self.line[i] = token.endswith("Ċ")
            self.closes[i] = self.line[i] or token.rstrip("\"')]}").endswith((".", "!", "?"))
            self.opens[i] = token.startswith(("Ġ", "Ċ"))

    def cuts(self, ids: np.ndarray) -> np.ndarray:
        """Positions inside ``ids`` (0 and the end excluded) before which a sentence has ended."""
        return np.flatnonzero(self.closes[ids[:-1]] & (self.opens[ids[1:]] | self.line[ids[:-1]])) + 1


def candidates(ids: np.ndarray, sentence_ends: np.ndarray, costs: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions in one document piece, its end included, and their penalties."""
    sentence, hard, window = costs
    places = np.concatenate([sentence_ends, [len(ids)]])
    gaps = np.diff(places, prepend=0)
    penalty = np.where(places == len(ids), 0, sentence)
    inner = []
    for k in np.flatnonzero(gaps > min(LONG_SENTENCE, window)):
        inner.append(np.arange(places[k] - gaps[k] + min(HARD_STEP, window), places[k], min(HARD_STEP, window)))
    if inner:
        inner = np.concatenate(inner)
        places, penalty = np.concatenate([places, inner]), np.concatenate([penalty, np.full(len(inner), hard)])
        order = np.argsort(places, kind="stable")
        places, penalty = places[order], penalty[order]
    return places, penalty


def pack_documents(docs: DataFrame, window: int = WINDOW, tokenizer_path: str | None = None, end_id: int = 0,
                   sentence_cost: int = SENTENCE_COST, hard_cost: int = HARD_COST,
                   sequence_cost: int = SEQUENCE_COST) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): document, start and length in its ids, ``doc_tokens`` (with the end id),
    sequence, offset there, and the piece's ids as little-endian 32-bit integers. ``sequence_id`` ascends with the
    stream: the range's number times 2^32, plus a count."""
    tokenizer_path = tokenizer_path or default_path()
    costs = (sentence_cost, hard_cost, window)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        unzip, sentences = zstandard.ZstdDecompressor(), None
        sequence = TaskContext.get().partitionId() << 32
        held, size = [], 0  # (doc_id, start, doc_tokens, ids) of the stream not yet written

        def flush(last: bool) -> pd.DataFrame:
            nonlocal held, size, sequence
            places, penalty, at = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 0
            for _, start, total, ids in held:
                own, cost = candidates(ids, sentences.cuts(ids), costs)
                places.append(own + at)
                penalty.append(cost)
                at += len(ids)
            places = np.concatenate(places)
            chosen = places[best_cuts(places.tolist(), np.concatenate(penalty).tolist(), window, sequence_cost)]
            done = at if last else int(chosen[-2])
            opens = chosen[:-1] if last else chosen[:-2]
            ends = np.cumsum([len(x[3]) for x in held])
            begins = np.concatenate([[0], ends[:-1]])
            breaks = np.union1d(begins[begins < done], opens)
            stops = np.append(breaks[1:], done)
            item = np.searchsorted(ends, breaks, side="right")
            seq = np.searchsorted(opens, breaks, side="right") - 1
            rows = []
            for a, b, k, s in zip(breaks.tolist(), stops.tolist(), item.tolist(), seq.tolist()):
                doc_id, start, total, ids = held[k]
                a0 = a - int(begins[k])
                rows.append((doc_id, start + a0, b - a, total, sequence + s, a - int(opens[s]),
                             ids[a0: a0 + b - a].astype("<u4").tobytes()))
            sequence += len(opens)
            rest = []
            for k in range(int(np.searchsorted(ends, done, side="right")), len(held)):
                doc_id, start, total, ids = held[k]
                cut = max(0, done - int(begins[k]))
                rest.append((doc_id, start + cut, total, ids[cut:]))
            held, size = rest, at - done
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"], dtype=object)
            return out.assign(doc_id=pd.array(out["doc_id"].tolist(), "Int64"))

        for pdf in batches:
            for doc_id, raw, width in zip(pdf["doc_id"], pdf["ids"], pdf["id_bytes"]):
                ids = unzipped(raw, width, unzip)
                sentences = sentences or SentenceEnds(tokenizer_path)
                held.append((None if doc_id is None else int(doc_id), 0, len(ids), ids))
                size += len(ids)
                if size >= CHUNK_TOKENS:
                    yield flush(False)
        if held:
            yield flush(True)

    ids = token_table(docs, tokenizer_path, end_id)
    return (ids.select("doc_id", "ids", "id_bytes").repartitionByRange(F.col("doc_id").asc_nulls_first())
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first())
            .withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(pack, SCHEMA))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 1024 ids: one row a piece."""
    return digests(pack_documents(read(spark, sf_dir, "documents", "doc_id", "text")))


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")
