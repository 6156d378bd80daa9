"""Vectorised word and shingle hashes of whole texts, and bitmaps of hashes with a fixed size bound."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD_BYTES

_rng = np.random.default_rng(20)
BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE_VALUES = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
SEGMENT = 1 << 20
GROUP_BYTES = 1 << 21
MAX_BITS = 27


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of a 64-bit value over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """Powers of BASE and of its inverse modulo 2^64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> None:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            size = max(n, SEGMENT + 4096)
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, x)]), dtype=np.uint64)
                                  for x in (BASE, inverse))


_powers = _Powers()


class Words:
    """Words of a few texts: hash of each word, byte place of each word, first word of each text."""

    TABLE = WORD_BYTES  # what every byte becomes; spaces part words

    def __init__(self, texts: list):
        raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        self.blob = b"\n".join(raw).translate(self.TABLE)
        buf = np.frombuffer(self.blob, np.uint8)
        inside = np.zeros(len(buf) + 2, np.int8)
        inside[1:-1] = buf != 32
        edges = np.flatnonzero(np.diff(inside))
        self.starts, self.ends = edges[::2], edges[1::2]
        offsets = np.cumsum([0] + [len(x) + 1 for x in raw])[: len(raw) + 1]
        self.first = np.searchsorted(self.starts, offsets)  # words of text k: first[k] to first[k + 1]
        self.counts = np.diff(self.first)
        self.hashes = mix(self._hash(buf))

    def _hash(self, buf: np.ndarray) -> np.ndarray:
        out, k, n = np.empty(len(self.starts), np.uint64), 0, len(self.starts)
        while k < n:
            a = int(self.starts[k])
            stop = max(k + 1, int(np.searchsorted(self.ends, a + SEGMENT, side="right")))
            b = int(self.ends[stop - 1])
            _powers.to(b - a + 1)
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum(BYTE_VALUES[buf[a:b]] * _powers.up[: b - a], out=sums[1:])
            s, e = self.starts[k:stop] - a, self.ends[k:stop] - a
            out[k:stop] = (sums[e] - sums[s]) * _powers.down[s] + (e - s).astype(np.uint64)
            k = stop
        return out

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, first word) of every run of ``size`` words inside one text."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        text = np.repeat(np.arange(len(self.counts)), self.counts)
        at = np.flatnonzero(text[:n] == text[size - 1:])
        total = np.full(n, size, np.uint64)
        for j in range(size):
            total += self.hashes[j: j + n] * PLACE_VALUES[j]
        return mix(total[at]), at

    def words(self, a: int, b: int) -> list[str]:
        return [self.blob[s:e].decode("utf-8", "surrogatepass") for s, e in
                zip(self.starts[a:b].tolist(), self.ends[a:b].tolist())]


def groups(pdf: pd.DataFrame, column: str = "text", limit: int = GROUP_BYTES) -> Iterator[pd.DataFrame]:
    """Slices of a frame with about ``limit`` characters of text each (a longer text comes alone)."""
    sizes = pdf[column].map(lambda t: len(t) if t else 0).to_numpy()
    part = np.cumsum(sizes) // limit
    for a, b in zip(*(lambda c: (c[:-1], c[1:]))(np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(pdf)]]))):
        if b > a:
            yield pdf.iloc[a:b]


def bitmap(hashes: DataFrame, rows: int, most: int = MAX_BITS) -> tuple[np.ndarray, int]:
    """Packed bitmap over the leading bits of the ``hash`` column, sized by ``rows`` (16 bits or more a row) but of
    2^``most`` bits (16 MB) at most, so it may be sent to every task; built from distinct positions in chunks of 2^20."""
    bits = int(min(most, max(16, np.ceil(np.log2(max(rows, 1))) + 5)))
    place = F.shiftrightunsigned("hash", 64 - bits)

    def chunk(pdf: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(1 << 20, np.uint8)
        flags[pdf["place"].to_numpy() & ((1 << 20) - 1)] = 1
        return pd.DataFrame({"chunk": [int(pdf["place"].iloc[0]) >> 20], "bits": [np.packbits(flags, bitorder="little").tobytes()]})

    out = np.zeros(max(1 << bits, 1 << 20) >> 3, np.uint8)
    got = (hashes.select(place.alias("place")).distinct().groupBy(F.shiftright("place", 20).alias("c"))
           .applyInPandas(chunk, "chunk int, bits binary").collect())  # 2^7 rows of 128 KB at most
    for r in got:
        out[r["chunk"] << 17: (r["chunk"] + 1) << 17] = np.frombuffer(r["bits"], np.uint8)
    return out, bits


def in_bitmap(hashes: np.ndarray, packed: np.ndarray, bits: int) -> np.ndarray:
    place = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return (packed[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
