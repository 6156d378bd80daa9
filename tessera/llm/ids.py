"""Token ids of whole texts with a public byte-level BPE file of the ``tokenizers`` library.

The library's full ``encode`` spends most of its time on offsets and alignment that ids don't need. Ids depend on each
pre-token alone, so texts of plain Latin characters are cut into pre-tokens here and each distinct one goes once per
worker through the library's own BPE model. In other texts, pieces between single spaces (no pre-token spans one between two
non-space characters: the space opens the next) go the same way if plain, else through the full ``encode``. The ids
equal ``encode(text, add_special_tokens=False)``. Files with other pre-tokens, a normalizer or another model are encoded by the
library alone.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written

LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Printable ASCII, line feed and Latin letters: here the pre-token rule of the byte-level file needs no more than the
#: character ranges below.
PLAIN = re.compile(f"[ -~\n{LETTERS}]*")
PRE_TOKEN = re.compile(f" ?[{LETTERS}]+|'(?:[sdmt]|ll|ve|re)| ?[0-9]+| ?[!-/:-@\\[-`{{-~]+|[ \n]+(?![^ \n])|[ \n]+")
CUT = re.compile(r"(?<=\S) (?=\S)")
CACHE_PARTS = 1_000_000


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[int, str]:
    """Byte value -> the printable letter that stands for it in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def cuts_like_here(file: dict) -> bool:
    """Whether the file's ids depend on the pre-tokens of ``PRE_TOKEN`` alone: byte-level with its own rule, nothing before,
    and a model that neither drops merges at random nor marks the parts of a word."""
    cut, model = file.get("pre_tokenizer") or {}, file["model"]
    return (file.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
            and not cut.get("add_prefix_space", True) and model.get("type") == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges",
                                               "byte_fallback")))


class Parts(dict):
    """Pre-token -> its ids, learnt when first asked for; cleared when full."""

    def __init__(self, learn: Callable[[str], bytes]):
        super().__init__()
        self.learn = learn

    def __missing__(self, part: str) -> bytes:
        if len(self) >= CACHE_PARTS:
            self.clear()
        ids = self[part] = self.learn(part)
        return ids


class IdEncoder:
    """Whole texts to numpy arrays of ids, with a bounded cache of pieces (cleared when full)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.dtype, self.code = np.dtype("<u2" if small else "<u4"), "H" if small else "I"
        self.cuts = cuts_like_here(json.loads(self.tokenizer.to_str()))
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.parts = Parts(self._learn)

    def _bytes(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder != "little":
            out.byteswap()
        return out.tobytes()

    def _learn(self, part: str) -> bytes:
        """Ids of a pre-token of plain characters, by the library's BPE model."""
        if part.isascii() and part[1:].isalpha():
            shown = "Ġ" + part[1:] if part[0] == " " else part
        else:
            shown = part.encode().decode("latin-1").translate(self.letters)
        return self._bytes([t.id for t in self.model.tokenize(shown)])

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, PRE_TOKEN.findall(text)))

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, self.dtype)
        if not self.cuts or any(s in text for s in self.specials):
            ids = self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        elif PLAIN.fullmatch(text):
            ids = self._plain(text)
        else:
            # Plain stretches of the text go the plain way, the rest through the library's whole encoder.
            first, *rest = CUT.split(text)
            ids = b"".join(
                self._plain(piece) if PLAIN.fullmatch(piece)
                else self._bytes(self.tokenizer.encode(piece, add_special_tokens=False).ids)
                for piece in (first, *(" " + piece for piece in rest)))
        return np.frombuffer(ids, self.dtype)


_ENCODERS: dict[str, IdEncoder] = {}


def encoder(path: str) -> IdEncoder:
    """The worker's encoder of this file (kept between tasks of a worker)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = IdEncoder(path)
    return _ENCODERS[path]


def token_table(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, ids, id_bytes): ids of each whole text and then ``end_id``, as zstd-compressed
    little-endian integers of ``id_bytes`` bytes, written once to the shared folder. Null text counts as empty;
    repeated rows and null ids stay."""
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        enc, zip_ = encoder(tokenizer_path), zstandard.ZstdCompressor(level=1)
        end = np.array([end_id], enc.dtype)
        if end[0] != end_id:
            raise ValueError("end_id must fit the vocabulary's id type")
        for pdf in batches:
            ids = [np.concatenate([enc.encode(t), end]) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": [len(x) for x in ids],
                                "ids": [zip_.compress(x.tobytes()) for x in ids], "id_bytes": enc.dtype.itemsize})

    # Ids cross to pandas as text: a nullable long would become a float there.
    out = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(
        encode, "doc_id string, n_tokens long, ids binary, id_bytes int")
    return written(out.withColumn("doc_id", F.col("doc_id").cast("long")), "token-ids", codec="uncompressed")


def unzipped(ids: bytes, id_bytes: int, decompressor) -> np.ndarray:
    return np.frombuffer(decompressor.decompress(ids), f"<u{id_bytes}")
