"""Byte-level BPE: an encoder and decoder over a rank file.

Bytes stand for Latin-1 characters, so that an Aho-Corasick automaton over the vocabulary
(pyahocorasick works on characters) finds the tokens in a piece of text. A piece is
encoded from left to right: at each place the longest token is tried first; it is taken
if it may stand beside the token before it, else the next shorter one, and where none is
left the token before is taken back. Two tokens may stand side by side exactly if merging
their joined bytes by rank gives these two again; the answers are kept by pair. An
encoding whose neighbours all pass is the one that merging by rank gives, and for each
place there is only one, so a place that has failed is never tried again and the work
grows in proportion to the piece.

Pieces are what the vocabulary's pattern matches; each is encoded alone. Texts repeat
pieces, so a worker keeps the encodings it has made, up to a bound.

Edge cases: a null text is encoded as the empty one, which has no ids. Rows with
the same id are each encoded. The whole text is encoded whatever its length; texts
that are one enormous piece take time in proportion to it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import table

#: Pieces, and pairs of tokens, of which a worker keeps the answer; beyond that it starts anew.
KEPT_PIECES = 1 << 20
KEPT_PAIRS = 1 << 21
#: Pieces longer than this are not kept.
LONG_PIECE = 256


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class _Matches:
    """The same as ``Bpe._options`` for a long piece, in flat arrays: some dozen bytes a match instead of a list a place."""

    def __init__(self, found: Iterator[tuple[int, tuple[int, int]]], n: int):
        rows = np.fromiter(((end + 1 - size, size, token) for end, (size, token) in found), dtype=[("at", "<i8"), ("size", "<i4"), ("id", "<i4")])
        self.rows = rows[np.argsort(rows["at"], kind="stable")]
        self.first = np.searchsorted(self.rows["at"], np.arange(n + 1))

    def __getitem__(self, place: int) -> list[tuple[int, int]]:
        rows = self.rows[self.first[place] : self.first[place + 1]]
        return list(zip(rows["size"].tolist(), rows["id"].tolist()))


class Bpe:
    """Encoder and decoder for one rank file; build one in each worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.vocab = {i: t for t, i in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.auto = ahocorasick.Automaton()
        for t, i in ranks.items():
            self.auto.add_word(t.decode("latin-1"), (len(t), i))
        self.auto.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[bytes]:
        """Merge the neighbours of lowest rank, leftmost first, until none can be merged."""
        parts = [data[k : k + 1] for k in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            rank, at = min((ranks.get(a + b, 1 << 62), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 62:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def beside(self, a: int, b: int) -> bool:
        """Whether merging leaves token ``a`` followed by token ``b`` as they are."""
        fits = self.pairs.get((a, b))
        if fits is None:
            left, right = self.vocab[a], self.vocab[b]
            fits = self.merge(left + right) == [left, right]
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            self.pairs[a, b] = fits
        return fits

    def _options(self, data: bytes) -> list[list[tuple[int, int]]]:
        """For each place the tokens (size, id) that begin there; ends come in order, so the longest is last."""
        options: list[list[tuple[int, int]]] = [[] for _ in data]
        for end, token in self.auto.iter(data.decode("latin-1")):
            options[end + 1 - token[0]].append(token)
        return options

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        options = self._options(data) if n <= LONG_PIECE else _Matches(self.auto.iter(data.decode("latin-1")), n)
        alive = bytearray(b"\x01") * (n + 1)
        ids: list[int] = []
        tried: list[int] = []
        place, k = 0, len(options[0]) - 1
        while place < n:
            here = options[place]
            while k >= 0 and not (alive[place + here[k][0]] and (not ids or self.beside(ids[-1], here[k][1]))):
                k -= 1
            if k >= 0:
                ids.append(here[k][1])
                tried.append(k)
                place += here[k][0]
                k = len(options[place]) - 1 if place < n else 0
            else:
                if not ids:
                    raise ValueError("the vocabulary has no encoding for these bytes")
                alive[place] = 0
                place -= len(self.vocab[ids.pop()])
                k = tried.pop() - 1
        return ids

    def _packed(self, piece: str) -> bytes:
        packed = np.array(self.encode_piece(piece.encode()), dtype="<u4").tobytes()
        if len(piece) <= LONG_PIECE:
            if len(self.pieces) >= KEPT_PIECES:
                self.pieces.clear()
            self.pieces[piece] = packed
        return packed

    def encode_packed(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        kept = self.pieces.get
        return b"".join([kept(p) or self._packed(p) for p in self.find(text)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocab.__getitem__, ids))


@lru_cache(maxsize=1)
def coder(path: str, pattern: str) -> Bpe:
    """One coder for all tasks that a Python worker runs in turn."""
    return Bpe(read_ranks(path), pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return (id, ids): one row per row of ``docs``; ids are packed little-endian 32-bit."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for b in batches:
            packed = [bpe.encode_packed(t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary())], names=[id_col, "ids"])

    picked = docs.select(id_col, text_col)
    return picked.mapInArrow(work, f"`{id_col}` {picked.schema[id_col].dataType.simpleString()}, ids binary")


def decode_documents(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """Return (id, ids, decoded): the bytes that packed ``ids`` stand for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for b in batches:
            got = [bpe.decode(np.frombuffer(x.as_py(), dtype="<u4").tolist()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.binary())], names=[id_col, "ids", "decoded"])

    picked = encoded.select(id_col, "ids")
    return picked.mapInArrow(work, f"`{id_col}` {picked.schema[id_col].dataType.simpleString()}, ids binary, decoded binary")


def digest_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode the ids again and return (id, n_tokens, ids_sha256, decoded_sha256)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for t in b.column(1):
                packed = bpe.encode_packed(t.as_py() or "")
                n.append(len(packed) // 4)
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(np.frombuffer(packed, dtype="<u4").tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    picked = docs.select(id_col, text_col)
    return picked.mapInArrow(work, f"`{id_col}` {picked.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
