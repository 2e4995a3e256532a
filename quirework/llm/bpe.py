"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is cut into halves until a part is at most ``leaf`` characters, a few words; a leaf is
encoded by itself, and neighbours are joined up the tree. Joining re-encodes a window around the
cut. The window grows, doubling, until both its ends lie on *stable* positions: places
where the split pattern must break whatever stands around them, so the tokens outside
cannot change. Such a place is (a) a white-space character after one that is none, or (b)
a change of class out of letters or digits (letter to digit, digit to letter, letter or
digit to other). The pattern's alternatives never span either, and none of them looks back,
so what was encoded before and after such a place stays as it is. Without a stable place
the window reaches the end of the part, and its tokens are simply encoded anew. A join checks that
the tokens it keeps end on the window's edges, and fails if they don't. Decoding concatenates
byte strings up the same kind of tree.

The argument holds for ``PROVEN`` alone; for another pattern the caller names its stable places.

Defined results: a null text counts as empty and has no ids; strings of special tokens are
ordinary text; repeated rows are encoded alike; an empty table gives no rows. A map without
any shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from quirework.llm.common import keyed_text, sliced

#: The split pattern that the argument above is about.
PROVEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Positions that are stable as explained above: lookbehind on the last character of a run.
STABLE = r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])"


class TreeBPE:
    """Encoder and decoder over the ranks of one vocabulary file."""

    def __init__(self, path: str, pattern: str, leaf: int = 64, window: int = 16, stable: str | None = None):
        if stable is None and pattern != PROVEN:
            raise ValueError("name the stable places of this pattern")
        ranks = {}
        with open(path, "rb") as f:
            for line in f:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.core = tiktoken.Encoding("tree", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.stable = regex.compile(STABLE if stable is None else stable)
        self.stable_back = regex.compile(f"(?r)(?:{self.stable.pattern})")
        self.size_of = list(map(len, self.bytes_of))
        self.leaf, self.window, self.joins = max(2, leaf), max(1, window), 0

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, lo: int, hi: int) -> list[int]:
        if hi - lo <= self.leaf:
            return self.core.encode_ordinary(text[lo:hi])
        mid = (lo + hi) // 2
        return self._join(text, lo, mid, hi, self._encode(text, lo, mid), self._encode(text, mid, hi))

    def _join(self, text: str, lo: int, mid: int, hi: int, left: list[int], right: list[int]) -> list[int]:
        self.joins += 1
        a, b = self._edge_left(text, lo, mid), self._edge_right(text, mid, hi)
        keep = len(left) - self._count(left, -1, len(text[a:mid].encode()))
        drop = self._count(right, 1, len(text[mid:b].encode()))
        window = self.core.encode_ordinary(text[a:b])
        del left[keep:]
        left += window
        left += right[drop:] if drop else right
        return left

    def _count(self, ids: list[int], step: int, size: int) -> int:
        """How many tokens, from the first on or (step -1) from the last back, make up exactly ``size`` bytes."""
        n, at = 0, 0 if step > 0 else -1
        while size > 0:
            size -= self.size_of[ids[at]]
            at += step
            n += 1
        if size:
            raise RuntimeError("a token spans a place that should be stable")
        return n

    def _edge_left(self, text: str, lo: int, mid: int) -> int:
        """The last stable position at or before the cut, in growing windows, else ``lo``."""
        w = self.window
        while True:
            start = max(lo, mid - w)
            # a place at the window's start is known by the character before it
            m = self.stable_back.search(text, start, mid)
            if m is not None and m.start() > lo:
                return m.start()
            if start == lo:
                return lo
            w *= 2

    def _edge_right(self, text: str, mid: int, hi: int) -> int:
        """The first stable position after the cut, in growing windows, else ``hi``."""
        w = self.window
        while True:
            end = min(hi, mid + w)
            m = self.stable.search(text, mid + 1, end)
            if m is not None:
                return m.start()
            if end == hi:
                return hi
            w *= 2

    def decode(self, ids: list[int]) -> bytes:
        """Concatenation up the tree; any cut of a token sequence will do."""
        if len(ids) <= 4096:
            table = self.bytes_of
            return b"".join([table[i] for i in ids])
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = 64) -> DataFrame:
    """(id, ids array<int>) of each row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = TreeBPE(path, pattern, leaf)
        for b in sliced(batches, 128):
            ids = [np.array(bpe.encode(x), np.int32) for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    return keyed_text(docs, id_col, text_col).mapInArrow(run, "id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str, leaf: int = 64) -> DataFrame:
    """(id, bytes) from (id, ids); a null list decodes to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = TreeBPE(path, pattern, leaf)
        for b in sliced(batches, 128):
            out = [bpe.decode(x or []) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(out, pa.binary())], ["id", "bytes"])

    return encoded.select("id", "ids").mapInArrow(run, "id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = 64) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encode, then decode the ids, in one pass.

    ``ids_sha256`` is over the ids as little-endian unsigned 32-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = TreeBPE(path, pattern, leaf)
        for b in sliced(batches, 128):
            n, a, d = [], [], []
            for text in b.column("text").to_pylist():
                ids = bpe.encode(text)
                n.append(len(ids))
                a.append(hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
                d.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(a), pa.array(d)], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return keyed_text(docs, id_col, text_col).mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
