"""Cost-balanced packing of token sequences.

A document's tokens end in a separator. Its full-length cuts fill sequences of their own;
the tails are packed. The cost of a piece of n tokens is estimated as ``linear * n +
quadratic * n^2`` (attention within the piece), and pieces go in descending cost, each to
the lowest-cost sequence that still has room for it. A piece that fits nowhere whole is cut
and its rest goes on to the next. The sequences of a group have exactly as many token places
as the group has tokens: what is left over below a full sequence is carried into the next
group, and at the end of a partition it goes into sequences of powers of two, which need no
padding. So nothing is padded.

A partition is packed alone, in groups of bounded size: no shuffle and bounded memory at
any scale. ``sequence_id`` is the partition's number times 2^32 plus a counter, so a task
that is run again gives the same rows.

Ids are those the ``tokenizers`` library gives by default for the vocabulary's JSON file: the
strings of its added tokens are one id each, found leftmost and longest, and what lies between
them is encoded by the ranks of the same vocabulary.

Defined results: a null text counts as empty and still has its separator; a repeated row is
packed as a document of its own; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quirework.llm.common import keyed_text, sliced

SCHEMA = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long"


def added_tokens(json_path: str) -> dict[str, int]:
    """String to id of the added tokens of a vocabulary's JSON file, which match as they stand."""
    with open(json_path, encoding="utf-8") as f:
        found = json.load(f).get("added_tokens") or []
    for t in found:
        if any(t.get(k) for k in ("lstrip", "rstrip", "single_word", "normalized")):
            raise ValueError(f"added token {t['content']!r} doesn't match as it stands")
    return {t["content"]: t["id"] for t in found}


def rank_encoder(path: str, pattern: str, added: Mapping[str, int] | None = None) -> Callable[[str], list[int]]:
    """Text to ids by a rank file; the strings of ``added`` are single ids, found leftmost and longest."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("pack", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    if not added:
        return plain
    split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")").split

    def encode(text: str) -> list[int]:
        parts = split(text)
        ids = plain(parts[0])
        for token, rest in zip(parts[1::2], parts[2::2], strict=True):
            ids.append(added[token])
            ids += plain(rest)
        return ids

    return encode


def powers_of_two(n: int) -> list[int]:
    """The binary digits of n as descending powers of two."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def balance(lengths: list[int], capacities: list[int], linear: float, quadratic: float) -> list[list[tuple[int, int]]]:
    """Fill bins of the given capacities (sum: that of ``lengths``) with whole or cut items.

    Returns for each item its cuts (bin, length) in order.
    """
    room = np.array(capacities, np.int64)
    cost = np.zeros(len(capacities))
    cuts: list[list[tuple[int, int]]] = [[] for _ in lengths]
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        left = lengths[i]
        while left:
            fits = room >= left
            if not fits.any():
                fits = room > 0
            k = int(np.argmin(np.where(fits, cost, np.inf)))
            n = min(left, int(room[k]))
            room[k] -= n
            cost[k] += linear * n + quadratic * n * n
            cuts[i].append((k, n))
            left -= n
    return cuts


class Packer:
    """Packs one partition. ``pending``: tails (id, doc_tokens, start, ids) not yet placed."""

    def __init__(self, base: int, size: int, linear: float, quadratic: float):
        self.next, self.size, self.linear, self.quadratic = base, size, linear, quadratic
        self.pending: list[tuple[int | None, int, int, np.ndarray]] = []
        self.tokens = 0
        self.rows: list[tuple] = []

    def add(self, key: int | None, ids: np.ndarray) -> None:
        full = len(ids) - len(ids) % self.size
        for at in range(0, full, self.size):
            self._place(key, len(ids), at, ids[at : at + self.size], self.next, 0, self.size)
            self.next += 1
        if full < len(ids):
            self.pending.append((key, len(ids), full, ids[full:]))
            self.tokens += len(ids) - full

    def _place(self, key, total, start, ids, sequence, offset, size) -> None:
        self.rows.append((key, start, len(ids), zlib.crc32(ids.tobytes()), total, sequence, offset, size))

    def pack(self, last: bool) -> None:
        rest = self.tokens % self.size
        capacities = [self.size] * (self.tokens // self.size)
        carried: list[tuple[int | None, int, int, np.ndarray]] = []
        items = sorted(self.pending, key=lambda x: -len(x[3]))
        if last:
            capacities += powers_of_two(rest)
        else:  # the shortest tails, the longest of these cut, wait for the next group
            short = rest
            while short:
                key, total, start, ids = items.pop()
                n = min(short, len(ids))
                carried.append((key, total, start + len(ids) - n, ids[len(ids) - n :]))
                if n < len(ids):
                    items.append((key, total, start, ids[: len(ids) - n]))
                short -= n
        used = [0] * len(capacities)
        for (key, total, start, ids), cuts in zip(items, balance([len(x[3]) for x in items], capacities, self.linear, self.quadratic), strict=True):
            at = 0
            for k, n in cuts:
                self._place(key, total, start + at, ids[at : at + n], self.next + k, used[k], capacities[k])
                used[k] += n
                at += n
        self.next += len(capacities)
        self.pending, self.tokens = carried, 0 if last else rest

    def take(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) if self.rows else [[]] * 8
        self.rows = []
        names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)


def pack_documents(docs: DataFrame, path: str, pattern: str, added: Mapping[str, int] | None = None, size: int = 1024, separator: int = 0, linear: float = 1.0, quadratic: float = 1.0 / 512, group_tokens: int = 1 << 19, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence. ``added``: strings
    that are one id each (see :func:`added_tokens`).

    ``group_tokens`` bounds the tokens that are balanced against each other and so the
    memory of a task; it drops nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = rank_encoder(path, pattern, added)
        packer = Packer(TaskContext.get().partitionId() << 32, size, linear, quadratic)
        for b in sliced(batches, 64):
            for key, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = encode(text)
                ids.append(separator)
                packer.add(key, np.array(ids, "<u4"))
                if packer.tokens >= group_tokens:
                    packer.pack(last=False)
            if len(packer.rows) >= 4096:
                yield packer.take()
        packer.pack(last=True)
        yield packer.take()

    return keyed_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
