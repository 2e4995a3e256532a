"""Language-model scoring by context-tree weighting over all training texts.

The model. A text is its UTF-8 bytes, A-Z lower-cased, and one end symbol (byte 0xFF, which
UTF-8 never has). A byte is decomposed into eight binary decisions; each of their 255 nodes
has a context tree over the preceding ``DEPTH`` bytes. In a tree every context of every depth
holds a Krichevsky-Trofimov estimate over its counts, and the weighted probability of a
context is half its own estimate and half the product of its children's. A bit is
predicted by mixing the estimates of all depths on its path with the weights this gives,
after all training texts have been seen; a byte costs the product of its bits. The
model is a proper distribution: no smoothing constants, no cut-off, no sample.

The computation. Documents are cut into chunks, and chunks are dealt to blocks of bounded size.

1. A block counts its distinct (context, byte) grams and distinct words.
2. Lists of them travel as sorted, compressed arrays through a butterfly: ``fan`` blocks make a
   rack, in which their lists meet by ``fan`` ranges of hashes and are added up; ``fan`` racks make
   the next one, in which each range is cut into ``fan`` finer ones, and so on until one rack is
   left. So each level has ``fan`` rows a block, and a task holds ``fan`` lists, whatever the size of
   the corpus. The totals at the end are what the corpus gives: they cover every training text
   and grow with it.
3. Distinct grams are grouped by their two nearest context bytes. A context of more than
   ``group_grams`` of them is split by its third byte, and by its fourth; below four bytes there are
   at most 65,536. Each group builds its subtrees and sends the sums that the levels above need:
   those of the 257 shortest contexts and of the split ones, of which there are at most 2 x
   ``most_split``. These levels are solved once and go out with the closure.
4. The groups turn each distinct gram into its log probability, which goes back through the
   butterfly to the blocks that hold the gram, as do the word counts for the base score.
5. Each block is scored against the lists it asked for.

So no table that grows with the data is broadcast or collected, and every task's memory is
bounded by a block, ``fan`` lists or a tree group. All steps between are tables in the
shared folder, the compressed chunks among them, so what is scored is what was counted. Trees are
built twice, for the sums and for the probabilities: a rebuild is cheaper than eight numbers a
gram on disk.

Words are compared by 64-bit hashes (a billion distinct words: 3 % chance of one collision).

Defined results: a null or empty text is just the end symbol; a null id counts as the empty
string for the fold, so it trains; repeated rows train and are scored each; without training
texts every bit has probability 1/2; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.llm.common import discard, materialize, sliced

DEPTH = 5
TOP = 2  # the least depth of a tree group's contexts
U8, U16 = np.uint64(8), np.uint64(16)
TEXT_BITS = 64 - 8 * (DEPTH + 1)  # what a gram leaves for the text's number in a sort key
LN_HALF = float(np.log(0.5))
BATCH_BYTES = 1_000_000
CHUNK_CHARS = 131_072
LISTS = "kind string, rack int, range int, src int, blob binary"


# --- arrays as compressed bytes ------------------------------------------------------------


def squeeze(a: np.ndarray) -> bytes:
    """Byte planes, compressed."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expand(b: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(raw.T).view(kind).reshape(-1)


def pack(keys: np.ndarray, values: np.ndarray) -> bytes:
    """Sorted keys, as differences, with their values (counts or log probabilities)."""
    a, b = squeeze(np.diff(keys, prepend=np.uint64(0))), squeeze(values)
    return len(a).to_bytes(4, "little") + a + b


def unpack(blob: bytes, kind: type) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:4], "little")
    return np.cumsum(expand(blob[4 : 4 + n], np.uint64), dtype=np.uint64), expand(blob[4 + n :], kind)


def add_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


def scramble(k: np.ndarray) -> np.ndarray:
    """A fixed mixing of grams to 64 bits, for even ranges."""
    h = (k ^ (k >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def range_at(h: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Which of the 2^(level * bits) equal ranges of 64-bit values."""
    return (h >> np.uint64(64 - level * bits)).astype(np.int64)


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, rows in their order) of the buckets that occur."""
    if len(bucket):
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=bucket[order[0]] - 1))
        for rows in np.split(order, edges[1:]):
            yield int(bucket[rows[0]]), rows


# --- texts to grams and words ----------------------------------------------------------------


def gram_runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct grams, start of each one's run, text number of each place in the runs).

    A gram: the nearest context byte in the highest place, then the further ones, the byte
    itself lowest. Text numbers ride along in the low bits of the sort.
    """
    pad = b"\0" * DEPTH
    raw = np.frombuffer(b"".join([pad + t + b"\xff" for t in texts]), np.uint8).astype(np.uint64)
    n = len(raw) - DEPTH
    key = raw[DEPTH:].copy()
    for j in range(1, DEPTH + 1):
        key |= raw[DEPTH - j : DEPTH - j + n] << np.uint64(8 * (DEPTH + 1 - j))
    sizes = np.array([len(t) + 1 for t in texts])
    real = np.ones(n, bool)
    starts = np.cumsum(sizes + DEPTH)[:-1] - DEPTH
    for j in range(DEPTH):
        real[starts + j] = False
    packed = key[real] << np.uint64(TEXT_BITS)
    packed |= np.repeat(np.arange(len(texts), dtype=np.uint64), sizes)
    packed.sort()
    k = packed >> np.uint64(TEXT_BITS)
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    return k[first], first, (packed & np.uint64((1 << TEXT_BITS) - 1)).astype(np.int64)


class Words:
    """Numbers the distinct words of the texts it is given."""

    def __init__(self) -> None:
        self.known: defaultdict[bytes, int] = defaultdict()
        self.known.default_factory = self.known.__len__

    def numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of each word in order, words per text)."""
        parts, sizes = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            words = t.split()
            sizes[i] = len(words)
            parts.append(np.fromiter(map(self.known.__getitem__, words), np.int32, len(words)))
        return np.concatenate(parts), sizes

    def hashes(self) -> np.ndarray:
        """By number."""
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.known), np.uint64, len(self.known))


# --- the trees --------------------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x >= 0.5, by Stirling's series after a shift of 8."""
    shift = np.ones_like(x)
    for i in range(8):
        shift *= x + i
    y = x + 8
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / (y * y)) / (y * y)) / (y * y)) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log probability of any sequence with these counts under the KT estimator."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


class Level:
    """The contexts of one depth: sorted (context, byte) keys and counts, nodes of each bit."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys = keys
        self.node, self.first, self.n0, self.n1, self.own, self.weighted = [], [], [], [], [], []
        for k in range(8):
            prefix = keys >> np.uint64(8 - k)
            first = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1])))
            node = np.zeros(len(keys), np.int64)
            node[first[1:]] = 1
            ones = np.where(keys >> np.uint64(7 - k) & np.uint64(1) == 1, counts, 0)
            n1 = np.add.reduceat(ones, first).astype(float)
            n0 = np.add.reduceat(counts, first) - n1
            self.node.append(np.cumsum(node))
            self.first.append(first)
            self.n0.append(n0)
            self.n1.append(n1)
            self.own.append(log_kt(n0, n1))


class Subtrees:
    """All trees below some contexts of depth ``top``, from sorted distinct grams and counts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, top: int = TOP):
        self.top = top
        self.levels: dict[int, Level] = {DEPTH: Level(grams, counts)}
        self.up: dict[int, np.ndarray] = {}  # row of level d + 1 to row of level d
        keys, c = grams, counts
        for d in range(DEPTH - 1, top - 1, -1):
            shorter = (keys >> U16 << U8) | (keys & np.uint64(0xFF))
            keys, self.up[d] = np.unique(shorter, return_inverse=True)
            c = np.bincount(self.up[d], weights=c, minlength=len(keys))
            self.levels[d] = Level(keys, c)
        for k in range(8):
            below = self.levels[DEPTH].own[k]
            self.levels[DEPTH].weighted.append(below)
            for d in range(DEPTH - 1, top - 1, -1):
                here, child = self.levels[d], self.levels[d + 1]
                parent = here.node[k][self.up[d][child.first[k]]]
                below = np.bincount(parent, weights=below, minlength=len(here.n0[k]))
                below = np.logaddexp(here.own[k] + LN_HALF, below + LN_HALF)
                here.weighted.append(below)

    def summary(self) -> tuple[np.ndarray, np.ndarray]:
        """(nodes of depth top - 1, matrix of n0, n1, sum of children's log weights)."""
        ids, rows = [], []
        level = self.levels[self.top]
        for k in range(8):
            ids.append(node_of(level.keys[level.first[k]], k, 2))
            rows.append(np.stack([level.n0[k], level.n1[k], level.weighted[k]]))
        nodes, place = np.unique(np.concatenate(ids), return_inverse=True)
        return nodes, np.stack([np.bincount(place, weights=w, minlength=len(nodes)) for w in np.concatenate(rows, axis=1)])

    def log10_probabilities(self, upper: Upper) -> np.ndarray:
        """Of each gram's byte in its context, over all depths."""
        grams = self.levels[DEPTH].keys
        total = np.zeros(len(grams))
        rows = {DEPTH: np.arange(len(grams))}
        for d in range(DEPTH - 1, self.top - 1, -1):
            rows[d] = self.up[d][rows[d + 1]]
        for k in range(8):
            bit = (grams >> np.uint64(7 - k) & np.uint64(1)).astype(bool)
            p = None
            for d in range(DEPTH, self.top - 1, -1):
                level = self.levels[d]
                node = level.node[k][rows[d]]
                n0, n1 = level.n0[k][node], level.n1[k][node]
                kt = (np.where(bit, n1, n0) + 0.5) / (n0 + n1 + 1)
                if p is None:
                    p = kt
                else:
                    w = np.exp(level.own[k] + LN_HALF - level.weighted[k])[node]
                    p = w * kt + (1 - w) * p
            total += np.log10(upper.mix(grams, k, bit, p, self.top))
        return total


def node_of(keys: np.ndarray, k: int, drop: int) -> np.ndarray:
    """The node of bit k below the context that is left of (context, byte) keys without their
    last ``drop`` bytes: the context, then a byte that counts the nodes of a binary tree."""
    return (keys >> np.uint64(8 * drop) << U8) | np.uint64(1 << k) | ((keys & np.uint64(0xFF)) >> np.uint64(8 - k))


class Upper:
    """The contexts above the tree groups: depths 1 and 0, and the split ones of depths 2 and 3.

    ``sums``: by depth 1 to 3, nodes and their sums (n0, n1, children's log weights) as the
    groups below them give them. A split context hands its own on to the depth above.
    """

    def __init__(self, sums: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        nodes, rows = np.zeros(0, np.int64), np.zeros((3, 0))
        for d in range(DEPTH - 2, -1, -1):
            more, given = sums.get(d, (np.zeros(0, np.int64), np.zeros((3, 0))))
            own, place = np.unique(np.concatenate((nodes, more)), return_inverse=True)
            n0, n1, below = (np.bincount(place, weights=w, minlength=len(own)) for w in np.concatenate((rows, given), axis=1))
            kt = log_kt(n0, n1) + LN_HALF
            weighted = np.logaddexp(kt, below + LN_HALF)
            # by node: the weight of its own estimate, and its estimate of a one
            self.tables[d] = own.astype(np.uint64), np.exp(kt - weighted), (n1 + 0.5) / (n0 + n1 + 1)
            nodes, rows = (own >> 16 << 8) | (own & 0xFF), np.stack([n0, n1, weighted])

    def mix(self, grams: np.ndarray, k: int, bit: np.ndarray, p: np.ndarray, top: int) -> np.ndarray:
        for d in range(top - 1, -1, -1):
            nodes, w, one = self.tables[d]
            at = np.searchsorted(nodes, node_of(grams, k, DEPTH + 1 - d))
            kt = np.where(bit, one[at], 1 - one[at])
            p = w[at] * kt + (1 - w[at]) * p
        return p


def tops_of(grams: np.ndarray, split: dict[int, np.ndarray]) -> np.ndarray:
    """The depth of each gram's tree group: 2, or more below the ``split`` contexts of depths 2 and 3."""
    top = np.full(len(grams), TOP)
    for d in range(TOP, DEPTH - 1):
        if d in split:
            top[(top == d) & np.isin(grams >> np.uint64(8 * (DEPTH + 1 - d)), split[d])] = d + 1
    return top


# --- Spark ----------------------------------------------------------------------------------------


def held_out(key: Column, folds: int = 7, fold: int = 2) -> Column:
    """crc32 of the id as text, modulo ``folds``, is ``fold``; a null id counts as ''."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == fold


def _ipc(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return out.getvalue().to_pybytes()


def _chunks(docs: DataFrame, n_blocks: int) -> DataFrame:
    """(block, chunk): compressed runs of rows, dealt to blocks one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        number = (task * 0x9E3779B1) % n_blocks  # tasks don't all start with the same block
        for b in sliced(batches, 4096):
            size = np.cumsum(pc.utf8_length(b.column("text")).to_numpy() + 64)
            out = []
            at = 0
            while at < b.num_rows:
                full = (size[at - 1] if at else 0) + CHUNK_CHARS
                end = max(at + 1, int(np.searchsorted(size, full, "right")))
                out.append((number, _ipc(b.slice(at, end - at))))
                number, at = (number + 1) % n_blocks, end
            ks, chunks = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int32()), pa.array(chunks, pa.binary())], ["block", "chunk"])

    return docs.mapInArrow(run, "block int, chunk binary")


def _batches(chunks: pa.ChunkedArray) -> Iterator[tuple[list, np.ndarray, list[bytes]]]:
    """(ids, held out, texts in lower case) in batches of about ``BATCH_BYTES`` and no more
    texts than a sort key can number. Chunks are opened one by one: a task holds a batch."""
    ids: list = []
    held: list = []
    texts: list[bytes] = []
    n = 0
    for chunk in chunks:
        t = pa.ipc.open_stream(chunk.as_buffer() if isinstance(chunk, pa.Scalar) else chunk).read_all()
        for i, h, x in zip(*(t.column(c).to_pylist() for c in ("id", "held_out", "text")), strict=True):
            if texts and (n >= BATCH_BYTES or len(texts) >> TEXT_BITS):
                yield ids, np.array(held, bool), texts
                ids, held, texts, n = [], [], [], 0
            ids.append(i)
            held.append(h)
            texts.append(x.encode().lower())
            n += len(texts[-1])
    if texts:
        yield ids, np.array(held, bool), texts


def _split(kind: str, rack: int, bucket: np.ndarray, src: int, keys: np.ndarray, values: np.ndarray) -> list[tuple]:
    return [(kind, rack, i, src, pack(keys[r], values[r])) for i, r in by_bucket(bucket)]


def _lists(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("kind", "rack", "range", "src", "blob"), cols, kinds, strict=True)})


def _hash(kind: str, keys: np.ndarray) -> np.ndarray:
    """What the ranges are over: words are hashes already."""
    return scramble(keys) if kind == "gram" else keys


#: Log probabilities travel as whole multiples of 2^-32, which the sum of a text of a million bytes
#: is off by 1e-4 at most, and by 1e-7 as a rule.
FIXED = 2.0**32


def _merge(level: int, bits: int) -> Callable:
    """Lists of a rack and range, added up and cut into the ranges of the next level."""

    def merge(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        kind, rack, _ = (x.as_py() for x in key)
        k, c = _added(t)
        return _lists(_split(kind, rack >> bits, range_at(_hash(kind, k), level + 1, bits), rack, k, c))

    return merge


def _answer(level: int, bits: int) -> Callable:
    """Replies to the merged list of a rack and range, by the ranges of the next level, as replies to its lists."""

    def answer(key: tuple[pa.Scalar, ...], mine: pa.Table, got: pa.Table) -> pa.Table:
        if not mine.num_rows:
            return _lists([])
        kind, _, here = (x.as_py() for x in key)
        lists = [unpack(b, np.int64)[0] for b in mine.column("blob").to_pylist()]
        k = np.unique(np.concatenate(lists))
        v = np.zeros(len(k), np.int64)
        reply = dict(zip(got.column("range").to_pylist(), got.column("blob").to_pylist(), strict=True))
        for i, rows in by_bucket(range_at(_hash(kind, k), level + 1, bits)):
            v[rows] = expand(reply[i], np.int64)
        return _lists([(kind, src, here, -1, squeeze(v[np.searchsorted(k, x)])) for src, x in zip(mine.column("src").to_pylist(), lists, strict=True)])

    return answer


class Butterfly:
    """Lists of keys and counts of blocks, added up by rack and range, and answers on the way back."""

    def __init__(self, first: DataFrame, levels: int, bits: int):
        """``first``: the lists of the blocks, cut by the ranges of level 1."""
        self.bits, self.levels = bits, [first]
        for level in range(1, levels):
            met = self.levels[-1].groupBy("kind", "rack", "range")
            self.levels.append(materialize(met.applyInArrow(_merge(level, bits), LISTS), "lists"))

    @property
    def last(self) -> DataFrame:
        return self.levels[-1]

    def back(self, replies: DataFrame) -> DataFrame:
        """From (kind, rack, range, blob), the replies to the lists of the last level in their
        order, to (kind, rack, range, blob) of the blocks, each a rack of its own."""
        for level in range(len(self.levels) - 1, 0, -1):
            replies = replies.select("kind", "rack", "range", "blob").withColumn("wide", F.shiftright("range", self.bits))
            mine = self.levels[level - 1].groupBy("kind", "rack", "range")
            replies = mine.cogroup(replies.groupBy("kind", "rack", "wide")).applyInArrow(_answer(level, self.bits), LISTS)
        return replies


def _added(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    got = [unpack(b, np.int64) for b in t.column("blob").to_pylist()]
    return add_up([k for k, _ in got], [c for _, c in got])


def _context_counts(totals: DataFrame, depth: int, below: np.ndarray | None) -> DataFrame:
    """(context, n): the distinct grams of each context of a depth, of those below the given shorter ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 16):
            for blob in b.column("blob").to_pylist():
                grams = unpack(blob, np.int64)[0]
                context = grams >> np.uint64(8 * (DEPTH + 1 - depth))
                if below is not None:
                    context = context[np.isin(context >> U8, below)]
                c, n = np.unique(context, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)), pa.array(n)], ["context", "n"])

    return totals.select("blob").mapInArrow(run, "context long, n long").groupBy("context").agg(F.sum("n").alias("n"))


def score_documents(docs: DataFrame, train_where: Column | None = None, id_col: str = "doc_id", text_col: str = "text", block_chars: int = 8_000_000, bits: int = 6, group_grams: int = 500_000, most_split: int = 256) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes) of each row.

    ``score`` is the model's log10 probability of the text with its end; ``-score /
    log10(2) / n_bytes`` is the code length in bits per byte. ``train_where``: a condition
    on the row of ``docs`` that makes it train; by default the fold of :func:`held_out`.
    ``bits``: a rack is of 2^bits blocks or racks.
    """
    held = held_out(docs[id_col]) if train_where is None else ~F.coalesce(train_where, F.lit(False))
    d = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"), held.alias("held_out"))
    size = d.agg(F.sum(F.length("text") + 64).alias("chars"), F.count_if(~F.col("held_out")).alias("train")).first()
    n = max(1, -(-(size["chars"] or 0) // block_chars))
    levels = max(1, -(-(n - 1).bit_length() // bits))
    ends = size["train"]
    blocks = materialize(_chunks(d, n), "chunks")

    def count(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        block = key[0].as_py()
        grams, gram_counts, words, word_counts = [], [], Words(), np.zeros(0)
        for _, held, texts in _batches(t.column("chunk")):
            k, first, text = gram_runs(texts)
            grams.append(k)
            gram_counts.append(np.add.reduceat((~held)[text].astype(np.int64), first))
            numbers, sizes = words.numbers(texts)
            seen = np.bincount(numbers, weights=np.repeat(~held, sizes), minlength=len(words.known)).astype(float)
            seen[: len(word_counts)] += word_counts
            word_counts = seen
        k, c = add_up(grams, gram_counts)
        rows = _split("gram", block >> bits, range_at(scramble(k), 1, bits), block, k, c)
        k, c = add_up([words.hashes()], [word_counts.astype(np.int64)])
        rows += _split("word", block >> bits, range_at(k, 1, bits), block, k, c)
        pa.default_memory_pool().release_unused()
        return _lists(rows)

    asked = Butterfly(materialize(blocks.groupBy("block").applyInArrow(count, LISTS), "asked"), levels, bits)

    def answer_words(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        """Each list's words with their counts over all blocks, and the totals (rack -1)."""
        lists = [unpack(b, np.int64)[0] for b in t.column("blob").to_pylist()]
        words, counts = _added(t)
        here = key[0].as_py()
        rows = [("word", src, here, -1, squeeze(counts[np.searchsorted(words, k)])) for src, k in zip(t.column("src").to_pylist(), lists, strict=True)]
        rows.append(("word", -1, here, -1, np.array([(counts > 0).sum(), counts.sum()], np.int64).tobytes()))
        return _lists(rows)

    word_answers = materialize(asked.last.where("kind = 'word'").groupBy("range").applyInArrow(answer_words, LISTS), "words")
    n_types, n_train = (x + y for x, y in zip(_word_totals(word_answers), (ends > 0, ends), strict=True))

    def total_grams(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        """Distinct grams of a range and their counts over all blocks."""
        return _lists([("gram", 0, key[0].as_py(), -1, pack(*_added(t)))])

    totals = materialize(asked.last.where("kind = 'gram'").groupBy("range").applyInArrow(total_grams, LISTS), "totals")
    contexts = materialize(_context_counts(totals, TOP, None), "contexts")
    distinct = contexts.agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-distinct // group_grams))
    least = max(group_grams, distinct // most_split)
    split: dict[int, np.ndarray] = {}
    for d in range(TOP, DEPTH - 1):  # at most ``most_split`` contexts of a depth come to the driver
        hot = contexts.where(F.col("n") > least).select("context").toPandas()["context"].to_numpy().astype(np.uint64)
        if not len(hot):
            break
        split[d] = hot
        if d + 1 < DEPTH - 1:
            contexts = _context_counts(totals, d + 1, hot)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Grams with their counts, by tree group."""
        for b in sliced(batches, 16):
            for blob in b.column("blob").to_pylist():
                grams, counts = unpack(blob, np.int64)
                top = tops_of(grams, split)
                context = grams >> (np.uint64(8) * (DEPTH + 1 - top).astype(np.uint64)) << U8 | top.astype(np.uint64)
                group = ((scramble(context) >> np.uint64(32)) % np.uint64(groups)).astype(np.int64)
                parts = [(i, pack(grams[r], counts[r])) for i, r in by_bucket(group)]
                ks, blobs = zip(*parts, strict=True) if parts else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int32()), pa.array(blobs, pa.binary())], ["group", "blob"])

    trees = materialize(totals.select("blob").mapInArrow(deal, "group int, blob binary"), "grams")
    discard(totals)

    def subtrees(t: pa.Table) -> Iterator[Subtrees]:
        """The group's trees, by the depth of their contexts."""
        grams, counts = _added(t)
        for top, rows in by_bucket(tops_of(grams, split)):
            yield Subtrees(grams[rows], counts[rows], top)

    def summarise(t: pa.Table) -> pa.Table:
        parts = [(tree.top - 1, *tree.summary()) for tree in subtrees(t)]
        depth = np.concatenate([np.full(len(nodes), d, np.int32) for d, nodes, _ in parts])
        nodes = np.concatenate([nodes for _, nodes, _ in parts]).astype(np.int64)
        sums = np.concatenate([s for _, _, s in parts], axis=1)
        return pa.table({"depth": depth, "node": nodes, "n0": sums[0], "n1": sums[1], "below": sums[2]})

    parts = trees.groupBy("group").applyInArrow(summarise, "depth int, node long, n0 double, n1 double, below double")
    # at most 255 nodes of each of the 256 contexts of depth 1 and of the split ones
    above = parts.groupBy("depth", "node").agg(F.sum("n0"), F.sum("n1"), F.sum("below")).toPandas().to_numpy()
    upper = Upper({d: (above[above[:, 0] == d, 1].astype(np.int64), above[above[:, 0] == d, 2:].T.astype(float)) for d in range(1, DEPTH - 1)})

    def predict(t: pa.Table) -> pa.Table:
        rows = []
        for tree in subtrees(t):
            grams, logs = tree.levels[DEPTH].keys, tree.log10_probabilities(upper)
            rows += _split("log", 0, range_at(scramble(grams), levels, bits), -1, grams, np.rint(logs * -FIXED).astype(np.int64))
        return _lists(rows)

    logs = trees.groupBy("group").applyInArrow(predict, LISTS)

    def answer_grams(key: tuple[pa.Scalar, ...], mine: pa.Table, known: pa.Table) -> pa.Table:
        """Each list's grams with their log probabilities."""
        if not mine.num_rows:
            return _lists([])
        got = [unpack(b, np.int64) for b in known.column("blob").to_pylist()]
        k, v = np.concatenate([x for x, _ in got]), np.concatenate([x for _, x in got])
        order = np.argsort(k)
        k, v = k[order], v[order]
        here = key[0].as_py()
        return _lists([("gram", src, here, -1, squeeze(v[np.searchsorted(k, unpack(blob, np.int64)[0])])) for src, blob in zip(mine.column("src").to_pylist(), mine.column("blob").to_pylist(), strict=True)])

    gram_answers = asked.last.where("kind = 'gram'").groupBy("range").cogroup(logs.groupBy("range")).applyInArrow(answer_grams, LISTS)
    answers = asked.back(gram_answers.unionByName(word_answers.where("rack >= 0")))
    answers = answers.select(F.col("rack").alias("block"), "kind", "range", "blob")
    floor = np.log10(n_train + n_types + 1)

    def score(key: tuple[pa.Scalar, ...], mine: pa.Table, got: pa.Table) -> pa.Table:
        reply = {(k, b): x for k, b, x in zip(*(got.column(c).to_pylist() for c in ("kind", "range", "blob")), strict=True)}

        def in_order(kind: str, keys: np.ndarray) -> np.ndarray:
            out = np.zeros(len(keys), np.int64)
            for i, rows in by_bucket(range_at(_hash(kind, keys), 1, bits)):
                out[rows] = expand(reply.pop((kind, i)), np.int64)
            return out

        ids, held, sizes, numbers, grams, words = [], [], [], [], [], Words()
        for some, h, texts in _batches(mine.column("chunk")):  # what was asked, again
            ids += some
            held.append(h)
            grams.append(gram_runs(texts)[0])
            each, size = words.numbers(texts)
            numbers.append(each)
            sizes.append(size)
        grams = np.unique(np.concatenate(grams))
        logs = in_order("gram", grams) / -FIXED
        distinct, place = np.unique(words.hashes(), return_inverse=True)
        count_of = in_order("word", distinct)[place]
        known, base, total = [], [], []
        for (_, _, texts), each, size in zip(_batches(mine.column("chunk")), numbers, sizes, strict=True):
            c, text_of = count_of[each], np.repeat(np.arange(len(texts)), size)
            known.append(np.bincount(text_of, weights=c > 0, minlength=len(texts)).astype(np.int64) + (ends > 0))
            base.append(np.bincount(text_of, weights=np.log10(c + 1.0), minlength=len(texts)) + np.log10(ends + 1.0) - (size + 1) * floor)
            k, first, text = gram_runs(texts)
            run = np.diff(first, append=len(text))
            total.append(np.bincount(text, weights=np.repeat(logs[np.searchsorted(grams, k)], run), minlength=len(texts)))
            total[-1] = np.stack([total[-1], [len(t) + 1 for t in texts]])
        total = np.concatenate(total, axis=1)
        pa.default_memory_pool().release_unused()
        return pa.table({
            "id": pa.array(ids, pa.int64()), "held_out": np.concatenate(held), "n_tokens": np.concatenate(sizes) + 1, "n_known": np.concatenate(known),
            "train_tokens": np.full(len(ids), n_train, np.int64), "base_score": np.concatenate(base), "score": total[0], "n_bytes": total[1].astype(np.int64),
        })

    out = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, out)


def _word_totals(answers: DataFrame) -> tuple[int, int]:
    """(distinct words, words) of the training texts, summed over the hash ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            x = np.frombuffer(b"".join(b.column("blob").to_pylist()), np.int64).reshape(-1, 2).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(x[:1]), pa.array(x[1:])], ["v", "n"])

    row = answers.where("rack = -1").select("blob").mapInArrow(run, "v long, n long").agg(F.sum("v"), F.sum("n")).first()
    return row[0] or 0, row[1] or 0
