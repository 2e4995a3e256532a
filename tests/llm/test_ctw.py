import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quirework.llm import ctw


def brute(train, text, depth):
    """CTW by definition, over dictionaries: one tree per node of a byte's decomposition."""
    counts = Counter()
    for t in train:
        raw = b"\0" * depth + t + b"\xff"
        for p in range(depth, len(raw)):
            for k in range(8):
                u = (1 << k) | raw[p] >> (8 - k)
                for d in range(depth + 1):
                    counts[u, raw[p - d : p], raw[p] >> (7 - k) & 1] += 1

    nodes = {(u, c) for u, c, _ in counts}
    kids = {}
    for u, c in nodes:
        if c:
            kids.setdefault((u, c[1:]), set()).add(c)

    def own(u, c):
        a, b = counts[u, c, 0], counts[u, c, 1]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    memo = {}

    def weighted(u, c):
        if (u, c) not in memo:
            e = own(u, c)
            memo[u, c] = e if len(c) == depth else np.logaddexp(e, sum(weighted(u, k) for k in kids.get((u, c), ()))) - math.log(2)
        return memo[u, c]

    def predict(u, past, d, bit):
        c = past[len(past) - d :]
        a, b = counts[u, c, 0], counts[u, c, 1]
        kt = ((b if bit else a) + 0.5) / (a + b + 1)
        if d == depth:
            return kt
        w = math.exp(own(u, c) - math.log(2) - weighted(u, c))
        return w * kt + (1 - w) * predict(u, past, d + 1, bit)

    total, raw = 0.0, b"\0" * depth + text + b"\xff"
    for p in range(depth, len(raw)):
        for k in range(8):
            u = (1 << k) | raw[p] >> (8 - k)
            total += math.log10(predict(u, raw[p - depth : p], 0, raw[p] >> (7 - k) & 1))
    return total


#: One block; a butterfly of several levels; tree groups split down to four context bytes.
SHAPES = [{}, {"block_chars": 120}, {"block_chars": 70, "bits": 1}, {"block_chars": 120, "bits": 2, "group_grams": 3, "most_split": 10_000}]


@pytest.mark.parametrize("shape", SHAPES)
def test_scores_equal_the_definition(spark, shape):
    texts = ["the cat sat on the mat", "a cat, a hat", "THE hat sat", "", None, "zebra", "the cat sat on the hat", "mat"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = ctw.score_documents(docs, train_where=F.col("doc_id") < 5, **shape).collect()
    low = [(t or "").encode().lower() for t in texts]
    train = low[:5]
    assert sorted(r.id for r in rows) == list(range(8))
    words = Counter(w for t in train for w in t.split())
    n, v = sum(words.values()) + 5, len(words) + 1
    for r in rows:
        assert r.score == pytest.approx(brute(train, low[r.id], ctw.DEPTH), rel=1e-9)
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in low[r.id].split()) + math.log10(6 / (n + v + 1))
        assert r.base_score == pytest.approx(base)
        assert (r.train_tokens, r.n_tokens, r.held_out) == (n, len(low[r.id].split()) + 1, r.id >= 5)
        assert r.n_known == sum(words[w] > 0 for w in low[r.id].split()) + 1


def test_bytes_of_a_context_sum_to_one():
    rng = np.random.default_rng(0)
    grams, counts = ctw.add_up([rng.integers(0, 1 << 12, 400, np.uint64)], [rng.integers(0, 3, 400)])
    context = grams[7] >> np.uint64(8) << np.uint64(8)
    keys, c = ctw.add_up([grams, context + np.arange(256, dtype=np.uint64)], [counts, np.zeros(256, np.int64)])
    for top in (2, 3, 4):
        tree = ctw.Subtrees(keys, c, top)
        nodes, sums = tree.summary()
        p = 10 ** tree.log10_probabilities(ctw.Upper({top - 1: (nodes.astype(np.int64), sums)}))
        assert p[keys >> np.uint64(8) << np.uint64(8) == context].sum() == pytest.approx(1)


def test_chunks_hold_every_row_once_and_are_dealt_evenly(spark):
    docs = spark.range(4000).selectExpr("id", "repeat('x', cast(id % 300 as int)) AS text", "id % 7 = 2 AS held_out").coalesce(2)
    rows = ctw._chunks(docs, 3).collect()
    ids = sorted(i for r in rows for some, _, _ in ctw._batches([pa.py_buffer(bytes(r.chunk))]) for i in some)
    assert ids == list(range(4000))
    per = np.bincount([r.block for r in rows], minlength=3)
    assert per.max() - per.min() <= 2


def test_odd_rows(odd_docs, no_docs):
    rows = ctw.score_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    for r in rows:
        assert r.held_out == (r.id is not None and zlib.crc32(str(r.id).encode()) % 7 == 2)
    assert ctw.score_documents(no_docs).count() == 0
    untrained = ctw.score_documents(odd_docs.where("doc_id = 8"), train_where=F.lit(False)).collect()
    assert [r.score for r in untrained] == pytest.approx([4 * 8 * math.log10(0.5)] * 2)


def test_packed_arrays_round_trip():
    k = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 1000, np.uint64))
    c = np.arange(len(k), dtype=np.uint32)
    a, b = ctw.unpack(ctw.pack(k, c), np.uint32)
    assert sorted(i for i, _ in ctw.by_bucket(np.array([5, 2, 5, 9]))) == [2, 5, 9] and not list(ctw.by_bucket(np.zeros(0, np.int64)))
    assert (a == k).all() and (b == c).all()
