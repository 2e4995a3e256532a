import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirework.llm.components import connected_components
from quirework.llm.minhash import Signer, WordHashes, cross_pairs, deduplicate, near_duplicates, rare_pairs, shingle_set


def brute(rows, width, percent=80):
    """(id -> component) over the union-find of all linked pairs."""
    def shingles(t):
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in parent}


def family(seed, n=60):
    """Near copies of a few texts at all distances around the threshold, and copies of copies."""
    rng = random.Random(seed)
    rows, texts = [], [[f"w{rng.randrange(4000)}" for _ in range(rng.choice((12, 60, 150)))] for _ in range(4)]
    for i in range(n):
        t = list(rng.choice(texts))
        for _ in range(rng.randrange(0, max(2, len(t) // 9))):
            t[rng.randrange(len(t))] = f"x{rng.randrange(9000)}"
        if rng.random() < 0.3:
            texts.append(t)
        rows.append((i * 3, " ".join(t)))
    return rows + rows[5:9] + [(1000, "One"), (1001, "oNE"), (1002, ""), (1003, None), (1004, " \t"), (1005, "a b"), (1006, "a b c")]


@pytest.mark.parametrize(("width", "rare"), [(2, 32), (5, 32), (2, 1), (5, 2)])
def test_components_equal_brute_force(spark, width, rare):
    rows = family(width)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs, width=width, rare=rare).collect()
    assert len(got) == len(rows)
    want = brute(rows, width)
    for r in got:
        assert r.component == want[r.id]
        assert r.kept == (r.component == r.id)
    assert {r.n_shingles for r in got if r.id in (1002, 1003, 1004)} == {0}


def test_members_far_from_the_pivot_are_found(spark):
    # a ring: each text is linked with its neighbours alone, so no pivot reaches all of them
    words = [f"v{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 12 : i * 12 + 120])) for i in range(24)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()
    want = brute(rows, 2)
    assert {r.id: r.component for r in got} == want and len(set(want.values())) == 1


def test_a_shared_passage_makes_no_pairs(spark):
    """Texts that share three quarters meet in many buckets, but at no rare shingle."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(150)]
    texts = [(i, " ".join(passage + [f"o{rng.randrange(10**6)}" for _ in range(50)])) for i in range(120)]
    texts += [(200 + i, t + " and") for i, t in texts[:5]]
    cache = WordHashes()
    facts = [(i, i, bytearray(shingle_set(t, 2, cache).tobytes())) for i, t in texts]
    pairs, frequent = rare_pairs(spark.createDataFrame(facts, "id long, component long, shingles binary"), 80, 32)
    assert {(r.a, r.b) for r in pairs.collect()} == {(i, 200 + i) for i in range(5)}
    assert frequent.count() == 0


def test_rare_pairs_lose_no_link(spark):
    rows = [(i, t) for i, t in dict(family(11, 90)).items() if (t or "").split()]
    cache = WordHashes()
    sets = {i: set(shingle_set(t, 2, cache).tolist()) for i, t in rows}
    facts = [(i, i, bytearray(shingle_set(t, 2, cache).tobytes())) for i, t in rows]
    linked = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    for rare in (1, 6, 32, 1000):
        pairs, frequent = rare_pairs(spark.createDataFrame(facts, "id long, component long, shingles binary"), 80, rare)
        found, rest = {(r.a, r.b) for r in pairs.collect()}, {r.id for r in frequent.collect()}
        assert all(p in found or set(p) <= rest for p in linked)
        if rare == 1000:
            assert not rest


def test_cross_pairs_in_blocks(spark):
    signer, cache = Signer(28, 4), WordHashes()
    rng = random.Random(9)
    base = [f"w{i}" for i in range(100)]
    facts, sets = [], {}
    for i in range(30):
        t = list(base)
        for _ in range(rng.randrange(4, 14)):
            t[rng.randrange(100)] = f"y{rng.randrange(10**6)}"
        s = shingle_set(" ".join(t), 2, cache)
        sets[i] = set(s.tolist())
        facts.append((i, bytearray(signer.sign(s).tobytes()), bytearray(s.tobytes()), [int(k) for k in signer.band_keys(signer.sign(s))]))
    f = spark.createDataFrame(facts, "id long, signature binary, shingles binary, keys array<long>")
    members = f.select("id", F.posexplode("keys").alias("band", "key"), F.col("id").alias("component"))
    linked = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    for block in (4, 1024):
        found = {(r.a, r.b) for r in cross_pairs(members, f, 0.6, 28, 80, block=block).collect()}
        # bands decide which pairs meet; the true links at this size meet somewhere
        parts = defaultdict(set)
        assert found == linked, parts
        offers = {(r.a, r.b) for r in cross_pairs(members, f, 0.6, 28, 80, top=2, block=block).collect()}
        assert offers <= {(a, b) for a in sets for b in sets if a < b}


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(400 + i, 401 + i) for i in range(40)] + [(7, 7), (None, 3)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), hot=2).collect()}
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert got == {x: root(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(odd_docs, no_docs):
    got = near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r.kept and r.component is None for r in got if r.id is None)
    assert {r.component for r in got if r.id in (1, 2)} == {1}
    left = deduplicate(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r.doc_id) for r in odd_docs.collect() if r.doc_id != 2)
    named = odd_docs.withColumn("gone_id", F.col("doc_id")).withColumn("_gone_id", F.lit(1))
    assert deduplicate(named).count() == odd_docs.count() - 1
    assert near_duplicates(no_docs).count() == 0 and deduplicate(no_docs).count() == 0
