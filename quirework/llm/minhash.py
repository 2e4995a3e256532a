"""MinHash near-deduplication: universal hash minima, banding, verification, components.

1. A text's words (runs outside of space and U+0009-U+000D, A-Z lower-cased) give the set of
   its distinct ``width``-word shingles as 64-bit hashes; a text with fewer words gives
   its whole sequence as one shingle, a text without words none. ``bands * rows`` universal hash
   functions (multiply-add modulo 2^64, upper half) give the signature.
2. Documents with equal sets collapse into the one with the smallest id, by a digest.
3. Band hashes put the representatives into buckets. In each bucket all are compared with
   its smallest id, so a bucket of n gives n - 1 candidates, never all of its pairs.
4. Candidates are checked on signatures (with a margin of four standard deviations: a link is
   lost there with probability 3e-5 at most), then exactly on the full shingle sets.
5. Large-star/small-star components over the links.
6. What a pivot can't decide lies in buckets that still hold more than one component. Their
   members meet by an exact prefix filter: of a set of n shingles in an order from rare to
   frequent, one of the first n - ceil(0.8 n) + 1 is among those of each partner. A shingle
   that at most ``rare`` members have there gives their pairs, so a row gives at most ``rare`` of
   them, whatever the size of its bucket; they are checked like candidates.
7. Members that meet at a more frequent shingle, as those of a large family of texts at just
   below the threshold do, are finished in the buckets which are still mixed. First, in a few
   rounds, each offers its two most similar partners outside of its component, which joins what
   hangs together; then all pairs of different components that are left and agree on
   signatures are checked on sets where they meet, in blocks of bounded size, and only links
   leave the task.

With 28 bands of 4 rows a pair at similarity 0.8 shares no bucket with probability
(1 - 0.8^4)^28 = 4e-7.

Skew: buckets, shingles and digests with a third of all rows only occur as keys of map-side
combined aggregations and of joins that deal a hot key to several tasks. Only counts come
to the driver. A set of ids is broadcast when it has at most ``broadcast_ids`` rows (16 MB), else
it is joined.

Ids are long integers; other types are cast, and one that doesn't cast fails. Defined results: null, blank and wordless texts have an empty set and are linked with
nothing; repeated ids count as one vertex with the links of all of its rows; null ids are
left out of linking and have no component; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.common import arrow_map, discard, free_name, keyed_text, materialize, salted_join, sliced
from quirework.llm.components import connected_components

MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """Word to 64-bit hash, remembered for the words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str, width: int, cache: WordHashes) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = text.encode().lower().split()  # bytes: A-Z alone, and ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    k = min(width, len(words))
    acc = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        acc = (acc ^ (acc >> np.uint64(29))) * MIX + h[i : len(words) - k + 1 + i]
    acc = (acc ^ (acc >> np.uint64(32))) * MIX2
    return np.unique(acc ^ (acc >> np.uint64(31)))


class Signer:
    def __init__(self, bands: int, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        n = bands * rows
        self.a = (rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
        self.b = rng.integers(0, 1 << 63, n, np.uint64)[:, None]
        self.bands, self.rows = bands, rows

    def sign(self, shingles: np.ndarray) -> np.ndarray:
        best = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 1024):
            t = self.a * shingles[None, at : at + 1024]
            t += self.b
            np.minimum(best, t.min(axis=1), out=best)
        return (best >> np.uint64(32)).astype("<u4")

    def band_keys(self, signature: np.ndarray) -> np.ndarray:
        raw, w = signature.tobytes(), 4 * self.rows
        return np.array([xxhash.xxh3_64_intdigest(raw[i * w : i * w + w], i) for i in range(self.bands)], np.uint64).view(np.int64)


def signatures(docs: DataFrame, width: int, bands: int, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, digest, signature, keys); the last three are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, cache = Signer(bands, rows), WordHashes()
        for b in sliced(batches):
            n, digest, sig, keys = [], [], [], []
            for text in b.column("text").to_pylist():
                s = shingle_set(text, width, cache)
                n.append(len(s))
                if not len(s):
                    for x in (digest, sig, keys):
                        x.append(None)
                    continue
                signed = signer.sign(s)
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sig.append(signed.tobytes())
                keys.append(signer.band_keys(signed))
            cols = [b.column("id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, ["id", "n_shingles", "digest", "signature", "keys"])

    return keyed_text(docs, id_col, text_col).mapInArrow(run, "id long, n_shingles long, digest binary, signature binary, keys array<long>")


def shingle_sets(texts: DataFrame, width: int) -> DataFrame:
    """(id, shingles binary) from (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for b in sliced(batches):
            sets = [shingle_set(x, width, cache).tobytes() for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sets, pa.binary())], ["id", "shingles"])

    return texts.mapInArrow(run, "id long, shingles binary")


def signatures_agree(pairs: DataFrame, signed: DataFrame, least: float) -> DataFrame:
    """The (a, b) pairs whose share of equal minima is at least ``least``."""
    sig = signed.select("id", "signature")
    both = pairs.join(sig.select(F.col("id").alias("a"), F.col("signature").alias("sa")), "a")
    both = both.join(sig.select(F.col("id").alias("b"), F.col("signature").alias("sb")), "b").select("a", "b", "sa", "sb")

    def check(b: pa.RecordBatch) -> pa.RecordBatch:
        if not b.num_rows:
            return b.select(["a", "b"])
        x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u4").reshape(b.num_rows, -1) for c in ("sa", "sb"))
        return b.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

    return arrow_map(both, check, "a long, b long", 4096).distinct()


def sets_agree(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs with 100 * intersection >= percent * union, on full sets."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
    both = both.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", "sa", "sb")

    def check(b: pa.RecordBatch) -> pa.RecordBatch:
        ok = []
        for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist(), strict=True):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
                ok.append(False)
                continue
            both = np.concatenate((p, q))
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            ok.append(100 * common >= percent * (len(both) - common))
        return b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return arrow_map(both, check, "a long, b long", 64).distinct()


def cross_pairs(members: DataFrame, facts: DataFrame, least: float, bands: int, percent: int, top: int | None = None, block: int = 1024) -> DataFrame:
    """(a, b) pairs of different components in a bucket, of those that agree on signatures.

    ``members``: (key, band, id, component) of buckets with several components. A pair is
    looked at only in the first band it shares. With ``top``, each member outside of the bucket's
    largest component offers its ``top`` most similar partners, yet unchecked. Without, ``facts``
    has the shingle sets too: all pairs are checked on full sets right here, and a member gives
    one link for each component it is linked with, so what comes out stays linear.

    Members of the largest component need no look at each other. So a bucket of more than
    ``block`` members is cut into blocks of all its members and blocks of those outside of the
    largest component, and each pair of such blocks is a group of its own: a hot bucket with few
    outsiders is spread out evenly with a copy of these in each group.
    """
    sizes = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
    size = sizes.groupBy("key").agg(F.max(F.struct("c", "component")).alias("top"), F.sum("c").alias("n"))
    blocks = lambda n: F.greatest(F.ceil(n / block), F.lit(1)).cast("int")
    size = size.select("key", "n", F.col("top.component").alias("largest"), blocks(F.col("n")).alias("k_all"), blocks(F.col("n") - F.col("top.c")).alias("k_out"))
    rows = salted_join(members, size, "key", "n", members.count()).withColumn("outside", F.col("component") != F.col("largest"))
    mine = lambda k: F.pmod(F.xxhash64("id"), F.col(k)).cast("int")
    each = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    cols = ["key", "band", "id", "component", "outside", "is_left", "is_right", "lo", "hi"]
    # in a bucket of one block a member is there once, for both sides
    right = rows.withColumn("is_right", F.lit(True)).withColumn("is_left", F.col("outside") & (F.col("k_all") == 1))
    right = right.withColumn("lo", each("k_out")).withColumn("hi", mine("k_all")).select(cols)
    left = rows.where("outside AND k_all > 1").withColumn("is_right", F.lit(False)).withColumn("is_left", F.lit(True))
    left = left.withColumn("lo", mine("k_out")).withColumn("hi", each("k_all")).select(cols)
    kept = ["id", "signature"] if top is not None else ["id", "signature", "shingles"]
    dealt = right.unionByName(left).join(facts.select(*kept), "id").select("key", "lo", "hi", "band", "component", "is_left", "is_right", *kept)

    def compare(t: pa.Table) -> pa.Table:
        sig = np.frombuffer(b"".join(t.column("signature").to_pylist()), "<u4").reshape(t.num_rows, -1)
        ids, comp, is_left, is_right = (t.column(c).to_numpy() for c in ("id", "component", "is_left", "is_right"))
        band = t.column("band")[0].as_py()
        sets = [] if top is not None else [np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()]
        lengths = np.array([len(x) for x in sets], np.int64)
        out: list[tuple[int, int]] = []

        def alike(i: int, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            near = among[comp[among] != comp[i]]
            if top is None:  # sets of too different sizes can't be linked
                small, large = np.minimum(lengths[near], lengths[i]), np.maximum(lengths[near], lengths[i])
                near = near[100 * small >= percent * large]
            same = sig[near] == sig[i]
            share = same.mean(axis=1)
            good = (share >= least) & (same.reshape(len(near), bands, sig.shape[1] // bands).all(axis=2).argmax(axis=1) == band)
            return near[good], share[good]

        def linked(i: int, near: np.ndarray) -> np.ndarray:
            """Those of ``near`` whose sets are linked with i's."""
            if not len(near):
                return near
            flat = np.concatenate([sets[j] for j in near])
            at = np.minimum(np.searchsorted(sets[i], flat), len(sets[i]) - 1)
            common = np.add.reduceat(sets[i][at] == flat, np.cumsum(lengths[near]) - lengths[near], dtype=np.int64)
            return near[100 * common >= percent * (lengths[near] + lengths[i] - common)]

        def visit(i: int, among: np.ndarray) -> None:
            near, share = alike(i, among)
            if top is not None:
                near = near[np.argsort(-share, kind="stable")[:top]]
            else:
                near = linked(i, near)
                near = near[np.unique(comp[near], return_index=True)[1]]
            out.extend((int(min(ids[j], ids[i])), int(max(ids[j], ids[i]))) for j in near)

        right = np.flatnonzero(is_right)
        for i in np.flatnonzero(is_left):
            visit(i, right)
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("key", "lo", "hi").applyInArrow(compare, "a long, b long").where("a <> b").distinct()


def rare_pairs(facts: DataFrame, percent: int, rare: int) -> tuple[DataFrame, DataFrame]:
    """(a, b) pairs of different components that share one of their rarest shingles, by an exact
    prefix filter over ``facts`` (id, component, shingles binary), and the ids of those that
    meet at a shingle which more than ``rare`` of them have, and so aren't in the pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            sets = [np.frombuffer(x, np.int64) for x in b.column("shingles").to_pylist()]
            n = np.array([len(x) for x in sets], np.int64)
            own = pa.array(np.repeat(np.arange(len(n)), n))
            flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id").take(own), b.column("component").take(own), pa.array(np.repeat(n, n)), pa.array(flat)], ["id", "component", "n", "shingle"])

    tokens = materialize(facts.select("id", "component", "shingles").mapInArrow(run, "id long, component long, n long, shingle long"), "tokens")
    # a shingle of one member meets nobody, but takes its place at the front of the order
    df = tokens.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = salted_join(tokens, df, "shingle", "df", tokens.count())
    own = shared.groupBy("id", "component", "n").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("s"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.size("s"))
    front = own.where(prefix > 0).select("id", "component", "n", F.explode(F.slice("s", F.lit(1), prefix.cast("int"))["shingle"]).alias("shingle"))
    front = materialize(front, "prefixes")
    groups = front.groupBy("shingle").agg(F.count(F.lit(1)).alias("g"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("shingle", "g")
    met = materialize(salted_join(front, groups, "shingle", "g", front.count()), "meetings")
    mates = met.where(F.col("g") <= rare).groupBy("shingle").agg(F.sort_array(F.collect_list(F.struct("id", "component", "n"))).alias("m"))
    near = lambda x, y: (x["component"] != y["component"]) & (100 * F.least(x["n"], y["n"]) >= percent * F.greatest(x["n"], y["n"]))
    pairs = mates.select(F.explode("m").alias("x"), "m").select("x", F.explode(F.filter("m", lambda y: y["id"] > F.col("x.id"))).alias("y"))
    pairs = materialize(pairs.where(near(F.col("x"), F.col("y"))).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct(), "pairs")
    frequent = materialize(met.where(F.col("g") > rare).select("id").distinct(), "frequent")
    for table in (tokens, front, met):
        discard(table)
    return pairs, frequent


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 28, rows: int = 4, id_col: str = "doc_id", text_col: str = "text", broadcast_ids: int = 2_000_000, rare: int = 32, offers: int = 2, rounds: int = 2) -> DataFrame:
    """(id, n_shingles, component, kept) of each row; kept: it is its component's smallest id."""
    signed = materialize(signatures(docs, width, bands, rows, id_col, text_col), "signatures")
    linked = signed.where("id IS NOT NULL AND n_shingles > 0")
    copies = linked.groupBy("digest").agg(F.min("id").alias("rep"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("rep < last").select("digest", "rep", "n")
    total = linked.count()
    classes = materialize(salted_join(linked.select("id", "digest"), copies, "digest", "n", total).where("id > rep").select("id", "digest", "rep").distinct(), "classes")
    reps = materialize(linked.join(classes.select("id", "digest"), ["id", "digest"], "left_anti"), "representatives")

    buckets = reps.select("id", F.posexplode("keys").alias("band", "key"))
    pivots = buckets.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("pivot < last").drop("last")
    shared = materialize(salted_join(buckets, pivots, "key", "n", bands * total).select("key", "band", "id", "pivot", "n"), "buckets")

    sigma = (percent * (100 - percent) / 1e4 / (bands * rows)) ** 0.5
    least = percent / 100 - 4 * sigma
    candidates = shared.where("id > pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()

    def sets_of(wanted: DataFrame) -> DataFrame:
        ids = materialize(wanted.distinct(), "ids")
        few = ids.count() <= broadcast_ids
        texts = keyed_text(docs, id_col, text_col).join(F.broadcast(ids) if few else ids, "id", "left_semi")
        sets = materialize(shingle_sets(texts, width), "sets")
        discard(ids)
        return sets

    def confirmed(pairs: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        near = materialize(pairs, "near")
        known = sets if sets is not None else sets_of(near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id"))))
        links = materialize(sets_agree(near, known, percent), "links")
        discard(near)
        if sets is None:
            discard(known)
        return links

    def mixed_buckets(component: DataFrame, among: DataFrame | None = None) -> DataFrame:
        rows = shared.where("n > 2") if among is None else shared.where("n > 2").join(among, "id", "left_semi")
        rows = rows.join(component, "id", "left").select("key", "band", "id", F.coalesce("component", "id").alias("component"))
        rows = materialize(rows, "members")
        mixed = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo < hi").select("key", "n")
        mixed = materialize(salted_join(rows, mixed, "key", "n", rows.count()).drop("n"), "mixed")
        discard(rows)
        return mixed

    def grown(component: DataFrame | None, links: DataFrame) -> DataFrame:
        """Components with more links: the stars so far stand for all links before."""
        if component is None:
            new = connected_components(links)
        else:
            new = connected_components(component.select(F.col("component").alias("a"), F.col("id").alias("b")).unionByName(links))
            discard(component)
        if hasattr(links, "scratch_path"):
            discard(links)
        return new

    component = grown(None, confirmed(signatures_agree(candidates, reps, least)))
    rest = mixed_buckets(component)
    if not rest.isEmpty():
        open_ids = materialize(rest.select("id", "component").distinct(), "open")
        discard(rest)
        sets = sets_of(open_ids.select("id"))
        pairs, frequent = rare_pairs(open_ids.join(sets, "id"), percent, rare)
        component = grown(component, confirmed(signatures_agree(pairs, reps, least), sets))
        discard(pairs)
        tested = candidates.where("false")
        for _ in range(rounds):
            rest = mixed_buckets(component, frequent)
            if rest.isEmpty():
                break
            pairs = cross_pairs(rest, reps, least, bands, percent, offers)
            pairs = materialize(pairs.join(tested, ["a", "b"], "left_anti"), "offers")
            discard(rest)
            if pairs.isEmpty():
                break  # the best partners are all tested; the others follow below
            tested = tested.unionByName(pairs)
            component = grown(component, confirmed(pairs, sets))
        rest = mixed_buckets(component, frequent)
        if not rest.isEmpty():
            facts = reps.select("id", "signature").join(sets, "id")
            component = grown(component, materialize(cross_pairs(rest, facts, least, bands, percent), "links"))
        discard(sets)
    # copies hang on their representative's component
    joined = classes.select("id", "rep").distinct().join(component.withColumnRenamed("id", "rep"), "rep", "left")
    copied = joined.select(F.coalesce("component", "rep").alias("b"), F.col("id").alias("a"))
    component = grown(component, copied)
    for table in (classes, reps, shared):
        discard(table)
    out = signed.select("id", "n_shingles").join(component, "id", "left")
    out = out.withColumn("component", F.coalesce("component", "id"))
    return out.withColumn("kept", F.coalesce(F.col("component") == F.col("id"), F.lit(True)))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_ids: int = 2_000_000, **options) -> DataFrame:
    """The rows of ``docs`` whose id is its component's smallest, with all columns.

    Rows of one id that differ go or stay together; null ids stay. The ids that go are
    broadcast up to ``broadcast_ids`` of them, so that texts aren't shuffled, else joined.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, broadcast_ids=broadcast_ids, **options)
    own = free_name(docs, "gone_id")
    gone = materialize(found.where("NOT kept").select(F.col("id").alias(own)).distinct(), "gone")
    few = gone.count() <= broadcast_ids
    return docs.join(F.broadcast(gone) if few else gone, docs[id_col].cast("long") == gone[own], "left_anti")
