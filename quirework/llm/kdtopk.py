"""Exact top-k inner-product search with KD-trees per shard.

Dealing. The upper splits of one KD-tree, fitted on a bounded sample (``sample_per_cell`` rows
for each of at most ``max_cells`` cells), deal all rows to cells; a cell of more than
``shard_rows`` rows, as many equal vectors make it, is dealt on to shards by a hash. Queries
are dealt to blocks of at most ``block_rows`` in the same order of cells, so that a block's
queries lie close to each other. The sample decides where a row goes, never what is found.

Search. A shard builds a KD-tree by median splits on the widest dimension, with tight
bounding boxes. A query visits leaves best-first by the box-to-query bound, the largest inner
product a point of the box can have (each dimension at the better of its two ends), and ends
when no bound reaches its kth score. As a leaf's bound is never above that of a box around it,
the order of leaves by their own bounds is the best-first order, and a block's queries walk
it together: the bounds are two matrix products, and all queries at a leaf are scored by one.

The kth score is propagated. A query first visits a shard of the cell with its highest
bound; its kth score there is the floor it starts the next wave with, the best of the other
cells, and what that gives is the floor of the last wave. A (query, shard) pair whose cell's
bound is below the floor is dropped before anything is shipped. A cell's box spans all of its
rows, so this loses nothing.

Each wave joins blocks with the shards they still want, a bounded group each: the rows
shipped are rows x blocks + queries x shards less what the bounds exclude. On vectors without
any structure no box excludes anything, and every block meets every shard.

Components are integers, floor(scale * x). Scores are exact: in float64 where every product
sum is below 2^53, in int64 below 2^62, else in Python's integers. Ties go to the smaller id.
The waves of a query are merged by a rank window that Spark limits map-side.

Defined results: a vector that is null, empty, or holds null or non-finite components takes no
part, also where scale * x leaves double's range; vectors of other lengths than the query's are
no candidates; rows with the query's id are left out as its own; repeated rows count
each; a score outside of long is given as long's nearest value, ranked by its exact one; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm.common import materialize, sliced

LONG = (1 << 63) - 1
#: Added to a score outside of long, whose digits are then its place in the order.
WIDE = 10**700


def exact(points: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integer-valued doubles in a type in which all of their inner products are exact."""
    big = float(np.abs(points).max(initial=0)) * float(np.abs(queries).max(initial=0)) * points.shape[1]
    if big < 2**53:
        return points, queries
    if big < 2**62 and max(np.abs(points).max(), np.abs(queries).max()) < 2**62:
        return points.astype(np.int64), queries.astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return whole(points), whole(queries)


def bounds(queries: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Query x box: the largest inner product with any point of the box."""
    return np.maximum(queries, 0) @ hi.T + np.minimum(queries, 0) @ lo.T


class Best:
    """The k best (score, id) of each query of a chunk, so far."""

    def __init__(self, n: int, k: int, floors: list[int | None]):
        self.k = k
        self.query, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.known = np.array([x is not None for x in floors], bool)
        self.kth = np.array([x or 0 for x in floors], np.int64)

    def add(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """Parts of (query, score, id); afterwards ``kth`` holds each query's kth score where it has k."""
        if not parts:
            return
        q, s, i = (np.concatenate([x, *(p[j] for p in parts)]) for j, x in enumerate((self.query, self.score, self.id)))
        order = np.lexsort((i, -s, q)) if s.dtype != object else np.array(sorted(range(len(s)), key=lambda n: (q[n], -s[n], i[n])), np.int64)
        q, s, i = q[order], s[order], i[order]
        first = np.searchsorted(q, q)
        place = np.arange(len(q)) - first
        keep = place < self.k
        self.query, self.score, self.id = q[keep], s[keep], i[keep]
        last = place[keep] == self.k - 1
        at, kth = self.query[last], self.score[last]
        if s.dtype == object:
            self.kth = self.kth.astype(object)
        self.kth[at] = np.where(self.known[at], np.maximum(self.kth[at], kth), kth)
        self.known[at] = True

    def reached(self, query: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Where a value, or a row of values, is at least its query's kth score; everywhere without one."""
        kth, known = self.kth[query], self.known[query]
        if value.ndim == 2:
            kth, known = kth[:, None], known[:, None]
        if value.dtype == object:
            return ~known | (value >= kth).astype(bool)
        return ~known | (value >= kth.astype(value.dtype))


class KDTree:
    """Median splits with tight boxes; a leaf holds at most ``leaf`` rows, or equal ones."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = 128):
        order = np.argsort(ids, kind="stable")
        self.points, self.ids, self.rows = points[order], ids[order], []
        self._build(np.arange(len(ids)), leaf)
        self.lo = np.array([self.points[r].min(axis=0) for r in self.rows])
        self.hi = np.array([self.points[r].max(axis=0) for r in self.rows])

    def _build(self, rows: np.ndarray, leaf: int) -> None:
        p = self.points[rows]
        width = p.max(axis=0) - p.min(axis=0)
        d = int(np.argmax(width))
        if len(rows) <= leaf or not width[d] > 0:
            self.rows.append(rows)
            return
        half = len(rows) // 2
        part = np.argsort(p[:, d], kind="stable") if p.dtype == object else np.argpartition(p[:, d], half)
        self._build(np.sort(rows[part[:half]]), leaf)
        self._build(np.sort(rows[part[half:]]), leaf)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, floors: list[int | None]) -> tuple[Best, int]:
        """The k best rows of each query that reach its floor, and how many (query, leaf) pairs were scored."""
        best, scored = Best(len(queries), k, floors), 0
        bound = bounds(queries, self.lo, self.hi)
        order = np.argsort(-bound, axis=1, kind="stable")
        at, step = 0, 1  # the leaves at ranks at .. at + step of each query, in doubling strides
        while at < len(self.rows):
            ranks = order[:, at : at + step]
            query = np.repeat(np.arange(len(queries)), ranks.shape[1])
            leaf = ranks.reshape(-1)
            open_ = best.reached(query, bound[query, leaf])
            if not open_.any():
                break
            query, leaf = query[open_], leaf[open_]
            by_leaf = np.argsort(leaf, kind="stable")
            query, leaf = query[by_leaf], leaf[by_leaf]
            scored += len(query)
            found = []
            for here in np.split(np.arange(len(leaf)), np.flatnonzero(np.diff(leaf)) + 1):
                rows, asked = self.rows[leaf[here[0]]], query[here]
                s, ids = queries[asked] @ self.points[rows].T, self.ids[rows]
                take = (ids[None, :] != own[asked][:, None]) & best.reached(asked, s)
                x, y = np.nonzero(take)
                score = s[x, y]
                found.append((asked[x], score if score.dtype == object else score.astype(np.int64), ids[y]))
            best.add(found)
            at, step = at + step, 2 * step
        return best, scored


class Splits:
    """The upper splits of a KD-tree over a sample: a row's cell by descent."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.dim, self.at, self.child, self.cells = [], [], [], 0
        self._build(sample, cells)

    def _build(self, p: np.ndarray, cells: int) -> int:
        me = len(self.child)
        self.dim.append(0)
        self.at.append(0.0)
        self.child.append((-1, self.cells))
        width = p.max(axis=0) - p.min(axis=0) if len(p) else np.zeros(1)
        d = int(np.argmax(width))
        if cells > 1 and width[d] > 0:
            cut = float(np.median(p[:, d]))
            low = p[:, d] < cut if (p[:, d] < cut).any() else p[:, d] <= cut
            cut = float(p[low, d].max())  # rows up to the cut go left
            low = p[:, d] <= cut
            if not low.all():
                self.dim[me], self.at[me] = d, cut
                self.child[me] = (self._build(p[low], cells // 2), self._build(p[~low], cells - cells // 2))
                return me
        self.cells += 1
        return me

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            left, right = self.child[node]
            if left < 0:
                out[rows] = right
                continue
            low = points[rows, self.dim[node]] <= self.at[node]
            todo += [(left, rows[low]), (right, rows[~low])]
        return out


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def integers(vectors: DataFrame, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, v): floor(scale * x) as float64 bytes of each vector that takes part."""
    x = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("x"))
    x = x.where(F.col("id").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda e: e.isNotNull()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 4096):
            x = b.column("x")
            with np.errstate(over="ignore", invalid="ignore"):
                flat = np.floor(scale * np.array(x.flatten()))
            size = np.array(x.value_lengths()).astype(np.int64)
            start = np.cumsum(size) - size
            fine = np.add.reduceat(~np.isfinite(flat), start) == 0 if len(size) else np.zeros(0, bool)
            v = [flat[a : a + n].tobytes() for a, n in zip(start[fine], size[fine], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id").filter(pa.array(fine)), pa.array(size[fine].astype(np.int32)), pa.array(v, pa.binary())], ["id", "dim", "v"])

    return x.mapInArrow(run, "id long, dim int, v binary")


def _with_cells(x: DataFrame, splits: dict[int, Splits]) -> DataFrame:
    """Adds each row's cell and a number of its own, by which equal rows are dealt apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for b in sliced(batches, 4096):
            dims, cell = b.column("dim").to_numpy(), np.zeros(b.num_rows, np.int32)
            for dim in np.unique(dims):
                if (s := splits.get(int(dim))) is not None:
                    here = np.flatnonzero(dims == dim)
                    cell[here] = s.cell_of(_matrix(b.column("v").take(pa.array(here)), int(dim)))
            own = np.arange(number, number + b.num_rows)
            number += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(own)], [*b.schema.names, "cell", "number"])

    return x.mapInArrow(run, "id long, dim int, v binary, cell int, number long")


def _boxes(rows: DataFrame, splits: dict[int, Splits]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per length of vectors the boxes (lo, hi) of its cells; cells x components numbers come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], list[np.ndarray]] = {}
        for b in sliced(batches, 4096):
            dims, cells = b.column("dim").to_numpy(), b.column("cell").to_numpy()
            for dim in np.unique(dims):
                if int(dim) not in splits:
                    continue
                here = np.flatnonzero(dims == dim)
                m = _matrix(b.column("v").take(pa.array(here)), int(dim))
                for c in np.unique(cells[here]):
                    p = m[cells[here] == c]
                    lo, hi = p.min(axis=0), p.max(axis=0)
                    old = seen.setdefault((int(dim), int(c)), [lo, hi])
                    old[0], old[1] = np.minimum(old[0], lo), np.maximum(old[1], hi)
        for (dim, c), (lo, hi) in seen.items():
            cols = [np.full(dim, dim, np.int32), np.full(dim, c, np.int32), np.arange(dim, dtype=np.int32), lo, hi]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["dim", "cell", "i", "lo", "hi"])

    parts = rows.mapInArrow(run, "dim int, cell int, i int, lo double, hi double")
    got = parts.groupBy("dim", "cell", "i").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).toPandas()
    out = {}
    for dim, s in splits.items():
        lo, hi = np.full((s.cells, dim), np.inf), np.full((s.cells, dim), -np.inf)
        g = got[got["dim"] == dim]
        lo[g["cell"], g["i"]], hi[g["cell"], g["i"]] = g["lo"], g["hi"]
        empty = np.isinf(lo).any(axis=1)
        lo[empty] = hi[empty] = 0.0
        out[dim] = (lo, hi)
    return out


def loose_bounds(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """``bounds`` in float64, moved up by more than its rounding error can be."""
    with np.errstate(over="ignore", invalid="ignore"):
        b = bounds(q, lo, hi)
        slack = (np.abs(q) @ np.maximum(np.abs(lo), np.abs(hi)).T) * (q.shape[1] * 2.0**-51)
        return np.where(np.isnan(b + slack), np.inf, b + slack)


def top_k(vectors: DataFrame, k: int = 20, scale: float = 64.0, query_every: int = 20, shard_rows: int = 16384, block_rows: int = 16384, leaf: int = 128, max_cells: int = 1024, sample_per_cell: int = 64, near_share: float = 0.125, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): rows whose id is divisible by ``query_every`` against all rows.

    ``near_share``: the share of the cells that the second of three waves visits.
    """
    x = materialize(integers(vectors, scale, id_col, vector_col), "vectors")
    n = x.count()
    cells = 1 << max(0, -(-n // shard_rows) - 1).bit_length()
    cells = min(cells, max_cells)
    wanted = cells * sample_per_cell
    sample = x.sample(min(1.0, wanted / max(n, 1)), seed=7).limit(2 * wanted).select("dim", "v").toArrow()
    by_dim: dict[int, list[bytes]] = {}
    for dim, v in zip(sample.column("dim").to_pylist(), sample.column("v").to_pylist(), strict=True):
        by_dim.setdefault(dim, []).append(v)
    splits = {d: Splits(np.frombuffer(b"".join(v), np.float64).reshape(-1, d), max(1, cells * len(v) // max(1, sample.num_rows))) for d, v in by_dim.items()}
    x = materialize(_with_cells(x, splits), "cells")
    boxes = _boxes(x, splits)

    is_query = F.col("id") % query_every == 0
    counts = x.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q"))
    # a cell's shards, and its blocks: small cells that follow one another share one
    follow = Window.partitionBy("dim").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    group = F.floor(F.coalesce(F.sum("q").over(follow), F.lit(0)) / block_rows).cast("int")
    parts = lambda c, size: F.greatest(F.ceil(F.col(c) / size), F.lit(1)).cast("int")
    counts = materialize(counts.select("dim", "cell", parts("n", shard_rows).alias("shards"), parts("q", block_rows).alias("blocks"), group.alias("group")), "counts")
    deal = lambda of, seed: F.pmod(F.xxhash64("number", F.lit(seed)), F.col(of)).cast("int")
    placed = x.join(counts, ["dim", "cell"])
    rows = placed.select("dim", "cell", deal("shards", 1).alias("shard"), "id", "v")
    # a hot cell's blocks lie behind each other in its group
    asked = placed.where(is_query).select(F.col("dim"), F.col("id").alias("q_id"), F.col("v").alias("q_v"), "group", deal("blocks", 2).alias("part"))
    asked = materialize(asked, "queries")
    shards = counts.select("dim", "cell", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))

    def choose(queries: DataFrame, wave: int) -> DataFrame:
        """Queries with the cells this wave takes them to; without boxes all of them at once."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in sliced(batches, 1024):
                dims, floors = b.column("dim").to_numpy(), b.column("floor").to_numpy(zero_copy_only=False).astype(float)
                out: list = [None] * b.num_rows
                for dim in np.unique(dims):
                    here = np.flatnonzero(dims == dim)
                    if int(dim) not in boxes:
                        for r in here:
                            out[r] = [0] if wave == 0 else []
                        continue
                    lo, hi = boxes[int(dim)]
                    bound = loose_bounds(_matrix(b.column("q_v").take(pa.array(here)), int(dim)), lo, hi)
                    order = np.argsort(-bound, axis=1, kind="stable")
                    near = 1 + int(np.ceil((len(lo) - 1) * near_share))
                    part = order[:, :1] if wave == 0 else order[:, 1:near] if wave == 1 else order[:, near:]
                    for r, cells_of, b_of, floor in zip(here, part, bound, floors[here], strict=True):
                        out[r] = cells_of[~(b_of[cells_of] < floor)].tolist() if len(cells_of) else []
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.list_(pa.int32()))], [*b.schema.names, "cells"])

        fields = "dim int, q_id long, q_v binary, group int, part int, floor long, cells array<int>"
        return queries.mapInArrow(run, fields)

    def visit(wanted: DataFrame) -> DataFrame:
        """The k best of each query in the shards of its cells."""
        pairs = wanted.select("dim", "group", "part", "q_id", "q_v", "floor", F.explode("cells").alias("cell")).join(shards, ["dim", "cell"])
        keys = ["dim", "cell", "shard", "group", "part"]
        left = rows.join(pairs.select(*keys).distinct(), ["dim", "cell", "shard"]).select(*keys, "id", "v")

        def run(key, mine: pa.Table, queries: pa.Table) -> pa.Table:
            out: list[list] = [[], [], [], []]
            if mine.num_rows and queries.num_rows:
                dim = key[0].as_py()
                points, q = exact(_matrix(mine.column("v"), dim), _matrix(queries.column("q_v"), dim))
                tree = KDTree(points, mine.column("id").to_numpy(), leaf)
                ids, floors = queries.column("q_id").to_numpy(), queries.column("floor").to_pylist()
                for at in range(0, len(ids), 1024):
                    best, _ = tree.search(q[at : at + 1024], ids[at : at + 1024], k, floors[at : at + 1024])
                    score = best.score.tolist()
                    out[0] += ids[at + best.query].tolist()
                    out[1] += best.id.tolist()
                    out[2] += [max(-LONG - 1, min(LONG, s)) for s in score]
                    out[3] += [None if -LONG - 1 < s < LONG else f"{WIDE + s:0702d}" for s in score]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            return pa.table({c: pa.array(v, t) for c, v, t in zip(("query_id", "vec_id", "score", "wide"), out, kinds, strict=True)})

        right = pairs.select(*(F.col(c).alias(f"q_{c}") for c in keys), "q_id", "q_v", "floor")
        return left.groupBy(*keys).cogroup(right.groupBy(*(f"q_{c}" for c in keys))).applyInArrow(run, "query_id long, vec_id long, score long, wide string")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("wide"), "vec_id")
    queries = asked.withColumn("floor", F.lit(None).cast("long"))
    found = None
    waves = 3 if any(s.cells > 1 for s in splits.values()) else 1
    for wave in range(waves):
        part = visit(choose(queries, wave))
        found = part if found is None else found.unionByName(part)
        found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank")
        if wave + 1 < waves:
            found = materialize(found, "found")
            # a score at long's end may stand for any beyond it: no floor
            full = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("f")).where(F.col("n") >= k)
            floor = full.select(F.col("query_id").alias("q_id"), F.when(F.abs(F.col("f").cast("double")) < 2.0**62, F.col("f")).alias("floor"))
            queries = asked.join(floor, "q_id", "left").select("dim", "q_id", "q_v", "group", "part", "floor")
    return found.withColumn("rank", F.row_number().over(best)).select("query_id", "rank", "vec_id", "score")
