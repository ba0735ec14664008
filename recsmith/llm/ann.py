"""Approximate nearest neighbours by stable low-dimensional projections.

Largest inner product becomes Euclidean distance by one more coordinate, sqrt(M^2 - |x|^2) (zero
for queries).  Gaussian (2-stable) projections to ``PROJECTED`` dimensions are indexed by a
kd-tree: its splits are fitted on a bounded sample (``SAMPLE`` points, ``MAX_CELLS`` cells at most),
every row is put into one of its cells, and a cell is held in blocks of about ``CELL_ROWS`` points,
however many it has.

A query visits cells by growing distance in the projected space, the nearest one first and then
twice as many in each step (Sun et al., 2014, with the order of the tree's cells).  In a cell its
points are taken by growing projected distance, in batches: a batch is verified with the original
vectors, the k-th best so far moves up, and the search ends by the chi-square test.  The squared
projected distance of a point at the distance d of the k-th best is d^2 times a chi-square variable,
so once the next projected neighbour is beyond d^2 times its ``STOP`` quantile, a better point is left
with probability 1 - ``STOP`` at most.  Points beyond are never scored, and cells beyond are never
visited.  Each step is a join of blocks of the queries that ask for a cell with the cell's blocks
of points; cells that nobody asks for are not copied.  How much is saved depends on the data:
vectors without any structure have their k-th neighbour nearly as far as all others, so few
cells can be ruled out by any method; ``n_verified`` tells how many points each query has scored.

Equal vectors are searched once and share their result.  Scores are double-precision inner
products of the original vectors; ties go to the smaller id.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part,
nor do rows with a null id or with another number of dimensions than most rows (the smaller
number if there are as many); repeated rows (id and vector) count once, and a query's own id is
never its neighbour; with fewer candidates than ``k`` all are returned; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsmith.llm.common import importable
from recsmith.session import materialise

PROJECTED = 24       # dimensions of the projected space (even)
STOP = 0.94          # quantile of the stopping test
SAMPLE = 20_000      # points the kd-tree is fitted on, at most
CELL_ROWS = 4096     # points of a cell, and of a block of a larger cell, about
MAX_CELLS = 4096
QUERY_BLOCK = 8192   # queries that meet a block of points in one task, about
BATCH = 32           # points of the first batch that a query verifies in a cell
MOST = 256           # points of any batch
HELD_QUERIES = 64    # queries worked off together
SEED = 11


def chi_square_quantile(p: float, m: int) -> float:
    """Quantile of the chi-square distribution with an even number ``m`` of degrees of freedom."""
    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))

    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


class KdCells:
    """The upper part of a kd-tree: boxes that cover the projected space."""

    def __init__(self, points: np.ndarray, cells: int):
        m = points.shape[1]
        self.axis: list[int] = []
        self.cut: list[float] = []
        self.child: list[tuple[int, int]] = []  # node numbers, or -1 - cell
        low, high = [], []

        def build(rows: np.ndarray, n: int, lo: np.ndarray, hi: np.ndarray) -> int:
            if n == 1 or len(rows) < 2:
                low.append(lo)
                high.append(hi)
                return -len(low)
            axis = int(np.argmax(rows.max(axis=0) - rows.min(axis=0)))
            cut = float(np.median(rows[:, axis]))
            me = len(self.axis)
            self.axis.append(axis)
            self.cut.append(cut)
            self.child.append((0, 0))
            left_hi, right_lo = hi.copy(), lo.copy()
            left_hi[axis] = right_lo[axis] = cut
            self.child[me] = (build(rows[rows[:, axis] < cut], n // 2, lo, left_hi),
                              build(rows[rows[:, axis] >= cut], n - n // 2, right_lo, hi))
            return me

        self.root = build(points, max(1, cells), np.full(m, -np.inf), np.full(m, np.inf))
        self.low, self.high = np.array(low), np.array(high)

    def cell(self, points: np.ndarray) -> np.ndarray:
        at = np.full(len(points), self.root)
        axis, cut, child = np.array(self.axis, int), np.array(self.cut), np.array(self.child, int).reshape(-1, 2)
        while (inner := at >= 0).any():
            k = at[inner]
            right = points[inner, axis[k]] >= cut[k]
            at[inner] = child[k, right.astype(int)]
        return -1 - at

    def distance(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of each point to each cell's box."""
        gap = np.maximum(np.maximum(self.low[None] - points[:, None], points[:, None] - self.high[None]), 0)
        return (gap ** 2).sum(axis=2)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, width)


def usable(vec: Column) -> Column:
    """Whether a vector takes part."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vec.isNotNull() & (F.size(vec) > 0) & fine & F.exists(vec, lambda x: x != 0)


class Searcher:
    """The fitted index: largest norm, projection and cells; plain arrays that tasks receive."""

    def __init__(self, width: int, top: float, matrix: np.ndarray, cells: KdCells | None, stop: float, k: int):
        self.width, self.top, self.matrix, self.cells, self.k = width, top, matrix, cells, k
        self.limit = chi_square_quantile(stop, matrix.shape[1])

    def project(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.top - (x ** 2).sum(axis=1), 0))
        return x @ self.matrix[:-1] + more[:, None] * self.matrix[-1]

    def reach(self, x: np.ndarray, kth: np.ndarray) -> np.ndarray:
        """Squared projected distance at which the search of each query may stop."""
        d = np.maximum((x ** 2).sum(axis=1) + self.top - 2 * kth, 0)  # of the k-th best; inf without one
        return self.limit * d * (1 + 1e-9) + 1e-12


def _assign(s: Searcher):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cell = s.cells.cell(s.project(_matrix(b.column("vec"), s.width)))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32))],
                                                 names=[*b.schema.names, "cell"])

    return run


def _visits(s: Searcher, first: int, last: int):
    """(cell, qid, kth): which queries (qid, vec, kth) visit which of their ``first``-th to ``last``-th cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = len(s.cells.low)
        held = max(1, 1_000_000 // (cells * s.matrix.shape[1]))
        for whole in batches:
            for at in range(0, whole.num_rows, held):
                b = whole.slice(at, held)
                x = _matrix(b.column("vec"), s.width)
                p = s.project(x, query=True)
                dist = s.cells.distance(p)
                order = np.where(np.arange(cells) == s.cells.cell(p)[:, None], -1, dist)
                rank = np.argsort(np.argsort(order, axis=1, kind="stable"), axis=1, kind="stable")
                kth = np.where(np.isnan(k := b.column("kth").to_numpy(zero_copy_only=False).astype(float)), -np.inf, k)
                q, c = np.nonzero((rank >= first) & (rank < last) & (dist <= s.reach(x, kth)[:, None]))
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), b.column("qid").take(pa.array(q)), pa.array(kth[q])],
                                                 names=["cell", "qid", "kth"])

    return run


def _search(s: Searcher, q: np.ndarray, pq: np.ndarray, kth: np.ndarray, x: np.ndarray, px: np.ndarray):
    """The ``k`` best points for each query (scores and positions, falling; -inf where there are fewer) among
    those verified, and how many that were.  ``kth``: what a point must reach to be wanted at all."""
    gap = (pq ** 2).sum(1)[:, None] + (px ** 2).sum(1)[None] - 2 * pq @ px.T
    order = np.argsort(gap, axis=1, kind="stable")
    best = np.full((len(q), s.k), -np.inf)
    place = np.full((len(q), s.k), len(x))
    verified = np.zeros(len(q), np.int64)
    live, at, size = np.arange(len(q)), 0, BATCH
    while len(live) and at < len(x):
        idx = order[live, at:at + size]
        reach = s.reach(q[live], np.maximum(kth[live], best[live, -1]))
        near = np.take_along_axis(gap[live], idx, axis=1) <= reach[:, None] + 1e-9
        verified[live] += near.sum(axis=1)
        score = np.where(near, np.einsum("qd,qbd->qb", q[live], x[idx]), -np.inf)
        score, idx = np.concatenate([best[live], score], axis=1), np.concatenate([place[live], idx], axis=1)
        by = np.argsort(idx, axis=1, kind="stable")  # points lie by id: ties go to the smaller one
        score, idx = np.take_along_axis(score, by, axis=1), np.take_along_axis(idx, by, axis=1)
        by = np.argsort(-score, axis=1, kind="stable")[:, :s.k]
        best[live], place[live] = np.take_along_axis(score, by, axis=1), np.take_along_axis(idx, by, axis=1)
        live = live[near[:, -1]]  # the others have met the test
        at, size = at + size, min(2 * size, MOST)
    return best, place, verified


_FOUND = pa.schema([("qid", pa.int64()), ("id", pa.int64()), ("score", pa.float64()), ("n_verified", pa.int64())])


def _verify(s: Searcher):
    """Candidates of the queries of a block in a block of points, and a row without id for the number verified."""
    def run(queries: pa.Table, points: pa.Table) -> pa.Table:
        if not queries.num_rows or not points.num_rows:
            return _FOUND.empty_table()
        points = points.sort_by("pid")
        qid = queries.column("qid").to_numpy()
        q = _matrix(queries.column("vec").combine_chunks(), s.width)
        kth = queries.column("kth").to_numpy()
        x = _matrix(points.column("vec").combine_chunks(), s.width)
        ids = points.column("ids").to_pylist()
        px, pq = s.project(x), s.project(q, query=True)
        out_q, out_i, out_s, counts = [], [], [], []
        for at in range(0, len(q), HELD_QUERIES):
            part = slice(at, at + HELD_QUERIES)
            best, place, verified = _search(s, q[part], pq[part], kth[part], x, px)
            counts.append(verified)
            wanted = (best > -np.inf) & (best >= kth[part][:, None] - 1e-9)
            for r in np.flatnonzero(wanted.any(axis=1)).tolist():
                rows = sorted((-v, i) for v, c in zip(best[r, wanted[r]].tolist(), place[r, wanted[r]].tolist())
                              for i in ids[c])[:s.k]
                out_q += [qid[at + r]] * len(rows)
                out_i += [i for _, i in rows]
                out_s += [-v for v, _ in rows]
        none = [None] * len(qid)
        return pa.table([pa.array([*out_q, *qid.tolist()], pa.int64()), pa.array(out_i + none, pa.int64()),
                         pa.array(out_s + none, pa.float64()),
                         pa.array([0] * len(out_q) + np.concatenate(counts).tolist(), pa.int64())], schema=_FOUND)

    return run


def nearest(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, every: int = 20,
            stop: float = STOP, cell_rows: int = CELL_ROWS, max_cells: int = MAX_CELLS, query_block: int = QUERY_BLOCK,
            projected: int = PROJECTED) -> DataFrame:
    """The ``k`` largest inner products (query_id, rank, vec_id, score, and n_verified, the points that the query
    has scored) of the rows whose id is divisible by ``every``, among all other rows."""
    spark = df.sparkSession
    importable(spark)
    want = k + 1  # the query's own row is found as well
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vec")))
    widths = rows.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    width = widths["n"] if widths else 1
    rows = materialise(rows.filter(F.size("vec") == width).distinct())
    # equal vectors are one point with its smallest ids (more of them cannot be wanted)
    by_vec = Window.partitionBy("vec").orderBy("id")
    points = (rows.withColumn("n", F.row_number().over(by_vec)).filter(F.col("n") <= want)
              .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("pid", F.col("ids")[0]))
    points = materialise(points)
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    n, top = points.agg(F.count("*"), F.max(norm)).first()
    matrix = np.random.default_rng(SEED).normal(size=(width + 1, projected))
    s = Searcher(width, float(top or 0.0), matrix, None, stop, want)
    sample = points.orderBy(F.xxhash64("pid")).limit(SAMPLE).select("vec").toArrow()
    s.cells = KdCells(s.project(_matrix(sample.column("vec").combine_chunks(), width)),
                      min(max_cells, max(1, -(-n // cell_rows))))
    fitted = spark.sparkContext.broadcast(s)
    points = materialise(points.select("ids", "pid", "vec").mapInArrow(
        _late(_assign, fitted), "ids array<long>, pid long, vec array<double>, cell int"))
    sizes = points.groupBy("cell").agg(F.count("*").alias("n"))
    sizes = materialise(sizes.select("cell", F.expr(f"(n + {cell_rows - 1}) div {cell_rows}").alias("blocks")))  # MAX_CELLS rows at most
    points = points.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("pid"), F.col("blocks"))).drop("blocks")
    query_rows = rows.filter(F.col("id") % every == 0)
    queries = materialise(query_rows.groupBy("vec").agg(F.min("id").alias("qid")))
    by_query = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    best, counts, first = None, [], 0
    while first < len(s.cells.low):
        if best is None:
            state = queries.withColumn("kth", F.lit(None).cast("double"))
        else:
            kth = best.groupBy("qid").agg(F.count("*").alias("n"), F.min("score").alias("s"))
            state = queries.join(kth.filter(F.col("n") >= want).select("qid", F.col("s").alias("kth")), "qid", "left")
        visits = materialise(state.select("qid", "vec", "kth").mapInArrow(
            _late(_visits, fitted, first, 2 * first + 1), "cell int, qid long, kth double"))
        asked = visits.groupBy("cell").agg(F.expr(f"(count(1) + {query_block - 1}) div {query_block}").alias("asked"))
        some = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
        left = (visits.join(asked, "cell").withColumn("part", F.pmod(F.xxhash64("qid"), F.col("asked")))
                .join(sizes, "cell").withColumn("block", some("blocks"))
                .join(queries, "qid").select("cell", "part", "block", "qid", "vec", "kth"))
        right = points.join(asked, "cell").withColumn("part", some("asked")).select("cell", "part", "block", "pid", "ids", "vec")
        at = ["cell", "part", "block"]
        found = materialise(left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(
            _late(_verify, fitted), "qid long, id long, score double, n_verified long"))
        counts.append(found.filter("id is null").select("qid", "n_verified"))
        found = found.filter("id is not null").select("qid", "id", "score")
        found = found if best is None else found.union(best)
        best = materialise(found.withColumn("n", F.row_number().over(by_query)).filter(F.col("n") <= want)
                           .select("qid", "id", "score"))
        first = 2 * first + 1
    verified = reduce(DataFrame.union, counts).groupBy("qid").agg(F.sum("n_verified").alias("n_verified"))
    # every query row takes the result of its vector, without itself
    named = query_rows.join(queries, "vec").select(F.col("id").alias("query_id"), "qid").join(verified, "qid")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (named.join(best, "qid").filter(F.col("id") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias("vec_id"), "score", "n_verified"))


def _late(make, shared, *args):
    """A task function that takes the fitted index from the broadcast."""
    if make is _verify:
        return lambda left, right: make(shared.value, *args)(left, right)
    return lambda batches: make(shared.value, *args)(batches)
