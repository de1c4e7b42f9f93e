"""Nearest neighbours through low-dimensional stable projections and kd-trees.

Vectors are projected on ``DIMENSIONS`` Gaussian directions. For two vectors at
distance ``d`` the squared projected distance is ``d**2`` times a chi-square
variable, so once the next projected neighbour is farther than
``sqrt(quantile(CONFIDENCE)) * d_k``, with ``d_k`` the k-th best true distance
so far, an unseen vector closer than ``d_k`` is there with a chance below
``1 - CONFIDENCE`` only, and the search stops.

The projected space is cut by a kd-tree fitted on at most ``SAMPLE`` rows into
at most ``MAX_BLOCKS`` blocks; every row is indexed, and a block with more than
``PIECE_ROWS`` rows (a dense place, or a vector repeated many times) is dealt
out over several pieces by a hash. A piece builds its own kd-tree and answers
queries as they stream in: leaves come in the order of their distance from the
projected query, their vectors are verified by true distance, and the test is
made before every step. A query first searches one piece of its own block; the
k-th distance found there then rules out, by the same test, the blocks it need
not visit. No table of queries or vectors is broadcast.

Defined cases: vectors that are null, zero, hold null or non-finite numbers, or
whose length is not the most frequent one take no part, nor do null ids; equal
distances are ordered by id; rows of a query's own id are not its neighbours;
a query is an id and a vector: rows equal in both ask once, rows of one id with
other vectors ask and are ranked each for itself;
an empty table gives no rows; other columns are ignored.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapreel.llm.common import staged

DIMENSIONS, CONFIDENCE = 8, 0.97
SAMPLE, MAX_BLOCKS, PIECE_ROWS, LEAF_ROWS, STEP_LEAVES = 20_000, 4096, 8192, 32, 8
POINTS = "piece bigint, kind int, id bigint, vector {vector}, bound double, mark bigint"


def chi_square_quantile(p: float, dimensions: int) -> float:
    """Quantile of the chi-square distribution with an even number of degrees of freedom."""
    def cdf(x):
        term, total = 1.0, 1.0
        for k in range(1, dimensions // 2):
            term *= x / 2 / k
            total += term
        return 1 - math.exp(-x / 2) * total
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return high


def directions(length: int, dimensions: int = DIMENSIONS, seed: int = 17) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(length, dimensions))


def cut_space(sample: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Low and high corners of ``blocks`` (a power of two) regions halving the sample again and again."""
    m = sample.shape[1] if sample.ndim == 2 else DIMENSIONS
    regions = [(np.full(m, -np.inf), np.full(m, np.inf), sample)]
    while len(regions) < blocks:
        halves = []
        for low, high, rows in regions:
            axis = int(np.argmax(np.ptp(rows, axis=0))) if len(rows) else 0
            at = float(np.median(rows[:, axis])) if len(rows) else 0.0
            left, right = high.copy(), low.copy()
            left[axis], right[axis] = at, at
            halves += [(low, left, rows[rows[:, axis] < at]), (right, high, rows[rows[:, axis] >= at])]
        regions = halves
    return np.stack([r[0] for r in regions]), np.stack([r[1] for r in regions])


def box_distances(low: np.ndarray, high: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distance of a projected query from each box."""
    gap = np.maximum(np.maximum(low - q, q - high), 0)
    return (gap * gap).sum(axis=1)


class Piece:
    """A piece's vectors under a kd-tree of their projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projected: np.ndarray):
        order, leaves, todo = np.arange(len(ids)), [], [(0, len(ids))]
        while todo:
            a, b = todo.pop()
            if b - a <= LEAF_ROWS:
                leaves.append((a, b))
                continue
            part = order[a:b]
            axis = int(np.argmax(np.ptp(projected[part], axis=0)))
            half = (b - a) // 2
            order[a:b] = part[np.argpartition(projected[part, axis], half)]
            todo += [(a, a + half), (a + half, b)]
        self.leaves = leaves
        self.ids, self.vectors = ids[order], vectors[order].astype(np.float64)
        projected = projected[order]
        self.low = np.stack([projected[a:b].min(axis=0) for a, b in leaves])
        self.high = np.stack([projected[a:b].max(axis=0) for a, b in leaves])

    def nearest(self, own: int, vector: np.ndarray, q: np.ndarray, k: int, reach: float, bound: float):
        """The k nearest (distance, id) verified before the chi-square test stops the search."""
        away = box_distances(self.low, self.high, q)
        order = np.argsort(away, kind="stable")
        best_d, best_i = np.zeros(0), np.zeros(0, dtype=np.int64)
        limit = bound
        for at in range(0, len(order), STEP_LEAVES):
            step = order[at:at + STEP_LEAVES]
            if away[step[0]] > reach * limit * limit:
                break
            rows = np.concatenate([np.arange(*self.leaves[x]) for x in step])
            gap = self.vectors[rows] - vector
            d = np.sqrt((gap * gap).sum(axis=1))
            ids = self.ids[rows]
            mine = (d <= limit) & (ids != own)
            best_d, best_i = np.concatenate([best_d, d[mine]]), np.concatenate([best_i, ids[mine]])
            if len(best_d) > k:
                keep = np.lexsort((best_i, best_d))[:k]
                best_d, best_i = best_d[keep], best_i[keep]
            if len(best_d) == k:
                limit = min(limit, float(best_d.max()))
        keep = np.lexsort((best_i, best_d))
        return best_d[keep], best_i[keep]


def _search(rows: DataFrame, k: int, length: int, dimensions: int, reach: float) -> DataFrame:
    """Answer the queries (kind 1) of each piece by its points (kind 0), piece by piece."""
    def answer(batches):
        basis = directions(length, dimensions)
        held, ids, vectors, tree = None, [], [], None
        for batch in batches:
            piece, kind, own, bound, mark = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1, 2, 4, 5))
            flat = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
            out = [[], [], [], []]
            edges = np.flatnonzero(np.concatenate([[True], (piece[1:] != piece[:-1]) | (kind[1:] != kind[:-1]), [True]]))
            for a, b in zip(edges[:-1], edges[1:]):
                if piece[a] != held:
                    held, ids, vectors, tree = piece[a], [], [], None
                if kind[a] == 0:
                    ids.append(own[a:b])
                    vectors.append(flat[a:b])
                    continue
                if not ids:
                    continue
                if tree is None:
                    points = np.concatenate(vectors)
                    tree = Piece(np.concatenate(ids), points, points.astype(np.float64) @ basis)
                for r in range(a, b):
                    v = flat[r].astype(np.float64)
                    d, found = tree.nearest(own[r], v, v @ basis, k, reach, bound[r])
                    out[0] += [own[r]] * len(d)
                    out[1] += found.tolist()
                    out[2] += d.tolist()
                    out[3] += [mark[r]] * len(d)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64()),
                                              pa.array(out[3], pa.int64())], ["query_id", "vec_id", "score", "mark"])
    dealt = rows.repartition("piece").sortWithinPartitions("piece", "kind")
    return dealt.mapInArrow(answer, "query_id bigint, vec_id bigint, score double, mark bigint")


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int, str]:
    v = F.col("vector")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # single precision stays as it is; any other number is measured in double precision
    kind = vectors.schema[vector_col].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast(kind).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0))
    common = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    length = common["n"] if common else 1
    return rows.where(F.size(v) == length), length, kind


def neighbours(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding",
               dimensions: int = DIMENSIONS, confidence: float = CONFIDENCE, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``every``."""
    rows, length, kind = _valid(vectors, id_col, vector_col)
    reach = chi_square_quantile(confidence, dimensions)
    taken = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow()     # at most SAMPLE vectors
    sample = np.array(taken.column(0).to_pylist(), dtype=np.float64).reshape(-1, length) @ directions(length, dimensions)
    n = rows.count()
    blocks = min(MAX_BLOCKS, 1 << max(0, math.ceil(math.log2(max(1, n / piece_rows)))))
    low, high = cut_space(sample, blocks)

    def assign(batches):
        basis = directions(length, dimensions)
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, length).astype(np.float64) @ basis
            at = [int(np.flatnonzero(((low <= q) & (q < high)).all(axis=1))[0]) for q in flat]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at, pa.int32())], ["id", "vector", "block"])
    placed = staged(rows.mapInArrow(assign, f"id bigint, vector {kind}, block int"), "ann-placed")
    sizes = {r["block"]: r["count"] for r in placed.groupBy("block").count().collect()}       # at most MAX_BLOCKS numbers
    parts = np.array([max(1, -(-sizes.get(b, 0) // piece_rows)) for b in range(blocks)], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(parts)[:-1]])
    firsts, counts = F.lit(first.tolist()), F.lit(parts.tolist())
    home = F.get(firsts, F.col("block")) + F.pmod(F.xxhash64("id"), F.get(counts, F.col("block")))
    points = placed.select(home.cast("bigint").alias("piece"), F.lit(0).alias("kind"), "id", "vector", F.lit(0.0).alias("bound"),
                           F.lit(0).cast("bigint").alias("mark"))
    asked = placed.where(F.pmod("id", F.lit(every)) == 0).withColumn("mark", F.xxhash64("vector")).dropDuplicates(["id", "mark"])
    start = asked.select(home.cast("bigint").alias("piece"), F.lit(1).alias("kind"), "id", "vector", F.lit(float("inf")).alias("bound"), "mark")
    near = staged(_search(points.union(start), k, length, dimensions, reach), "ann-near")
    kth = near.groupBy(F.col("query_id").alias("k_id"), F.col("mark").alias("k_mark")).agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("worst"))
    asked = start.select("piece", "id", "vector", "mark").join(kth, (F.col("id") == F.col("k_id")) & (F.col("mark") == F.col("k_mark")), "left")
    asked = asked.select("piece", "id", "vector", F.when(F.col("n") >= k, F.col("worst")).otherwise(F.lit(float("inf"))).alias("bound"), "mark")

    def route(batches):
        basis = directions(length, dimensions)
        for batch in batches:
            done, bound = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 3))
            vectors_ = batch.column(2)
            flat = vectors_.flatten().to_numpy(zero_copy_only=False).reshape(-1, length).astype(np.float64) @ basis
            source, pieces = [], []
            for r, q in enumerate(flat):
                near_blocks = np.flatnonzero(box_distances(low, high, q) <= reach * bound[r] * bound[r])
                mine = [p for b in near_blocks for p in range(first[b], first[b] + parts[b]) if p != done[r]]
                source += [r] * len(mine)
                pieces += mine
            take = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(pieces, pa.int64()), pa.array(np.ones(len(pieces)), pa.int32()), batch.column(1).take(take),
                 vectors_.take(take), batch.column(3).take(take), batch.column(4).take(take)],
                ["piece", "kind", "id", "vector", "bound", "mark"])
    sent = asked.mapInArrow(route, POINTS.format(vector=kind))
    far = _search(points.union(sent), k, length, dimensions, reach)
    best = Window.partitionBy("query_id", "mark").orderBy("score", "vec_id")
    ranked = near.union(far).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
