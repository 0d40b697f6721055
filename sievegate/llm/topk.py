"""Exact top-k search by inner product, with norm-sorted vectors and residual bounds."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievegate.llm.shared import stored

SCALE, TOP, QUERY_STEP = 64, 20, 20
#: Vectors of a tile of candidates and of a block of queries; both meet in one task.
TILE_VECTORS, BLOCK_QUERIES = 8_192, 1_024
#: Longest vectors, sent to every task as a first bound; vectors that the rotation is fitted on.
HEAD_VECTORS, ROTATION_SAMPLE = 2_048, 8_192
#: Candidates scored at a time, in order of falling length.
STEP = 512
#: Share of the dimensions in a partial sum.
PARTIAL = 0.25
_EXACT = float(1 << 53)


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``dim`` and ``v`` (floor of scale times each component) of vectors without gaps."""
    x = F.transform(F.col(vector_column), lambda c: c.cast("double"))
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), x.alias("x"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite))
    return rows.select("vec_id", F.size("x").alias("dim"), F.transform("x", lambda c: F.floor(scale * c)).alias("v"))


def _matrix(lists: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dim)


def _products(queries: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Integer inner products; floating point where every partial sum is exact there."""
    if not queries.size or not others.size:
        return np.zeros((len(queries), len(others)), np.int64)
    reach = float(np.abs(queries).max()) * float(np.abs(others).max()) * queries.shape[1]
    if reach < _EXACT:
        return (queries.astype(np.float64) @ others.T.astype(np.float64)).astype(np.int64)
    exact = queries.astype(object) @ others.T.astype(object)
    return exact.astype(np.int64)  # raises where a score is no 64-bit integer


def _singular_vectors(rows: np.ndarray) -> np.ndarray:
    """Right singular vectors as columns, by falling singular value."""
    scaled = rows / max(1.0, np.abs(rows).max(initial=0))
    return np.linalg.eigh(scaled.T @ scaled)[1][:, ::-1]


class _Best:
    """The k best (score, id) of every query so far."""

    def __init__(self, queries: int, k: int):
        self.scores = np.full((queries, k), np.iinfo(np.int64).min)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)
        self.filled = np.zeros((queries, k), bool)

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray, valid: np.ndarray) -> None:
        """Merges candidates (one row per query of ``at``); ties go to the smaller id."""
        k = self.scores.shape[1]
        s = np.concatenate([self.scores[at], np.where(valid, scores, np.iinfo(np.int64).min)], axis=1)
        i = np.concatenate([self.ids[at], np.broadcast_to(ids, scores.shape)], axis=1)
        f = np.concatenate([self.filled[at], valid], axis=1)
        order = np.lexsort((i, ~s, ~f), axis=1)[:, :k]
        self.scores[at] = np.take_along_axis(s, order, 1)
        self.ids[at] = np.take_along_axis(i, order, 1)
        self.filled[at] = np.take_along_axis(f, order, 1)

    def bound(self) -> np.ndarray:
        """Score a further candidate must at least have; minus infinity while there is room."""
        return np.where(self.filled[:, -1], self.scores[:, -1].astype(np.float64), -np.inf)


def search_tile(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
    rotation: np.ndarray, floor: np.ndarray, k: int,
) -> _Best:
    """The best of a tile for every query, leaving out those below the query's ``floor``.

    Vectors come by falling length. A query is done when its length times that of the next vector
    is below its bound. Of the rest, the partial inner product over the leading rotated dimensions
    plus the product of the residual lengths bounds the score from above (Cauchy-Schwarz); only
    candidates that reach the bound are scored exactly. Bounds have a slack for rounding.
    """
    best = _Best(len(queries), k)
    q, v = queries.astype(np.float64), vectors.astype(np.float64)
    order = np.lexsort((ids, -np.linalg.norm(v, axis=1)))
    ids, vectors, v = ids[order], vectors[order], v[order]
    lengths, q_lengths = np.linalg.norm(v, axis=1), np.linalg.norm(q, axis=1)
    lead = max(1, int(PARTIAL * rotation.shape[0])) if rotation.size else 0
    q_rotated, v_rotated = q @ rotation[:, :lead], v @ rotation[:, :lead]
    q_rest = np.sqrt(np.maximum(0, q_lengths**2 - (q_rotated**2).sum(axis=1)))
    v_rest = np.sqrt(np.maximum(0, lengths**2 - (v_rotated**2).sum(axis=1)))
    slack = 1e-6 * (1 + q_lengths * (lengths[0] if len(lengths) else 0))
    for first in range(0, len(ids), STEP):
        part = slice(first, first + STEP)
        bound = np.maximum(best.bound(), floor) - slack
        live = np.flatnonzero(q_lengths * lengths[first] >= bound)
        if not len(live):
            break
        upper = q_rotated[live] @ v_rotated[part].T + q_rest[live, None] * v_rest[None, part]
        reach = (upper >= bound[live, None]) & (query_ids[live, None] != ids[None, part])
        some, columns = reach.any(axis=1), np.flatnonzero(reach.any(axis=0))
        if len(columns):
            rows = live[some]
            scores = _products(queries[rows], vectors[part][columns])
            best.add(rows, scores, ids[part][columns], reach[some][:, columns])
    return best


def exact_top_k(
    vectors: DataFrame, queries: Column | None = None, k: int = TOP, scale: int = SCALE,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """The ``k`` highest integer inner products of every query over all rows but its own.

    Vectors are cut into tiles, queries into blocks; every block meets every tile of its dimension
    in a task of its own, and the winners of a query's tiles are merged. The longest vectors (a
    bounded head) give every task a lower bound of each query's k-th score, and a rotation from the
    singular vectors of a bounded sample gathers most of the length in few dimensions; both only
    save work. ``queries`` chooses the query rows (ids divisible by 20 by default).

    Vectors that are null or hold null or non-finite components take no part, nor do rows without
    an id. Vectors of different dimension do not meet. Rows that repeat an id are candidates each
    for themselves, and no query meets a row with its own id; a repeated query id is asked once,
    with its first row by content. Ties go to the smaller id. A score beyond 64 bits raises. An
    empty table gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = stored(whole_vectors(vectors, id_column, vector_column, scale), "vectors")
    wanted = F.col("vec_id") % QUERY_STEP == 0 if queries is None else queries
    square = F.aggregate("v", F.lit(0.0), lambda t, c: t + c.cast("double") * c)
    counts = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}
    rotations: dict[int, np.ndarray] = {}
    heads: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in sorted(d for d in counts if d):
        same = rows.filter(F.col("dim") == dim)
        sample = same.orderBy(F.xxhash64("vec_id"), "vec_id").limit(ROTATION_SAMPLE).toArrow()
        rotations[dim] = _singular_vectors(_matrix(sample.column("v"), dim).astype(np.float64))
        head = same.orderBy(square.desc(), "vec_id").limit(HEAD_VECTORS).toArrow()
        heads[dim] = head.column("vec_id").to_numpy(), _matrix(head.column("v"), dim)
    shared = spark.sparkContext.broadcast((rotations, heads))

    tile_count = F.lit(1)  # of the row's dimension
    for dim, n in counts.items():
        tile_count = F.when(F.col("dim") == dim, F.lit(-(-n // TILE_VECTORS))).otherwise(tile_count)
    asked = rows.filter(wanted).groupBy("vec_id", "dim").agg(F.min("v").alias("v"))
    asked = asked.groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("r")).select("vec_id", "r.*")
    asked = stored(asked, "queries")
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    tile = F.pmod(F.xxhash64("vec_id", "v"), tile_count).cast("int")
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    every_tile = F.explode(F.sequence(F.lit(0), (tile_count - 1).cast("int")))
    left = asked.select("*", block.alias("block"), every_tile.alias("tile"))
    right = rows.select("*", tile.alias("tile"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    keys = ["dim", "tile", "block"]

    def meet(asking: pa.Table, candidates: pa.Table) -> pa.Table:
        empty = pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score")})
        if not asking.num_rows or not candidates.num_rows:
            return empty
        dim = asking.column("dim")[0].as_py()
        query_ids, q = asking.column("vec_id").to_numpy(), _matrix(asking.column("v"), dim)
        ids, v = candidates.column("vec_id").to_numpy(), _matrix(candidates.column("v"), dim)
        all_rotations, all_heads = shared.value
        floor = np.full(len(q), -np.inf)
        if dim and len(all_heads[dim][0]) > k:
            head_ids, head = all_heads[dim]
            scores = _products(q, head).astype(np.float64)
            scores[query_ids[:, None] == head_ids[None, :]] = -np.inf
            floor = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        best = search_tile(query_ids, q, ids, v, all_rotations.get(dim, np.zeros((0, 0))), floor, k)
        at = np.nonzero(best.filled)
        columns = {"query_id": query_ids[at[0]], "vec_id": best.ids[at], "score": best.scores[at]}
        return pa.table({name: pa.array(values) for name, values in columns.items()})

    schema = "query_id long, vec_id long, score long"
    winners = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = winners.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
