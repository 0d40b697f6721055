"""Approximate and certified nearest-neighbour join over an inverted file.

A coarse quantiser, fitted on a bounded sample, puts every item into the cell of its nearest
centre. The index keeps items sorted by cell, and for every cell the widest and the mean angle
between its centre and its items. A query looks into cells in the order of their angles, first
into a share of them, and then, round by round, into as many more as its k-th distance asks for:

* Angles obey the triangle inequality, so no item of a cell is nearer than the angle to its
  centre less the widest angle. Once that exceeds the k-th angle for all cells not looked into,
  the result is certified to be exact.
* Sooner than that, the number of nearer items expected in those cells falls below a share
  ``miss`` of k. Seen from its centre, an item lies in any direction; in many dimensions most of
  them are nearly at right angles to the query, which gives the chance that it is near enough.

Rounds carry only the queries that want more cells. Queries are cut into blocks, each with a bit for
every cell that a query looks into, and cells are dealt into shares. A task holds one block and its
winners while the packed items of one share pass by, cell after cell; it emits winners, never pairs.
Neither a row nor a vector is made for a query and a cell. The distances, ties and errors are those of ``neighbors``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sievegate.operators.neighbors import (
    _LEAST_BLOCK,
    _TOGETHER_BYTES,
    TILE_QUERIES,
    _all_of,
    _frames,
    _local_schema,
    _matrix,
    _Nearest,
    _pack,
    _unit_queries,
    _unpacked,
    merge_winners,
)
from sievegate.session import cut_lineage

#: Items that the quantiser is fitted on, chosen by a hash of their id: a bound at any input size.
SAMPLE_ITEMS = 20_000
#: Cells grow with the root of the number of items, up to a share of the sample.
MOST_CELLS = SAMPLE_ITEMS // 4
_STEPS = 12
#: Share of all cells, and number of cells at least, that a query looks into first.
FIRST_SHARE, FIRST_LEAST = 0.1, 4
#: Share of the k nearest items that a search may expect to miss.
MISS = 0.1
_ANGLES = 1_000_000  # angles between queries and centres that a task holds at once
#: Items of one cell that stay together; a larger cell is dealt over shares.
TILE_ITEMS = 20_000
_BLOCK_BYTES = 32 << 20  # query vectors of one block
_SLACK = 1e-6  # angles that close count as equal, so rounding never certifies too early


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the rows that have a direction, and which rows these are."""
    if not np.isfinite(vectors).all():
        raise ValueError("non-finite value in a vector")
    lengths = np.linalg.norm(vectors, axis=1)
    kept = np.flatnonzero(lengths > 0)
    return vectors[kept] / lengths[kept, None], kept


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, rows):
            yield whole.slice(start, rows)


def _with(df: DataFrame, *more: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*df.schema.fields, *(T.StructField(name, kind) for name, kind in more)])


def fit_centres(sample: np.ndarray, cells: int, seed: int = 7) -> np.ndarray:
    """Unit centres of at most ``cells`` groups of directions (spherical k-means)."""
    unit, _ = _unit(sample)
    if not len(unit):
        return np.zeros((0, sample.shape[1]))
    rng = np.random.default_rng(seed)
    centres = unit[rng.permutation(len(unit))[:cells]]
    for _ in range(_STEPS):
        nearest = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, unit)
        lengths = np.linalg.norm(sums, axis=1)
        filled = lengths > 0
        centres = centres.copy()
        centres[filled] = sums[filled] / lengths[filled, None]
    return centres


@dataclass(frozen=True)
class Cells:
    """What a query must know to choose cells."""

    centres: np.ndarray
    radii: np.ndarray
    means: np.ndarray
    sizes: np.ndarray
    dim: int


@dataclass(frozen=True)
class InvertedFile:
    """Items by cell, and the cells."""

    cells: Cells
    items: DataFrame  # kept columns, _vector, _cell
    item_id: str
    kept: tuple[str, ...]


def build_index(
    items: DataFrame, dim: int, *, item_id: str = "chunk_id", item_vector: str = "embedding",
    carry: Sequence[str] = (), cells: int | None = None, seed: int = 7,
) -> InvertedFile:
    """Fits the quantiser, assigns every item to a cell and stores the items sorted by cell.

    Null and zero vectors have no direction and are left out. What comes to the driver is the
    sample and one row for each cell.
    """
    kept = tuple(dict.fromkeys([item_id, *carry]))
    rows = items.select(*kept, F.col(item_vector).alias("_vector"))
    known = rows.filter(F.col("_vector").isNotNull())
    if cells is None:
        cells = int(np.ceil(np.sqrt(max(1, known.count()))))
    sample = known.orderBy(F.xxhash64(F.col(item_id), F.lit(seed)), item_id).limit(SAMPLE_ITEMS)
    centres = fit_centres(_matrix(sample.select("_vector").toArrow().column(0), dim), min(cells, MOST_CELLS), seed)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, max(1, _ANGLES // max(1, len(centres)))):
            batch = batch.filter(batch.column("_vector").is_valid())
            unit, kept_rows = _unit(_matrix(batch.column("_vector"), dim))
            cosine = unit @ centres.T
            cell = cosine.argmax(axis=1) if len(centres) else np.zeros(len(unit), np.int64)
            angle = np.arccos(np.clip(np.take_along_axis(cosine, cell[:, None], 1)[:, 0], -1, 1))
            taken = batch.take(pa.array(kept_rows))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(cell, pa.int32()), pa.array(angle, pa.float64())],
                names=[*taken.schema.names, "_cell", "_angle"],
            )

    layout = _with(rows, ("_cell", T.IntegerType()), ("_angle", T.DoubleType()))
    placed = rows.mapInArrow(assign, layout).repartitionByRange("_cell", item_id).sortWithinPartitions("_cell")
    placed = cut_lineage(placed)
    radii, means, sizes = np.zeros(len(centres)), np.zeros(len(centres)), np.zeros(len(centres), np.int64)
    each = (F.max("_angle").alias("r"), F.avg("_angle").alias("m"), F.count(F.lit(1)).alias("n"))
    for row in placed.groupBy("_cell").agg(*each).collect():
        radii[row["_cell"]], means[row["_cell"]], sizes[row["_cell"]] = row["r"], row["m"], row["n"]
    return InvertedFile(Cells(centres, radii, means, sizes, dim), placed.drop("_angle"), item_id, kept)


def first_cells(index: InvertedFile, share: float, least: int) -> int:
    n = len(index.cells.centres)
    return min(n, max(least, int(np.ceil(share * n))))


def _together(cells: Cells) -> int:
    """Queries compared with all centres at once."""
    return max(1, _ANGLES // max(1, len(cells.centres)))


def _in_order(cells: Cells, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query all cells in the order of looking, and their angles in that order."""
    angle = np.arccos(np.clip(vectors @ cells.centres.T, -1, 1))
    order = np.argsort(angle, axis=1, kind="stable")
    return order, np.take_along_axis(angle, order, 1)


def _may_hold(cells: Cells, order: np.ndarray, angle: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Cells that may hold an item as near as ``reach``."""
    return (cells.sizes[order] > 0) & (angle - cells.radii[order] <= reach[:, None] + _SLACK)


def _expected(cells: Cells, order: np.ndarray, angle: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Number of items nearer than ``reach`` to expect in each cell."""
    mean = cells.means[order]
    across = np.maximum(np.sin(angle) * np.sin(mean), 1e-9)
    x = (np.cos(np.minimum(reach, np.pi))[:, None] - np.cos(angle) * np.cos(mean)) / across * np.sqrt(max(1, cells.dim - 1))
    # the tail of the normal distribution, to within a few hundredths of itself
    far = np.minimum(np.abs(x), 30.0)
    tail = 0.5 * np.exp(-0.717 * far - 0.416 * far * far)
    chance = np.where(x >= 0, tail, 1 - tail)
    return cells.sizes[order] * chance * _may_hold(cells, order, angle, reach)


def _plan(queries: DataFrame, cells: Cells, wanted: float) -> DataFrame:
    """``queries`` with ``_next``: cells to have looked into after the next round.

    Enough that fewer than ``wanted`` items are expected beyond them; with 0, that none may be there.
    Queries have ``_query, _vector, _seen`` and ``_reach``, the angle of the k-th item found (null
    while there are fewer).
    """

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _together(cells)):
                batch = whole.slice(start, _together(cells))
                unit, kept = _unit(_matrix(batch.column("_vector"), cells.dim))
                batch = batch.take(pa.array(kept))
                order, angle = _in_order(cells, unit)
                reach = batch.column("_reach").fill_null(np.inf).to_numpy()
                left = _expected(cells, order, angle, reach) if wanted else _may_hold(cells, order, angle, reach)
                beyond = np.cumsum(left[:, ::-1], axis=1)[:, ::-1]
                more = (beyond > wanted).sum(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(more, pa.int32())], names=[*batch.schema.names, "_next"])

    return queries.mapInArrow(plan, _with(queries, ("_next", T.IntegerType())))


def _choices(batch: pa.RecordBatch, cells: Cells) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Queries with a direction, some at a time, and the cells each looks into: those from ``_seen`` to ``_next``
    that may hold something nearer."""
    step = _together(cells)
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        unit, kept = _unit(_matrix(part.column("_vector"), cells.dim))
        part = part.take(pa.array(kept))
        order, angle = _in_order(cells, unit)
        place = np.arange(order.shape[1])
        low, high = (part.column(c).to_numpy()[:, None] for c in ("_seen", "_next"))
        reach = part.column("_reach").fill_null(np.inf).to_numpy()
        wanted = np.zeros(order.shape, bool)
        np.put_along_axis(wanted, order, (place >= low) & (place < high) & _may_hold(cells, order, angle, reach), 1)
        yield part, wanted


def _probes(queries: DataFrame, cells: Cells) -> DataFrame:
    """``_cell`` once for every query that looks into it."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, wanted in _choices(batch, cells):
                yield pa.RecordBatch.from_arrays([pa.array(np.nonzero(wanted)[1], pa.int32())], names=["_cell"])

    return queries.select("_vector", "_seen", "_next", "_reach").mapInArrow(choose, "_cell int")


def _wanted(queries: DataFrame, cells: Cells) -> DataFrame:
    """Queries with ``_want``: a bit for each cell to look into."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, wanted in _choices(batch, cells):
                bits = [row.tobytes() for row in np.packbits(wanted, axis=1, bitorder="little")]
                columns = [part.column("_query"), part.column("_vector"), pa.array(bits, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["_query", "_vector", "_want"])

    layout = _with(queries.select("_query", "_vector"), ("_want", T.BinaryType()))
    return queries.select("_query", "_vector", "_seen", "_next", "_reach").mapInArrow(choose, layout)


def _grid(n_queries: int, dim: int, tasks: int, tile_queries: int) -> tuple[int, int]:
    """Blocks of queries and shares of cells.

    Items pass once for each block and queries once for each share, so both are about the root of the
    number of tasks until blocks reach their bound.
    """
    most = max(1, min(tile_queries, _BLOCK_BYTES // (8 * dim)))
    side = int(np.ceil(np.sqrt(tasks)))
    blocks = max(1, -(-n_queries // most), min(side, -(-n_queries // _LEAST_BLOCK)))
    return blocks, max(1, -(-tasks // blocks))


def _dealt(probes: DataFrame, cells: Cells, shares: int, tile_items: int) -> list[tuple[int, int, int, int]]:
    """(cell, its tiles, tile, share) of the cells that queries look into, the heaviest dealt first."""
    work = []
    for row in probes.groupBy("_cell").count().collect():  # one row for each cell
        tiles = int(-(-cells.sizes[row["_cell"]] // tile_items))
        work += [(row["count"] * int(cells.sizes[row["_cell"]]) / tiles, row["_cell"], tiles, tile) for tile in range(tiles)]
    heap, out = [(0.0, share) for share in range(shares)], []
    for load, cell, tiles, tile in sorted(work, reverse=True):
        busy, share = heappop(heap)
        heappush(heap, (busy + load, share))
        out.append((cell, tiles, tile, share))
    return out


def _look(
    probes: DataFrame, index: InvertedFile, queries: DataFrame, layout, k: int, tile_queries: int, tile_items: int
) -> DataFrame:
    """Winners of every query in the cells it wants, at most k for each query and share.

    ``probes`` decide how cells are dealt: shares get about the same number of pairs.
    """
    cells, kept, spark = index.cells, list(index.kept), queries.sparkSession
    dim = cells.dim
    blocks, shares = _grid(queries.count(), dim, 4 * spark.sparkContext.defaultParallelism, tile_queries)
    dealt = spark.createDataFrame(
        _dealt(probes, cells, shares, tile_items), "_cell int, _tiles int, _tile int, _share int"
    )
    tiles = dealt.select("_cell", "_tiles").distinct()
    items = index.items.join(F.broadcast(tiles), "_cell")
    items = items.withColumn("_tile", F.pmod(F.xxhash64(index.item_id), F.col("_tiles")).cast("int")).drop("_tiles")
    items = items.join(F.broadcast(dealt.drop("_tiles")), ["_cell", "_tile"])
    left = _pack(_wanted(queries, cells), ["_query", "_want"], F.pmod(F.xxhash64("_query"), F.lit(blocks)), dim, None)
    right = _pack(items, kept, F.col("_share"), dim, "_cell")
    left = left.select(F.col("_at").alias("_block"), _all_of(shares).alias("_share"), F.lit(0).alias("_side"), "rows", "matrix")
    right = right.select(
        _all_of(blocks).alias("_block"), F.col("_at").alias("_share"), F.lit(1).alias("_side"), "rows", "matrix", "_group"
    )
    met = left.unionByName(right, allowMissingColumns=True)
    met = met.withColumn("_at", F.col("_block") * shares + F.col("_share")).drop("_block", "_share")
    met = met.repartitionById(blocks * shares, F.col("_at"))
    arrow_layout = to_arrow_schema(layout)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parts, best, bits, waiting, size, cell = None, [], None, None, [], 0, None

        def take() -> None:
            if waiting:
                asked = np.flatnonzero(bits[:, cell >> 3] >> (cell & 7) & 1)
                if len(asked):
                    matrix = np.concatenate([m for _, m in waiting]).astype(np.float64)
                    best.add(matrix, pa.concat_tables([r for r, _ in waiting]).to_pandas(), kept[0], asked)
                waiting.clear()

        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                if row["_at"] != here:
                    if best is not None:
                        take()
                        yield from _frames(best.winners(), arrow_layout)
                    here, parts, best, size = row["_at"], [], None, 0
                if row["_side"] == 0:
                    parts.append(_unpacked(row, dim))
                    continue
                if best is None:
                    if not parts:
                        continue
                    asked = pa.concat_tables([r for r, _ in parts])
                    matrix = np.concatenate([m for _, m in parts]).astype(np.float64)
                    parts = [None]
                    best = _Nearest(*_unit_queries(asked.column("_query").to_pandas().to_numpy(), matrix), k)
                    bits = np.frombuffer(b"".join(asked.column("_want").to_pylist()), np.uint8).reshape(len(best.ids), -1)
                    del asked, matrix
                if row["_group"] != cell or size >= _TOGETHER_BYTES:
                    take()
                    cell, size = row["_group"], 0
                waiting.append(_unpacked(row, dim))
                size += waiting[-1][1].nbytes
        if best is not None:
            take()
            yield from _frames(best.winners(), arrow_layout)

    return met.sortWithinPartitions("_at", "_side", "_group").mapInArrow(meet, layout)


def search_index(
    queries: DataFrame, index: InvertedFile, k: int, *, query_id: str = "qid", query_vector: str = "vector",
    miss: float = MISS, rounds: int | None = None, share: float = FIRST_SHARE, least: int = FIRST_LEAST,
    tile_queries: int = TILE_QUERIES, tile_items: int = TILE_ITEMS,
) -> DataFrame:
    """``query_id, item_id, carry..., distance, rank, certified`` with the k nearest items found per query.

    With ``miss=0`` a query goes on until its result is certified, which gives the result of the
    exact join; ``rounds`` ends a search early. Queries whose vector is null or zero have no
    neighbours; a query with fewer than k items looks into all cells, if rounds allow.
    """
    cells, first = index.cells, first_cells(index, share, least)
    layout = _local_schema(queries.withColumnRenamed(query_id, "_query"), index.items, "_query", list(index.kept))
    asked = queries.select(F.col(query_id).alias("_query"), F.col(query_vector).alias("_vector"))
    asked = asked.filter(F.col("_vector").isNotNull())
    state = asked.select(
        "*", F.lit(0).alias("_seen"), F.lit(None).cast("double").alias("_reach"), F.lit(first).alias("_next")
    )
    found, done, turn = None, None, 0
    while True:
        won = _look(_probes(state, cells), index, state, layout, k, tile_queries, tile_items)
        if found is not None:
            won = won.unionByName(found)
        best = merge_winners(won, "_query", index.item_id, None, k)
        # as local winners again, for the next round
        units = F.round(F.col("distance") * 1e9).cast("long").alias("_units")
        found = cut_lineage(best.select(*index.kept, "_query", units))
        reach = found.groupBy("_query").agg(F.count(F.lit(1)).alias("_n"), F.max("_units").alias("_far"))
        angle = F.when(F.col("_n") >= k, F.acos(F.greatest(F.lit(-1.0), 1 - F.col("_far") / 1e9)))
        seen = state.select("_query", "_vector", F.col("_next").alias("_seen")).join(reach, "_query", "left")
        state = cut_lineage(_plan(seen.select("_query", "_vector", "_seen", angle.alias("_reach")), cells, miss * k))
        turn += 1
        over = state.filter(F.col("_next") <= F.col("_seen")) if turn != rounds else state
        done = over.drop("_next") if done is None else done.unionByName(over.drop("_next"))
        state = state.filter(F.col("_next") > F.col("_seen"))
        if turn == rounds or state.isEmpty():
            break
    sure = _plan(done, cells, 0).select(F.col("_query").alias(query_id), (F.col("_next") <= F.col("_seen")).alias("certified"))
    return merge_winners(found, query_id, index.item_id, None, k).join(sure, query_id)


def approximate_items(
    queries: DataFrame, items: DataFrame, k: int, dim: int, *, query_id: str = "qid", query_vector: str = "vector",
    item_id: str = "chunk_id", item_vector: str = "embedding", carry: Sequence[str] = (), miss: float = MISS,
    rounds: int | None = None, share: float = FIRST_SHARE, least: int = FIRST_LEAST, cells: int | None = None, seed: int = 7,
    tile_queries: int = TILE_QUERIES, tile_items: int = TILE_ITEMS,
) -> DataFrame:
    """Builds an index of the items and searches it; see ``build_index`` and ``search_index``."""
    index = build_index(
        items, dim, item_id=item_id, item_vector=item_vector, carry=carry, cells=cells, seed=seed
    )
    return search_index(
        queries, index, k, query_id=query_id, query_vector=query_vector, miss=miss, rounds=rounds, share=share, least=least,
        tile_queries=tile_queries, tile_items=tile_items,
    )


def recall_against(
    found: DataFrame, exact: DataFrame, query_id: str = "qid", item_id: str = "chunk_id"
) -> DataFrame:
    """Share of the exact neighbours that were found, per query."""
    hits = found.select(query_id, item_id, F.lit(1).alias("_hit"))
    return (
        exact.join(hits, [query_id, item_id], "left")
        .groupBy(query_id)
        .agg((F.count("_hit") / F.count(F.lit(1))).alias("recall"))
    )
