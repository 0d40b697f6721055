"""Nearest-neighbour joins: queries x items by cosine distance, k items per query.

Distances are computed as matrix products inside Arrow batches and only the k best per
query leave a task. How the queries reach the items depends on their measured size:

* a query side that fits the byte limit is broadcast, and the items are never shuffled;
* beyond it the queries are cut into blocks. Items are packed into rows of some hundred kilobytes,
  and a task holds one block and the running winners while a share of the packed items streams by.
  Several blocks read the same stored items, so what is stored grows with the tables and not with
  their product; only items in groups are sent once for every block.

Both ways are exact. Distances are compared at nine decimals and ties go to the smaller
item id, so the result does not depend on batch or partition boundaries. Null and
zero-length vectors have no distance and are left out; a vector with a non-finite value on
either side is an error.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sievegate.operators.ranking import top_k_per_group
from sievegate.session import cut_lineage

BROADCAST_BYTES = 8 << 20
#: Bounds of the queries and items of one matrix product.
TILE_QUERIES = 50_000
TILE_ITEMS = 200_000
_UNITS = 10**9  # distances are ranked as integers of this resolution
_MATRIX_CELLS = 4_000_000
_FREE = 4 * _UNITS  # farther than any item
_STATE_BYTES = 64 << 20  # places of the running winners in one task, which holds one group at a time
_TOGETHER_BYTES = 8 << 20  # items that are ranked together
_PACKED_BYTES = 256 << 10  # vectors in a packed row
_STREAM_BYTES = 1 << 20  # the same where a row meets every block, which costs a copy of the packed block
_BLOCK_BYTES = 32 << 20  # query vectors of one block
_BLOCK_QUERIES = 16_384  # queries of one block
_STREAM_QUERIES = 8_192  # the same where blocks read stored items, so that smaller ones send no more
_SHARE_ITEMS = 1_000_000  # items that stream by one block in one task
# Queries of a block and items of a share at least, where they are cut for the sake of more tasks.
_LEAST_BLOCK, _LEAST_SHARE = 2_000, 100_000
_ROW_BYTES, _WINNER_BYTES = 100, 400  # beside a vector; what sorting a winner costs, in bytes of packed rows
_EMIT_ROWS = 50_000
_DENSE = 16  # one cell in so many may be a candidate before all cells are ranked


def _unit_queries(ids: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and unit vectors of the queries that have a direction."""
    if not np.isfinite(matrix).all():
        raise ValueError("non-finite value in a query vector")
    lengths = np.linalg.norm(matrix, axis=1)
    usable = lengths > 0
    return ids[usable], matrix[usable] / lengths[usable, None]


class _Nearest:
    """Running k nearest items per query of one task (and of one group, where items have groups).

    A dense array of k places per query, so a task hands on at most k rows per query and group,
    once, whatever the number of items it has seen.

    Products in single precision leave out the pairs that are farther than the k-th item by more than
    their error bound; what is left is measured in double precision.
    """

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int, tile: tuple[int, int] = (TILE_QUERIES, TILE_ITEMS)):
        self.ids, self.matrix, self.k, self.tile = ids, matrix, k, tile
        self._single = matrix.astype(np.float32)
        shape = (len(matrix), k)
        # distances in units and rows of ``payload``, _FREE where a place is free
        self.units, self.refs = np.full(shape, _FREE, np.int64), np.zeros(shape, np.int32)
        self.payload: pd.DataFrame | None = None

    def add(self, vectors: np.ndarray, items: pd.DataFrame, item_id: str, asked: np.ndarray | None = None) -> None:
        """Items for all queries, or for those at the ascending places ``asked``."""
        if not np.isfinite(vectors).all():
            raise ValueError("non-finite value in an item vector")
        lengths = np.linalg.norm(vectors, axis=1)
        keep = np.flatnonzero(lengths > 0)
        if not len(keep):
            return
        unit = vectors[keep] / lengths[keep, None]
        items = items.iloc[keep]
        before = 0 if self.payload is None else len(self.payload)
        self.payload = items if self.payload is None else pd.concat([self.payload, items])
        self.payload = self.payload.reset_index(drop=True)
        # ties go to the smaller id: its rank among the ids at hand
        rank = pc.rank(pa.array(self.payload[item_id]), tiebreaker="dense").to_numpy().astype(np.int64)
        single = unit.astype(np.float32)
        wide = max(1, min(len(unit), self.tile[1], _MATRIX_CELLS))
        step = max(1, min(self.tile[0], _MATRIX_CELLS // wide))
        asked = np.arange(len(self.matrix)) if asked is None else asked
        for first in range(0, len(unit), wide):
            some = slice(first, first + wide)
            for start in range(0, len(asked), step):
                self._meet(asked[start : start + step], unit[some], single[some], before + first, rank)
        self._forget()

    def _meet(self, part: np.ndarray, unit: np.ndarray, single: np.ndarray, before: int, rank: np.ndarray) -> None:
        """Ranks the items from row ``before`` on for the queries of ``part``."""
        error = (unit.shape[1] + 16) * 1.2e-7  # of a product of unit vectors in single precision
        cosine = self._single[part] @ single.T
        far = self.units[part].max(axis=1)
        floor = 1.0 - far / _UNITS - error - 2e-9
        if (far == _FREE).any() and len(unit) > self.k:
            at_least = np.partition(cosine, len(unit) - self.k, axis=1)[:, len(unit) - self.k]
            floor = np.maximum(floor, at_least - 2 * error - 2e-9)
        near = cosine >= np.nextafter(floor.astype(np.float32), np.float32(-9))[:, None]
        count = np.count_nonzero(near)
        if count * _DENSE > near.size:
            self._rank_all(part, unit, before, rank)
        elif count:
            query, item = np.divmod(np.flatnonzero(near), near.shape[1])
            del near, cosine
            self._rank_some(part, unit, before, rank, query, item)

    def _rank_all(self, part: np.ndarray, unit: np.ndarray, before: int, rank: np.ndarray) -> None:
        spread = int(rank.max()) + 1
        rows = before + np.arange(len(unit))
        # a product as dense as this needs 64 bits and a sort place for each cell: fewer queries at a time
        step = max(1, _MATRIX_CELLS // 4 // (len(unit) + self.k))
        for low in range(0, len(part), step):
            few = part[low : low + step]
            distance = np.rint((1.0 - self.matrix[few] @ unit.T) * _UNITS).astype(np.int64)
            all_units = np.concatenate([self.units[few], distance], axis=1)
            key = all_units * spread + np.concatenate(
                [rank[self.refs[few]], np.broadcast_to(rank[rows], distance.shape)], axis=1
            )
            order = np.argpartition(key, self.k - 1, axis=1)[:, : self.k]
            mine = np.take_along_axis(self.refs[few], np.minimum(order, self.k - 1), axis=1)
            self.units[few] = np.take_along_axis(all_units, order, axis=1)
            self.refs[few] = np.where(order < self.k, mine, before + order - self.k)

    def _rank_some(
        self, part: np.ndarray, unit: np.ndarray, before: int, rank: np.ndarray, query: np.ndarray, item: np.ndarray
    ) -> None:
        query = part[query]
        units = np.empty(len(query), np.int64)
        step = max(1, _MATRIX_CELLS // 8 // unit.shape[1])
        for start in range(0, len(query), step):
            few = slice(start, start + step)
            product = np.einsum("ij,ij->i", self.matrix[query[few]], unit[item[few]])
            units[few] = np.rint((1.0 - product) * _UNITS)
        item = item + before
        worst = self.units.max(axis=1)[query] if len(query) > len(self.units) else self.units[query].max(axis=1)
        better = units <= worst
        query, units, item = query[better], units[better], item[better]
        if not len(query):
            return
        asked = np.unique(query)
        step = max(1, _MATRIX_CELLS // 8 // self.k)
        for start in range(0, len(asked), step):
            few = asked[start : start + step]
            low, high = np.searchsorted(query, few[0]), np.searchsorted(query, few[-1], side="right")
            owner = np.concatenate([np.repeat(few, self.k), query[low:high]])
            all_units = np.concatenate([self.units[few].ravel(), units[low:high]])
            all_refs = np.concatenate([self.refs[few].ravel(), item[low:high].astype(np.int32)])
            order = np.lexsort((rank[all_refs], all_units, owner))
            begin = np.searchsorted(owner[order], few)
            order = order[(begin[:, None] + np.arange(self.k))]
            self.units[few], self.refs[few] = all_units[order], all_refs[order]

    def _forget(self) -> None:
        """Drops the payload of items that no place refers to."""
        used = np.zeros(len(self.payload), bool)
        used[self.refs[self.units != _FREE]] = True
        place = np.cumsum(used, dtype=np.int32) - 1
        self.payload = self.payload.take(np.flatnonzero(used)).reset_index(drop=True)
        self.refs = np.where(self.units == _FREE, 0, place[self.refs]).astype(np.int32)

    def winners(self) -> Iterator[pd.DataFrame]:
        step = max(1, _EMIT_ROWS // self.k)
        for start in range(0, len(self.units), step):
            units, refs = self.units[start : start + step], self.refs[start : start + step]
            query, place = np.nonzero(units != _FREE)
            if len(query):
                out = self.payload.take(refs[query, place]).reset_index(drop=True)
                yield out.assign(_query=self.ids[start + query], _units=units[query, place])


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) != len(column) * dim:
        raise ValueError(f"vectors are not all {dim} wide")
    return flat.reshape(len(column), dim)


def _local_schema(queries: DataFrame, items: DataFrame, query_id: str, kept: list[str]) -> T.StructType:
    return T.StructType(
        [
            *[items.schema[c] for c in kept],
            T.StructField("_query", queries.schema[query_id].dataType),
            T.StructField("_units", T.LongType()),
        ]
    )


def _frames(frames: Iterator[pd.DataFrame], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        yield pa.RecordBatch.from_pandas(frame[schema.names], schema=schema, preserve_index=False)


def _gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Batches of some size without the rows that have no vector."""
    waiting, size = [], 0
    for whole in batches:
        whole = whole.filter(whole.column("_vector").is_valid())
        rows = max(1, int(most * whole.num_rows / max(1, whole.nbytes)))
        for start in range(0, whole.num_rows, rows):
            waiting.append(whole.slice(start, rows))
            size += waiting[-1].nbytes
            if size >= most:
                yield pa.Table.from_batches(waiting)
                waiting, size = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def _broadcast_join(
    queries: pa.Table, items: DataFrame, layout: T.StructType, kept: list[str], dim: int, k: int,
    group: str | None, tile: tuple[int, int],
) -> DataFrame:
    queries = queries.filter(queries.column(1).is_valid())
    ids, vectors = queries.column(0).to_pandas().to_numpy(), _matrix(queries.column(1), dim)
    shared = items.sparkSession.sparkContext.broadcast(_unit_queries(ids, vectors))
    arrow_layout = to_arrow_schema(layout)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, current = None, None
        for table in _gathered(batches, _TOGETHER_BYTES):
            rows, matrix = table.select(kept).to_pandas(), _matrix(table.column("_vector"), dim)
            # items come sorted by group: a group's state goes as soon as the next one begins
            for name, start, stop in _stretches(rows, group):
                if best is None or name != current:
                    if best is not None:
                        yield from _frames(best.winners(), arrow_layout)
                    best, current = _Nearest(*shared.value, k, tile), name
                best.add(matrix[start:stop], rows.iloc[start:stop], kept[0])
        if best is not None:
            yield from _frames(best.winners(), arrow_layout)

    if group is not None:
        items = items.sortWithinPartitions(group)
    return items.mapInArrow(scan, layout)


def _stretches(rows: pd.DataFrame, group: str | None) -> Iterator[tuple[object, int, int]]:
    """(group, start, stop) of consecutive rows of the same group."""
    if group is None:
        yield None, 0, len(rows)
        return
    names = rows[group].to_numpy()
    edges = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
    for start, stop in zip(edges[:-1], edges[1:], strict=True):
        yield names[start], start, stop


def _packed_schema(group: T.DataType | None) -> T.StructType:
    fields = [("_at", T.IntegerType()), ("rows", T.BinaryType()), ("matrix", T.BinaryType())]
    return T.StructType([T.StructField(*f) for f in fields] + ([T.StructField("_group", group)] if group else []))


def _packed(rows: pa.Table, matrix: np.ndarray) -> tuple[bytes, bytes]:
    """Columns and vectors of some rows, compressed."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(rows)
    data = matrix.tobytes()
    return sink.getvalue().to_pybytes(), len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _pack(
    df: DataFrame, kept: list[str], at: Column, dim: int, group: str | None, most: int = _PACKED_BYTES
) -> DataFrame:
    """Rows of one ``_at`` (and one group) together as one packed row each of bounded size.

    Vectors keep every bit: in single precision where that loses nothing.
    """
    kind = df.schema[group].dataType if group else None
    layout = _packed_schema(kind)
    schema = to_arrow_schema(layout)
    cap = max(1, most // (4 * dim))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches, _TOGETHER_BYTES):
            matrix = _matrix(table.column("_vector"), dim)
            if not np.isfinite(matrix).all():
                raise ValueError("non-finite value in a vector")
            with np.errstate(over="ignore"):
                small = matrix.astype(np.float32)
            if (small == matrix).all():
                matrix = small
            place = table.column("_at").to_numpy()
            names = pc.rank(table.column(group).combine_chunks(), tiebreaker="dense").to_numpy() if group else np.zeros(len(place))
            order = np.lexsort((names, place))
            place, names = place[order], names[order]
            edges = [0, *(np.flatnonzero((place[1:] != place[:-1]) | (names[1:] != names[:-1])) + 1).tolist(), len(order)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                for start in range(low, high, cap):
                    some = order[start : min(start + cap, high)]
                    rows = table.select(kept).take(pa.array(some)).combine_chunks()
                    columns = [[place[start]], *([x] for x in _packed(rows, matrix[some]))]
                    if group:
                        columns.append([table.column(group)[int(some[0])].as_py()])
                    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return df.select("*", at.cast("int").alias("_at")).mapInArrow(pack, layout)


def _unpacked(row: dict, dim: int) -> tuple[pa.Table, np.ndarray]:
    rows = pa.ipc.open_stream(row["rows"]).read_all()
    size = int.from_bytes(row["matrix"][:8], "little")
    kind = np.float32 if size == 4 * dim * len(rows) else np.float64
    data = pa.decompress(row["matrix"][8:], size, "zstd", asbytes=True)
    return rows, np.frombuffer(data, kind).reshape(len(rows), dim)


def _all_of(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def _cuts(n_queries: int, n_items: int, dim: int, k: int, tasks: int) -> tuple[int, int]:
    """Blocks of queries and shares of items, for about ``tasks`` tasks or more.

    A block more sends all items once more; a share more sends all queries and k winners of each.
    Among the cuts that keep a task's memory bounded, the one that sends least is taken.
    """
    most = max(1, min(_BLOCK_BYTES // (8 * dim), _BLOCK_QUERIES, _STATE_BYTES // (16 * k)))
    least_blocks, least_shares = max(1, -(-n_queries // most)), max(1, -(-n_items // _SHARE_ITEMS))
    most_blocks = max(least_blocks, min(tasks, n_queries // _LEAST_BLOCK))
    most_shares = max(least_shares, min(tasks, n_items // _LEAST_SHARE))
    row = 4 * dim + _ROW_BYTES

    def sent(cut: tuple[int, int]) -> int:
        return cut[0] * n_items * row + cut[1] * n_queries * (row + k * _WINNER_BYTES)

    wanted = min(tasks, most_blocks * most_shares)
    cuts = [(b, min(most_shares, max(least_shares, -(-wanted // b)))) for b in range(least_blocks, most_blocks + 1)]
    return min((c for c in cuts if c[0] * c[1] >= wanted), key=sent)


def _stream_cuts(n_queries: int, n_items: int, dim: int, k: int, tasks: int) -> tuple[int, int]:
    """Blocks and shares where blocks read the same stored items.

    Only the k winners of a query and share are sent, so items are cut where blocks make too few tasks.
    """
    most = max(1, min(_BLOCK_BYTES // (8 * dim), _STREAM_QUERIES, _STATE_BYTES // (16 * k)))
    blocks = max(1, -(-n_queries // most), min(tasks, n_queries // _LEAST_BLOCK))
    return blocks, max(1, min(tasks // blocks, n_items // _LEAST_SHARE))


def _whole_blocks(packed: DataFrame, blocks: int, dim: int) -> DataFrame:
    """The packed rows of one ``_at`` as one row, which is all that its partition holds; stored."""
    layout = packed.schema
    schema = to_arrow_schema(layout)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [row for batch in batches for row in batch.to_pylist()]
        if parts:
            tables, matrices = zip(*(_unpacked(row, dim) for row in parts), strict=True)
            whole = _packed(pa.concat_tables(tables).combine_chunks(), np.concatenate(matrices))
            columns = [[parts[0]["_at"]], *([x] for x in whole)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    return cut_lineage(packed.repartitionById(blocks, F.col("_at")).mapInArrow(join, layout))


def _stream_join(
    queries: DataFrame, items: DataFrame, layout: T.StructType, kept: list[str], dim: int, k: int,
    tile: tuple[int, int], blocks: int, shares: int,
) -> DataFrame:
    """Every block of queries meets every share of the items, which all blocks read from where they are stored once.

    The product is one of blocks and packed rows. A block goes to Python with the first row of its task only.
    """
    left = _pack(queries, ["_query"], F.pmod(F.xxhash64("_query"), F.lit(blocks)), dim, None)
    left = _whole_blocks(left, blocks, dim).select(F.col("rows").alias("_ids"), F.col("matrix").alias("_block"))
    right = _pack(items, kept, F.pmod(F.xxhash64(kept[0]), F.lit(shares)), dim, None, _STREAM_BYTES)
    right = right.repartitionById(shares, F.col("_at")).drop("_at")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    met = right.hint("shuffle_replicate_nl").crossJoin(left).withColumn("_first", first)
    met = met.select("rows", "matrix", *[F.when(F.col("_first"), F.col(c)).alias(c) for c in ("_ids", "_block")])
    arrow_layout = to_arrow_schema(layout)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, waiting, size = None, [], 0

        def take() -> None:
            matrix = np.concatenate([m for _, m in waiting]).astype(np.float64)
            best.add(matrix, pa.concat_tables([r for r, _ in waiting]).to_pandas(), kept[0])
            waiting.clear()

        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                if row["_ids"] is not None:
                    if best is not None:
                        raise ValueError("two blocks of queries in one task")
                    ids, matrix = _unpacked({"rows": row["_ids"], "matrix": row["_block"]}, dim)
                    asked = _unit_queries(ids.column(0).to_pandas().to_numpy(), matrix.astype(np.float64))
                    best = _Nearest(*asked, k, tile)
                waiting.append(_unpacked(row, dim))
                size += waiting[-1][1].nbytes
                if size >= _TOGETHER_BYTES:
                    take()
                    size = 0
        if best is not None:
            if waiting:
                take()
            yield from _frames(best.winners(), arrow_layout)

    return met.mapInArrow(meet, layout)


def _tile_join(
    queries: DataFrame, items: DataFrame, layout: T.StructType, kept: list[str], dim: int, k: int,
    group: str | None, tile: tuple[int, int],
) -> DataFrame:
    """Every block of queries meets every share of the items, which passes it row by packed row."""
    tasks = 4 * items.sparkSession.sparkContext.defaultParallelism
    n_queries, n_items = queries.count(), items.count()
    blocks, shares = _cuts(n_queries, n_items, dim, k, tasks)
    if group is None and blocks > 1:
        return _stream_join(
            queries, items, layout, kept, dim, k, tile, *_stream_cuts(n_queries, n_items, dim, k, tasks)
        )
    left = _pack(queries, ["_query"], F.pmod(F.xxhash64("_query"), F.lit(blocks)), dim, None)
    right = _pack(items, kept, F.pmod(F.xxhash64(kept[0]), F.lit(shares)), dim, group)
    left = left.select(F.col("_at").alias("_block"), _all_of(shares).alias("_share"), F.lit(0).alias("_side"), "rows", "matrix")
    right = right.select(
        _all_of(blocks).alias("_block"), F.col("_at").alias("_share"), F.lit(1).alias("_side"), "rows", "matrix",
        *(["_group"] if group else []),
    )
    met = left.unionByName(right, allowMissingColumns=True)
    cell = F.col("_block") * shares + F.col("_share")
    order = ["_cell", "_side", *(["_group"] if group else [])]
    met = met.withColumn("_cell", cell).drop("_block", "_share").repartitionById(blocks * shares, F.col("_cell"))
    arrow_layout = to_arrow_schema(layout)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, asked, best, current, waiting, size = [], None, None, None, [], 0

        def take() -> None:
            if waiting:
                matrix = np.concatenate([m for _, m in waiting]).astype(np.float64)
                best.add(matrix, pa.concat_tables([r for r, _ in waiting]).to_pandas(), kept[0])
                waiting.clear()

        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                here = row["_cell"], row.get("_group")
                if row["_side"] == 0:
                    if best is not None:
                        take()
                        yield from _frames(best.winners(), arrow_layout)
                        parts, best = [], None
                    if parts and parts[0][0] != row["_cell"]:
                        parts = []
                    parts.append((row["_cell"], *_unpacked(row, dim)))
                    asked = None
                    continue
                if asked is None or asked[0] != row["_cell"]:
                    mine = [p for p in parts if p[0] == row["_cell"]]
                    asked = row["_cell"], None
                    if mine:
                        ids = pa.concat_tables([p[1] for p in mine]).column(0).to_pandas().to_numpy()
                        asked = row["_cell"], _unit_queries(ids, np.concatenate([p[2] for p in mine]).astype(np.float64))
                    parts = []
                if asked[1] is None:
                    continue
                if best is None or here != current:
                    if best is not None:
                        take()
                        yield from _frames(best.winners(), arrow_layout)
                    best, current, size = _Nearest(*asked[1], k, tile), here, 0
                waiting.append(_unpacked(row, dim))
                size += waiting[-1][1].nbytes
                if size >= _TOGETHER_BYTES:
                    take()
                    size = 0
        if best is not None:
            take()
            yield from _frames(best.winners(), arrow_layout)

    return met.sortWithinPartitions(*order).mapInArrow(meet, layout)


def merge_winners(local: DataFrame, query_id: str, item_id: str, group: str | None, k: int) -> DataFrame:
    """Global k best per query from the per-task winners, with ``distance`` and ``rank``."""
    keys = ["_query"] if group is None else ["_query", group]
    best = top_k_per_group(local, keys, [F.col("_units"), F.col(item_id)], k)
    return best.select(
        F.col("_query").alias(query_id),
        *[c for c in local.columns if c not in ("_query", "_units")],
        (F.col("_units") / F.lit(float(_UNITS))).alias("distance"),
        "rank",
    )


def nearest_items(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    dim: int,
    *,
    query_id: str = "qid",
    query_vector: str = "vector",
    item_id: str = "chunk_id",
    item_vector: str = "embedding",
    carry: Sequence[str] = (),
    group: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    tile_queries: int = TILE_QUERIES,
    tile_items: int = TILE_ITEMS,
) -> DataFrame:
    """Exact k nearest items per query, or per query and item ``group``.

    Returns ``query_id, item_id, carry..., [group], distance, rank``. Filter ``items`` before
    the call: whatever is filtered out can never take a place among the k.
    """
    kept = list(dict.fromkeys([item_id, *carry, *([group] if group else [])]))
    # Nulls are dropped next to the matrix product: a filter here would be pushed down and
    # compute derived vectors twice.
    left = queries.select(F.col(query_id).alias("_query"), F.col(query_vector).alias("_vector"))
    right = items.select(*kept, F.col(item_vector).alias("_vector"))
    layout = _local_schema(queries, items, query_id, kept)
    limit = max(1, min(broadcast_bytes // (8 * dim), _STATE_BYTES // (16 * k)))
    tile = max(1, tile_queries), max(1, tile_items)
    sample = left.limit(limit + 1).toArrow()
    if sample.num_rows <= limit:
        local = _broadcast_join(sample, right, layout, kept, dim, k, group, tile)
    else:
        local = _tile_join(left, right, layout, kept, dim, k, group, tile)
    return merge_winners(local, query_id, item_id, group, k)


def document_ranking(
    hits: DataFrame, query_id: str = "qid", doc_id: str = "doc_id", depth: int = 50, k: int = 10,
    groups: Sequence[str] = (),
) -> DataFrame:
    """Chunk hits reduced to documents: first occurrence within ``depth``, then k documents."""
    keys = [*groups, query_id]
    firsts = (
        hits.filter(F.col("rank") <= depth)
        .groupBy(*keys, doc_id)
        .agg(F.min("rank").alias("chunk_rank"))
    )
    return top_k_per_group(firsts, keys, [F.col("chunk_rank")], k)
