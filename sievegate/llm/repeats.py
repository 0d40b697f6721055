"""Which keys of a corpus occur more than once, asked without shuffling a row for each key.

Documents are packed into blocks of some megabytes, written once as a table. In each round every
block sends the distinct keys it holds, cut into ranges of the hash space, as one compressed row
for each range; the task of a range sorts what has arrived and answers each block with bits for
its keys. A key is sent once by a block, however often the block holds it, so a key that fills a
third of the corpus costs one entry for each block. Blocks, ranges and answers all grow with the
input, and a task holds one block or one range.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievegate.llm.arrays import CHUNK_BYTES, chunks_of, distinct_of, release_memory, text_bytes
from sievegate.llm.shared import stored

# Keys in a range, on average; one task sorts a range at a time.
RANGE_KEYS = 1 << 18
LEAST_RANGES = 64
_BLOCK = "block long, ids array<bigint>, lengths binary, size long, body binary, rest binary"
# Bits of a row number that count rows within a block, and of a block number within a task.
ROW_BITS = BLOCK_BITS = 20
_ZSTD = "zstd"


def pack_blocks(
    docs: DataFrame, id_column: str, text_column: str, block_bytes: int = CHUNK_BYTES, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Table of blocks, each with some megabytes of consecutive documents (at least one).

    The columns of ``keep`` go along, for ``Block.rest``. A text among them is stored once, in the body.
    """
    own = text_column if dict(docs.dtypes).get(text_column) == "string" and "." not in text_column else None
    kept = ["text" if c == own else f"keep_{i}" for i, c in enumerate(keep)]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << BLOCK_BITS
        for batch in batches:
            for part in chunks_of(batch, "text", block_bytes):
                data, offsets = text_bytes(part.column("text"))
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([block], pa.int64()),
                        "ids": pa.array([part.column("id").to_pylist()], pa.list_(pa.int64())),
                        "lengths": pa.array([np.diff(offsets).tobytes()], pa.binary()),
                        "size": pa.array([len(data)], pa.int64()),
                        "body": pa.array([pa.compress(data.tobytes(), _ZSTD, asbytes=True)], pa.binary()),
                        "rest": pa.array([_streamed(part.select(kept)) if kept else None], pa.binary()),
                    }
                )
                block += 1

    source = docs.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"),
        *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept, strict=True) if k != "text"],
    )
    return stored(source.mapInArrow(pack, _BLOCK), "blocks")


def _streamed(batch: pa.RecordBatch) -> bytes:
    """The batch in Arrow's stream format; of ``text`` only where it is null, other texts are empty there."""
    if "text" in batch.schema.names:
        text = batch.column("text")
        nulls = pc.if_else(text.is_null(), pa.scalar(None, text.type), pa.scalar("", text.type))
        batch = batch.set_column(batch.schema.get_field_index("text"), "text", nulls)
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=_ZSTD)
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


class Block:
    """The documents of one packed row."""

    def __init__(self, table: pa.Table | pa.RecordBatch, row: int = 0):
        self.number = table.column("block")[row].as_py()
        self.ids = table.column("ids")[row].as_py()
        lengths = np.frombuffer(table.column("lengths")[row].as_py(), np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        size = table.column("size")[row].as_py()
        body = table.column("body")[row].as_py()
        self.data = np.frombuffer(pa.decompress(body, size, _ZSTD, asbytes=True), np.uint8)
        self._rest = table.column("rest")[row].as_py() if "rest" in table.column_names else None

    def rows(self) -> np.ndarray:
        """Numbers of the block's rows, unique in the table of blocks."""
        return (self.number << ROW_BITS) + np.arange(len(self.ids))

    def rest(self, names: tuple[str, ...]) -> pa.Table:
        """The columns that were kept, under the given names."""
        rest = pa.ipc.open_stream(self._rest).read_all()
        if "text" in rest.column_names:
            known = rest.column("text").combine_chunks()
            buffers = [known.buffers()[0], pa.py_buffer(self.offsets.astype(np.int32)), pa.py_buffer(self.data)]
            text = pa.Array.from_buffers(pa.string(), len(known), buffers)
            rest = rest.set_column(rest.column_names.index("text"), "text", text)
        return rest.rename_columns(list(names))


def range_count(blocks: DataFrame, keys_per_byte: float) -> int:
    size = blocks.agg(F.sum("size")).first()[0] or 0
    return max(LEAST_RANGES, int(size * keys_per_byte / RANGE_KEYS) + 1)


def _cuts(keys: np.ndarray, ranges: int, bits: int) -> np.ndarray:
    lowest = [((number << bits) + ranges - 1) // ranges for number in range(1, ranges)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(lowest, np.uint64)), [len(keys)]])


def _squeeze(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0))
    planes = steps.view(np.uint8).reshape(-1, 8).T.tobytes()
    return pa.compress(planes, _ZSTD, asbytes=True)


def _expand(blob: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, count * 8, _ZSTD, asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, count).T).view(np.uint64).ravel(), dtype=np.uint64)


class Answers:
    """What one block was told about its keys, by round."""

    def __init__(self, table: pa.Table):
        self._rows: dict[str, list] = {}
        for row in table.to_pylist():
            self._rows.setdefault(row["round"], []).append(row)

    def of(self, name: str, keys: np.ndarray, ranges: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """For sorted distinct ``keys``: held by another block too; and this block is the first."""
        cuts = _cuts(keys, ranges, bits)
        other, first = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        for row in self._rows.get(name, ()):
            lo, hi = cuts[row["range"]], cuts[row["range"] + 1]
            for target, column in ((other, "repeated"), (first, "first")):
                packed = np.frombuffer(row[column], np.uint8)
                target[lo:hi] = np.unpackbits(packed, count=hi - lo).astype(bool)
        return other, first


COUNTED = _COUNTED = "range int, block long, n long, blob binary, counts binary"
_LEVELS = "block long, range int, levels binary"


def ask_levels(
    blocks: DataFrame,
    name: str,
    counts_of: Callable[[Block], tuple[np.ndarray, np.ndarray]],
    ranges: int,
    bits: int,
) -> DataFrame:
    """Tells every block the binary logarithm, rounded down, of each of its keys' corpus count.

    ``counts_of`` gives the sorted distinct keys of a block, below ``2**bits``, and their counts.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row)
                keys, counts = counts_of(block)
                cuts = _cuts(keys, ranges, bits)
                own = counts.astype("<u4")
                extra = [
                    pa.compress(own[a:b].tobytes(), _ZSTD, asbytes=True)
                    for a, b in zip(cuts[:-1], cuts[1:], strict=True)
                    if a < b
                ]
                sent = _send(block.number, keys, ranges, bits)
                yield from sent.append_column("counts", pa.array(extra, pa.binary())).to_batches()

    def tell(key: tuple, sent: pa.Table) -> pa.Table:
        rows = sent.to_pylist()
        parts = [_expand(row["blob"], row["n"]) for row in rows]
        counts = [
            np.frombuffer(pa.decompress(row["counts"], row["n"] * 4, _ZSTD, asbytes=True), "<u4") for row in rows
        ]
        every = np.concatenate(parts)
        order = np.argsort(every, kind="stable")
        every = every[order]
        heads = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        sums = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), heads)
        distinct, levels = every[heads], np.log2(sums).astype(np.uint8)
        told = [levels[np.searchsorted(distinct, part)] for part in parts]
        return pa.table(
            {
                "block": pa.array([row["block"] for row in rows], pa.int64()),
                "range": pa.array([row["range"] for row in rows], pa.int32()),
                "levels": pa.array([pa.compress(x.tobytes(), _ZSTD, asbytes=True) for x in told], pa.binary()),
            }
        )

    sent = blocks.mapInArrow(send, _COUNTED)
    return stored(sent.groupBy("range").applyInArrow(tell, _LEVELS), f"levels-{name}")


def levels_of(table: pa.Table, keys: np.ndarray, ranges: int, bits: int) -> np.ndarray:
    """The levels that a block was told, in the order of its keys."""
    cuts = _cuts(keys, ranges, bits)
    out = np.zeros(len(keys), np.uint8)
    for row in table.to_pylist():
        lo, hi = cuts[row["range"]], cuts[row["range"] + 1]
        out[lo:hi] = np.frombuffer(pa.decompress(row["levels"], int(hi - lo), _ZSTD, asbytes=True), np.uint8)
    return out


_TOTALS = "block long, range int, totals binary"
#: The block number of rows that hold a range's summary instead of an answer.
SUMMARY = -1


def ask_totals(
    sent: DataFrame, name: str, summary_of: Callable[[np.ndarray, np.ndarray], bytes] | None = None
) -> DataFrame:
    """Tells every block the corpus-wide sums for its keys, as sent by ``counted_keys``.

    ``summary_of`` makes one more row for each range, of block ``SUMMARY``, from its distinct keys
    and their sums.
    """

    def tell(key: tuple, sent: pa.Table) -> pa.Table:
        rows = sent.to_pylist()
        parts = [_expand(row["blob"], row["n"]) for row in rows]
        counts = [
            np.frombuffer(pa.decompress(row["counts"], row["n"] * 4, _ZSTD, asbytes=True), "<u4") for row in rows
        ]
        every = np.concatenate(parts)
        order = np.argsort(every, kind="stable")
        every = every[order]
        heads = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        sums = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), heads)
        distinct = every[heads]
        told = [sums[np.searchsorted(distinct, part)].astype("<i8").tobytes() for part in parts]
        blobs = [pa.compress(x, _ZSTD, asbytes=True) for x in told]
        numbers = [row["block"] for row in rows]
        if summary_of is not None:
            numbers.append(SUMMARY)
            blobs.append(summary_of(distinct, sums))
        return pa.table(
            {
                "block": pa.array(numbers, pa.int64()),
                "range": pa.array([key[0].as_py()] * len(numbers), pa.int32()),
                "totals": pa.array(blobs, pa.binary()),
            }
        )

    return stored(sent.groupBy("range").applyInArrow(tell, _TOTALS), f"totals-{name}")


def counted_keys(block: int, keys: np.ndarray, counts: np.ndarray, ranges: int, bits: int) -> pa.Table:
    """Rows of ``COUNTED`` with a block's sorted distinct keys below ``2**bits`` and their counts."""
    cuts, own = _cuts(keys, ranges, bits), counts.astype("<u4")
    extra = [
        pa.compress(own[a:b].tobytes(), _ZSTD, asbytes=True) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b
    ]
    return _send(block, keys, ranges, bits).append_column("counts", pa.array(extra, pa.binary()))


def totals_of(table: pa.Table, keys: np.ndarray, ranges: int, bits: int) -> np.ndarray:
    """The sums that a block was told, in the order of its keys."""
    cuts = _cuts(keys, ranges, bits)
    out = np.zeros(len(keys), np.int64)
    for row in table.to_pylist():
        lo, hi = cuts[row["range"]], cuts[row["range"] + 1]
        out[lo:hi] = np.frombuffer(pa.decompress(row["totals"], int(hi - lo) * 8, _ZSTD, asbytes=True), "<i8")
    return out


_SENT = "range int, block long, n long, blob binary"
_TOLD = "block long, round string, range int, repeated binary, first binary"


def _send(block: int, keys: np.ndarray, ranges: int, bits: int) -> pa.Table:
    cuts = _cuts(keys, ranges, bits)
    filled = np.flatnonzero(np.diff(cuts))
    return pa.table(
        {
            "range": pa.array(filled, pa.int32()),
            "block": pa.array([block] * len(filled), pa.int64()),
            "n": pa.array(np.diff(cuts)[filled], pa.int64()),
            "blob": pa.array([_squeeze(keys[cuts[r] : cuts[r + 1]]) for r in filled], pa.binary()),
        }
    )


def ask(
    blocks: DataFrame,
    name: str,
    keys_of: Callable[[Block, Answers | None], np.ndarray],
    ranges: int,
    bits: int = 64,
    told: DataFrame | None = None,
) -> DataFrame:
    """Sends the sorted distinct keys below ``2**bits`` of every block, returns the answers.

    ``told`` holds answers of earlier rounds, which ``keys_of`` may use.
    """

    def send_plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row)
                yield from _send(block.number, keys_of(block, None), ranges, bits).to_batches()

    def send_again(mine: pa.Table, answers: pa.Table) -> pa.Table:
        if mine.num_rows == 0:
            return _send(0, np.zeros(0, np.uint64), ranges, bits)
        block = Block(mine)
        return _send(block.number, keys_of(block, Answers(answers)), ranges, bits)

    def tell(key: tuple, sent: pa.Table) -> pa.Table:
        rows = sorted(sent.to_pylist(), key=lambda row: row["block"])
        parts = [_expand(row["blob"], row["n"]) for row in rows]
        every = np.sort(np.concatenate(parts))
        twice = distinct_of(every[1:][every[1:] == every[:-1]])
        taken = np.zeros(len(twice), bool)
        out: dict[str, list] = {"block": [], "round": [], "range": [], "repeated": [], "first": []}
        for row, part in zip(rows, parts, strict=True):
            if not len(twice):
                break
            at = np.minimum(np.searchsorted(twice, part), len(twice) - 1)
            hit = twice[at] == part
            if hit.any():
                first = hit & ~taken[at]
                taken[at[hit]] = True
                for column, value in (
                    ("block", row["block"]), ("round", name), ("range", row["range"]),
                    ("repeated", np.packbits(hit).tobytes()), ("first", np.packbits(first).tobytes()),
                ):
                    out[column].append(value)
        return pa.table(
            {
                "block": pa.array(out["block"], pa.int64()),
                "round": pa.array(out["round"], pa.string()),
                "range": pa.array(out["range"], pa.int32()),
                "repeated": pa.array(out["repeated"], pa.binary()),
                "first": pa.array(out["first"], pa.binary()),
            }
        )

    if told is None:
        sent = blocks.mapInArrow(send_plain, _SENT)
    else:
        sent = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(send_again, _SENT)
    return stored(sent.groupBy("range").applyInArrow(tell, _TOLD), f"told-{name}")


def by_block(
    blocks: DataFrame, decisions: DataFrame, result_of: Callable[[Block, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """``result_of`` for every block and the rows of ``decisions`` whose ``row`` lies in it."""

    def result(mine: pa.Table, decided: pa.Table) -> pa.Table:
        release_memory()
        return result_of(Block(mine), decided)

    placed = decisions.withColumn("block", F.shiftright("row", ROW_BITS))
    return blocks.groupBy("block").cogroup(placed.groupBy("block")).applyInArrow(result, schema)


def finish(
    blocks: DataFrame, told: DataFrame, result_of: Callable[[Block, Answers], pa.Table], schema: str
) -> DataFrame:
    """``result_of`` for every block and its answers."""

    def result(mine: pa.Table, answers: pa.Table) -> pa.Table:
        if mine.num_rows:
            return result_of(Block(mine), Answers(answers))
        raise ValueError("answers without a block")

    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(result, schema)
