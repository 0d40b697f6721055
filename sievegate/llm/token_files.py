"""Token ids in files of directly addressable codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievegate.llm.arrays import chunks_of
from sievegate.llm.tokens import crc, encoder_for, with_end
from sievegate.session import scratch_path

END_ID = 2
# Bits between entries of the rank directory.
RANK_STEP = 512
_MAGIC = b"DAC1"
FILE = "part int, segment int, doc_ids array<bigint>, doc_tokens array<bigint>, n_tokens long, codes binary"


def pack_codes(ids: np.ndarray) -> bytes:
    """Directly addressable codes of ``ids``.

    Every id is cut into bytes, lowest first. Level k holds byte k of the ids that have one, with a
    bit for each that says whether the id goes on at level k + 1, and the number of set bits before
    every 512th: the place at the next level is the number of set bits before.
    """
    out, values = [], np.ascontiguousarray(ids, np.uint32)
    while True:
        more = values > 255
        bits = np.packbits(more, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (RANK_STEP // 8)))
        counts = np.bitwise_count(bits.reshape(-1, RANK_STEP // 8)).sum(axis=1, dtype=np.uint32)
        before = (np.cumsum(counts, dtype=np.uint32) - counts).astype("<u4")
        out.append((values.astype(np.uint8).tobytes(), bits.tobytes(), before.tobytes()))
        if not more.any():
            break
        values = values[more] >> np.uint32(8)
    head = np.array([len(out)] + [len(part) for level in out for part in level], "<u8").tobytes()
    return _MAGIC + head + b"".join(part for level in out for part in level)


class Codes:
    """Reads packed codes: any id by its place, or all of them."""

    def __init__(self, packed: bytes):
        if packed[:4] != _MAGIC:
            raise ValueError("not a file of directly addressable codes")
        levels = int(np.frombuffer(packed, "<u8", 1, 4)[0])
        sizes = np.frombuffer(packed, "<u8", 3 * levels, 12)
        at, self._levels = 12 + 24 * levels, []
        for number in range(levels):
            parts = []
            for kind, size in zip(("u1", "u1", "<u4"), sizes[3 * number :], strict=False):
                parts.append(np.frombuffer(packed, kind, int(size) // np.dtype(kind).itemsize, at))
                at += int(size)
            self._levels.append(parts)

    def __len__(self) -> int:
        return len(self._levels[0][0])

    def __getitem__(self, place: int) -> int:
        value = 0
        for number, (chunks, bits, before) in enumerate(self._levels):
            value |= int(chunks[place]) << (8 * number)
            byte = place >> 3
            if not bits[byte] >> (place & 7) & 1:
                return value
            step = place // RANK_STEP
            earlier = bits[step * (RANK_STEP // 8) : byte]
            within = int(bits[byte]) & ((1 << (place & 7)) - 1)
            place = int(before[step]) + int(np.bitwise_count(earlier).sum()) + within.bit_count()
        raise ValueError("codes end early")

    def all(self) -> np.ndarray:
        value = np.zeros(0, np.uint32)
        for chunks, bits, _ in reversed(self._levels):
            more = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
            upper, value = value, chunks.astype(np.uint32)
            value[more] |= upper << np.uint32(8)
        return value


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, spaces_matter: bool = True,
    id_column: str = "doc_id", text_column: str = "text",
) -> None:
    """Writes the ids of all documents in ascending id order.

    A range shuffle puts documents in order; each task encodes its range and writes segments of
    whole documents, each a row with directly addressable codes of its ids. The files are Parquet,
    whose rows go where the session's file system is. A null text counts as empty and has the end
    id alone; null document ids come first; rows with the same id are ordered by their text.
    ``spaces_matter=False`` is for tokenizers that drop white space and lower-case texts.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, segment = encoder_for(tokenizer, spaces_matter), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in chunks_of(batch, "text"):
                ids, bounds = with_end(*encoder.encode(rows.column("text")), end_id)
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part], pa.int32()),
                        "segment": pa.array([segment], pa.int32()),
                        "doc_ids": pa.array([rows.column("id").to_pylist()], pa.list_(pa.int64())),
                        "doc_tokens": pa.array([np.diff(bounds)], pa.list_(pa.int64())),
                        "n_tokens": pa.array([len(ids)], pa.int64()),
                        "codes": pa.array([pack_codes(ids)], pa.binary()),
                    }
                )
                segment += 1

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    ordered = source.repartitionByRange("id").sortWithinPartitions("id", "text")
    ordered.mapInArrow(encode, FILE).write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: its place among all ids, and its ids' checksum.

    Places come from prefix sums over parts, over the segments of a part and over the documents of
    a segment; only counts are shuffled. No files' rows, no result rows.
    """
    files = spark.read.schema(FILE).parquet(path)
    counts = files.groupBy("part", "segment").agg(F.sum("n_tokens").alias("n"))
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("part_start"))
    inner = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.withColumn("begin", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(parts, "part")
    begins = begins.select("part", "segment", (F.col("begin") + F.col("part_start")).alias("begin"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                ids = Codes(row["codes"]).all()
                bounds = np.concatenate([[0], np.cumsum(row["doc_tokens"])]).astype(np.int64)
                if bounds[-1] != len(ids):
                    raise ValueError("a segment's ids and its documents disagree")
                n = len(row["doc_ids"])
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([row["part"]] * n, pa.int32()),
                        "segment": pa.array([row["segment"]] * n, pa.int32()),
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "inner": pa.array(bounds[:-1], pa.int64()),
                        "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                        "ids_crc32": pa.array(
                            [crc(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.int64()
                        ),
                    }
                )

    schema = "part int, segment int, doc_id long, inner long, n_tokens long, ids_crc32 long"
    found = files.select("part", "segment", "doc_ids", "doc_tokens", "codes").mapInArrow(decode, schema)
    return found.join(begins, ["part", "segment"]).select(
        "doc_id", (F.col("begin") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_index(docs: DataFrame, tokenizer: str, end_id: int = END_ID, spaces_matter: bool = True) -> DataFrame:
    """Writes the files into the shared folder and reads them back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id, spaces_matter)
    return read_tokens(docs.sparkSession, path)
