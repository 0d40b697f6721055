"""Packing of documents into training sequences of several lengths."""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievegate.llm.arrays import chunks_of
from sievegate.llm.tokens import REMEMBERED, crc, encoder_for, forget_encoder, with_end

END_ID = 1
LONGEST = 2048
SHORTEST_TIER = 256
# Sequences in a step group.
STEP_SEQUENCES = 64
_RESULT = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, tier int, step_group long"
)
Piece = tuple[int, int, int]  # document, start, length


def pack_pool(lengths: list[int], longest: int = LONGEST, shortest: int = SHORTEST_TIER) -> list[list[Piece]]:
    """Sequences of pieces, each filled to exactly a power of two of at most ``longest`` tokens.

    Whole windows of the longest tier are cut off first. What is left of a document goes to the
    shortest tier that holds it. Tiers are packed from long to short: a document opens a sequence
    of its tier, and the gap takes the largest waiting shorter documents that fit, then the head of
    the smallest one that does not, whose rest waits in its own tier. When nothing shorter is
    waiting, the tokens of the open sequence are cut into powers of two.
    """
    sequences: list[list[Piece]] = []
    waiting: list[tuple[int, int, int]] = []  # length, document, start
    for document, length in enumerate(lengths):
        whole = length - length % longest
        sequences.extend([(document, start, longest)] for start in range(0, whole, longest))
        if length > whole:
            waiting.append((length - whole, document, whole))
    waiting.sort()
    while waiting:
        length, document, start = waiting.pop()
        tier = shortest
        while tier < length:
            tier *= 2
        row, gap = [(document, start, length)], tier - length
        while gap and waiting:
            place = bisect_right(waiting, (gap, len(lengths), 0))
            if place:
                other, document, start = waiting.pop(place - 1)
            else:
                size, document, start = waiting.pop(0)
                other = gap
                insort(waiting, (size - gap, document, start + gap))
            row.append((document, start, other))
            gap -= other
        sequences.extend([row] if not gap else _powers(row))
    return sequences


def _powers(row: list[Piece]) -> list[list[Piece]]:
    """The tokens of a sequence as sequences of different powers of two."""
    left, out = sum(length for _, _, length in row), []
    pieces = row[::-1]
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        part = []
        while size:
            document, start, length = pieces.pop()
            taken = min(size, length)
            part.append((document, start, taken))
            size -= taken
            if length > taken:
                pieces.append((document, start + taken, length - taken))
        out.append(part)
    return out


def balanced_groups(sequences: list[list[Piece]], size: int = STEP_SEQUENCES) -> list[int]:
    """A step group for each sequence.

    Sequences are dealt in order of tier and attention cost, back and forth over the groups, so
    groups hold the same mix of lengths and about the same work.
    """
    cost = [(sum(p[2] for p in s), sum(p[2] ** 2 for p in s)) for s in sequences]
    order = sorted(range(len(sequences)), key=lambda i: cost[i], reverse=True)
    groups = -(-len(sequences) // size)
    found = [0] * len(sequences)
    for turn, i in enumerate(order):
        lap, seat = divmod(turn, groups)
        found[i] = seat if lap % 2 == 0 else groups - 1 - seat
    return found


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, longest: int = LONGEST,
    id_column: str = "doc_id", text_column: str = "text", remembered: int = REMEMBERED, keep_encoder: bool = True,
) -> DataFrame:
    """One row per piece of a document: where it lies in which sequence.

    Every task encodes and packs its documents in pools of some megabytes of text, so nothing is
    shuffled and nothing but a pool is held. Sequences never span pools; each has exactly a power
    of two of tokens, hence no padding. Sequence and step group numbers hold the task's number.
    A worker remembers the ids of about ``remembered`` distinct pieces; unless ``keep_encoder``, it
    gives them and the tokenizer back when a task ends.

    A null or empty text is the end id alone; repeated rows are packed each for itself; a null id
    stays null. An empty table gives no rows. Other columns are ignored.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(tokenizer, remembered=remembered)
        sequence = group = TaskContext.get().partitionId() << 36
        for batch in batches:
            for rows in chunks_of(batch, "text"):
                ids, bounds = with_end(*encoder.encode(rows.column("text")), end_id)
                lengths = np.diff(bounds)
                sequences = pack_pool(lengths.tolist(), longest)
                groups = balanced_groups(sequences)
                flat = []
                for s, row in enumerate(sequences):
                    ends = [*accumulate(p[2] for p in row)]
                    flat += [
                        (*piece, sequence + s, end - piece[2], ends[-1], group + groups[s])
                        for piece, end in zip(row, ends, strict=True)
                    ]
                table = np.array(flat, np.int64).reshape(-1, 7)
                first = bounds[table[:, 0]] + table[:, 1]
                sums = [crc(ids[a : a + n]) for a, n in zip(first, table[:, 2], strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": rows.column("id").take(pa.array(table[:, 0])),
                        "start": pa.array(table[:, 1]),
                        "length": pa.array(table[:, 2]),
                        "ids_crc32": pa.array(sums, pa.int64()),
                        "doc_tokens": pa.array(lengths[table[:, 0]], pa.int64()),
                        "sequence_id": pa.array(table[:, 3]),
                        "offset": pa.array(table[:, 4]),
                        "tier": pa.array(table[:, 5], pa.int32()),
                        "step_group": pa.array(table[:, 6]),
                    }
                )
                sequence += len(sequences)
                group += max(groups) + 1
        if not keep_encoder:
            encoder = None
            forget_encoder(tokenizer, remembered=remembered)

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return source.mapInArrow(pack, _RESULT)
