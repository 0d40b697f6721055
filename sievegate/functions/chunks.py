"""Overlapping character windows whose ends fall back to a word boundary.

Each window starts where the previous one ended, so the walk is sequential inside one
text and cannot be a window or explode. Texts that fit in one window never leave the
JVM; only longer ones go through an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from sievegate.functions.text import strip

# Window length, overlap, and how far an end may fall back.
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 100
SNAP_BACK = 200
_AT_ONCE = 1 << 20  # bytes of texts that are Python strings at a time, a single text apart


def check_window(size: int, overlap: int) -> None:
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError(f"window needs 0 <= overlap < size, not size={size} overlap={overlap}")


def window_bounds(text: str, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """(start, end) of every window.

    A start never moves backwards: small windows whose fallback would undo the whole
    step advance by one character.
    """
    total, start = len(text), 0
    while total - start > size:
        limit = start + size
        blank = text.rfind(" ", max(limit - SNAP_BACK, start + 1), limit)
        end = limit if blank < 0 else blank
        yield start, end
        start = max(end - overlap, start + 1)
    if start < total:
        yield start, total


def small_slices(texts: pa.Array, most: int = _AT_ONCE) -> Iterator[pa.Array]:
    """Consecutive parts of ``texts`` of at most ``most`` bytes each, or a single text."""
    start, size = 0, 0
    for row, n in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
        if row > start and size + n > most:
            yield texts.slice(start, row - start)
            start, size = row, 0
        size += n
    if start < len(texts):
        yield texts.slice(start)


def chunk_texts(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """``array<string>`` of stripped, non-empty windows."""
    check_window(size, overlap)

    def pieces(value: str | None) -> list[str] | None:
        if value is None:
            return None
        cut = (value[a:b].strip() for a, b in window_bounds(value, size, overlap))
        return [piece for piece in cut if piece]

    @F.arrow_udf("array<string>")
    def long_text_windows(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            parts = [pa.array(map(pieces, few.to_pylist()), pa.list_(pa.string())) for few in small_slices(batch)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))

    fits = F.length(text) <= size
    short = strip(text)
    return F.coalesce(
        F.when(fits, F.when(short == "", F.array().cast("array<string>")).otherwise(F.array(short))),
        long_text_windows(F.when(~fits, text)),
    )
