"""Suffix-array dedup: bytes covered by a long string that occurs twice are removed."""

from __future__ import annotations

import hashlib
import secrets

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sievegate.llm import arrays, repeats

LENGTH = 200
# The powers of two modulo 73 are a difference cover of period 73.
PERIOD = 73
COVER = sorted(pow(2, i, PERIOD) for i in range(9))
# Cover ranks only rule suffixes out, so a shorter rank suffices there.
RANK_BITS = 44
# Bytes of a block; a task holds some arrays of eight bytes for each.
BLOCK_BYTES = 3 << 20
_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary"


def remove_repeated_strings(
    docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document with the bytes left after removing every repeated string of ``length``.

    Blockwise, one bucket (a range of keys) at a time, suffixes are sorted by a key, and neighbours
    with an equal key are repeats. Only equality of the first ``length`` bytes matters, so the key is
    their 64-bit rolling hash and not the bytes: suffixes are counted, never put in the order of
    their text. Three rounds keep the number of sorted suffixes small:

    1. Suffixes at the places of a difference cover (period 73, nine places) are ranked by their
       first ``length - 72`` bytes. Two equal strings of ``length`` bytes have, for some shift below
       73, cover places at the same shift, so a suffix without a repeated cover rank among its next
       73 places is unique and is never sorted.
    2. Long ties: a cover place whose surrounding 72 + ``length`` bytes occur twice settles all 73
       suffixes that lie inside at once. The first block that holds such a stretch stands for it.
    3. The remaining suffixes near the ends of repeated stretches, and those of the stretches'
       representatives, are sorted by their key.

    Keys are hashes modulo two primes with bases drawn anew for every run, so no text can be built
    that collides; any two of n different strings agree with a probability of about n * n / 2**65.

    Null and empty texts have no bytes; a text shorter than ``length`` loses nothing; repeated rows
    (same id too) repeat each other and give one row each; a null id stays null. An empty table
    gives no rows. Other columns are ignored. Removal may cut a character, so what is left is binary.
    """
    if length < 2 * PERIOD:
        raise ValueError(f"length must be at least {2 * PERIOD}")
    blocks = repeats.pack_blocks(docs, id_column, text_column, BLOCK_BYTES)
    short, wide, back = length - PERIOD + 1, length + PERIOD - 1, PERIOD - 1
    few = repeats.range_count(blocks, len(COVER) / PERIOD)
    some = repeats.range_count(blocks, 0.05)
    many = repeats.range_count(blocks, 0.15)
    bases = arrays.drawn_bases()
    letters = np.random.default_rng(secrets.randbits(64)).integers(1, min(arrays.PRIMES), 256, dtype=np.uint64)

    def hashes_of(block: repeats.Block) -> arrays.PlaceHashes:
        return arrays.PlaceHashes(letters[block.data], bases)

    def cover_places(block: repeats.Block) -> np.ndarray:
        """Places of the cover, counted from the start of each document, that have a rank."""
        begins, sizes = block.offsets[:-1], np.diff(block.offsets)
        periods = np.maximum(0, (sizes - short) // PERIOD + 1)
        turn = np.arange(periods.sum()) - np.repeat(np.cumsum(periods) - periods, periods)
        origin = np.repeat(begins, periods) + PERIOD * turn
        places = (origin[:, None] + np.array(COVER)).ravel()
        return places[places + short <= np.repeat(np.repeat(begins + sizes, periods), len(COVER))]

    def ranks(hashes: arrays.PlaceHashes, places: np.ndarray) -> np.ndarray:
        return hashes.of(places, short) >> np.uint64(64 - RANK_BITS)

    def repeated_places(block: repeats.Block, hashes: arrays.PlaceHashes, answers: repeats.Answers) -> np.ndarray:
        at = cover_places(block)
        unique, place, times = np.unique(ranks(hashes, at), return_inverse=True, return_counts=True)
        elsewhere, _ = answers.of("ranks", unique, few, RANK_BITS)
        return at[((times > 1) | elsewhere)[place]]

    def stretches(block: repeats.Block, hashes: arrays.PlaceHashes, places: np.ndarray):
        """Starts of the stretches around repeated cover places, and their keys."""
        begins = places - back
        begins = begins[begins >= 0]
        document = np.searchsorted(block.offsets, begins, side="right")
        begins = begins[begins + wide <= block.offsets[document]]
        return begins, hashes.of(begins, wide)

    def settled(block: repeats.Block, hashes: arrays.PlaceHashes, answers: repeats.Answers, places: np.ndarray):
        """Suffixes inside repeated stretches, and those that stand for others."""
        begins, keys = stretches(block, hashes, places)
        unique, first_at, place, times = np.unique(
            keys, return_index=True, return_inverse=True, return_counts=True
        )
        elsewhere, leads = answers.of("stretches", unique, some, 64)
        known = ((times > 1) | elsewhere)[place]
        stands = np.zeros(len(begins), bool)
        stands[first_at] = leads | ((times > 1) & ~elsewhere)
        n = len(block.data)
        marked, leading = np.zeros(n, bool), np.zeros(n, bool)
        marked[begins[known]] = True
        leading[begins[stands]] = True
        return arrays.covered(marked, PERIOD, n), arrays.covered(leading, PERIOD, n)

    def open_suffixes(block: repeats.Block, answers: repeats.Answers):
        """Suffixes to sort with their keys, and the settled ones."""
        hashes = hashes_of(block)
        places = repeated_places(block, hashes, answers)
        inner, leads = settled(block, hashes, answers, places)
        near = np.zeros(len(block.data), bool)
        near[places] = True
        near = arrays.covered(near[::-1], PERIOD, len(near))[::-1]
        sort = np.flatnonzero((near & ~inner) | leads)
        sort = sort[sort + length <= block.offsets[np.searchsorted(block.offsets, sort, side="right")]]
        return sort, hashes.of(sort, length), inner

    def rank_keys(block: repeats.Block, _) -> np.ndarray:
        return arrays.distinct_of(ranks(hashes_of(block), cover_places(block)))

    def stretch_keys(block: repeats.Block, answers: repeats.Answers) -> np.ndarray:
        hashes = hashes_of(block)
        return arrays.distinct_of(stretches(block, hashes, repeated_places(block, hashes, answers))[1])

    def suffix_keys(block: repeats.Block, answers: repeats.Answers) -> np.ndarray:
        return arrays.distinct_of(open_suffixes(block, answers)[1])

    def result(block: repeats.Block, answers: repeats.Answers) -> pa.Table:
        at, keys, starts = open_suffixes(block, answers)
        unique, place, times = np.unique(keys, return_inverse=True, return_counts=True)
        elsewhere, _ = answers.of("suffixes", unique, many, 64)
        starts[at[((times > 1) | elsewhere)[place]]] = True
        removed = arrays.covered(starts, length, len(block.data))
        opens = removed.copy()
        opens[1:] &= ~removed[:-1]
        heads = block.offsets[:-1][block.offsets[:-1] < block.offsets[1:]]
        opens[heads] = removed[heads]
        kept = [
            block.data[lo:hi][~removed[lo:hi]].tobytes()
            for lo, hi in zip(block.offsets[:-1], block.offsets[1:], strict=True)
        ]
        return pa.table(
            {
                "doc_id": pa.array(block.ids, pa.int64()),
                "n_bytes": pa.array(np.diff(block.offsets), pa.int64()),
                "n_removed": pa.array(arrays.sums(removed, block.offsets), pa.int64()),
                "n_spans": pa.array(arrays.sums(opens, block.offsets), pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(text).hexdigest() for text in kept], pa.string()),
                "kept_bytes": pa.array(kept, pa.binary()),
            }
        )

    told = repeats.ask(blocks, "ranks", rank_keys, few, RANK_BITS)
    told = told.union(repeats.ask(blocks, "stretches", stretch_keys, some, told=told))
    told = told.union(repeats.ask(blocks, "suffixes", suffix_keys, many, told=told))
    return repeats.finish(blocks, told, result, _RESULT)
