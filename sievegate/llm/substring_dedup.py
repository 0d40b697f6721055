"""Substring dedup: words covered by a fixed-length window that occurs twice are removed."""

from __future__ import annotations

import hashlib
import secrets

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sievegate.llm import arrays, repeats

WINDOW_WORDS = 35
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_spans long, kept_text string"


def remove_repeated_windows(
    docs: DataFrame, window: int = WINDOW_WORDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document with the words left after removing every repeated window.

    Words are runs of characters other than space and \\x09-\\x0D. A Rabin-Karp hash is taken of
    every window of ``window`` words inside one document; all hashes are counted over the whole
    corpus, a window counts as repeated when its hash starts at another place too, and overlapping
    repeated windows merge into maximal removal intervals (``n_spans``). Hashes are taken modulo two
    primes with bases drawn anew for every run, so no text can be built that collides; their 64 bits
    make any two of n different windows agree with a probability of about n * n / 2**65.

    Null and empty texts have no words and keep the empty text; a text shorter than the window
    loses nothing; repeated rows (same id too) repeat each other's windows and give one row each; a
    null id stays null. An empty table gives no rows. Other columns are ignored.
    """
    blocks = repeats.pack_blocks(docs, id_column, text_column)
    ranges = repeats.range_count(blocks, 1 / 6)

    bases, seed = arrays.drawn_bases(), secrets.randbits(64)

    def windows(block: repeats.Block):
        codes, bounds, distinct = arrays.words(block.data, block.offsets)
        hashes = arrays.prime_hashes(arrays.hash_words(distinct, seed)[codes], window, bases)
        whole = arrays.inside(bounds, window, len(hashes))
        return codes, bounds, distinct, np.flatnonzero(whole), hashes[whole]

    def keys(block: repeats.Block, _) -> np.ndarray:
        return arrays.distinct_of(windows(block)[4])

    def result(block: repeats.Block, answers: repeats.Answers) -> pa.Table:
        codes, bounds, distinct, at, hashes = windows(block)
        unique, place, times = np.unique(hashes, return_inverse=True, return_counts=True)
        elsewhere, _ = answers.of("windows", unique, ranges, 64)
        starts = np.zeros(len(codes), bool)
        starts[at] = ((times > 1) | elsewhere)[place]
        removed = arrays.covered(starts, window, len(codes))
        kept = []
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            kept.append(b" ".join([distinct[c] for c in codes[lo:hi][~removed[lo:hi]]]))
        opens = removed.copy()
        opens[1:] &= ~removed[:-1]
        heads = bounds[:-1][bounds[:-1] < bounds[1:]]
        opens[heads] = removed[heads]
        return pa.table(
            {
                "doc_id": pa.array(block.ids, pa.int64()),
                "n_words": pa.array(np.diff(bounds), pa.int64()),
                "n_removed": pa.array(arrays.sums(removed, bounds), pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(text).hexdigest() for text in kept]),
                "n_spans": pa.array(arrays.sums(opens, bounds), pa.int64()),
                "kept_text": pa.array([text.decode() for text in kept], pa.string()),
            }
        )

    told = repeats.ask(blocks, "windows", keys, ranges)
    return repeats.finish(blocks, told, result, _RESULT)
