"""Arrow and numpy helpers used inside tasks: words of texts, hashes, ragged arrays."""

from __future__ import annotations

import ctypes
import secrets
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

# Bytes of text handled at once; a longer document is handled alone. Most rows handled at once.
CHUNK_BYTES, CHUNK_ROWS = 8 << 20, 1 << 20
SPACES = b" \t\n\x0b\x0c\r"
# White space of Unicode beyond ASCII.
WIDE_SPACES = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_GOLDEN = 0x9E3779B97F4A7C15


def chunks_of(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` with at most ``limit`` bytes of text, or one longer row."""
    _, offsets = text_bytes(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), first + CHUNK_ROWS, batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and where each starts; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_large_binary(texts.type) or pa.types.is_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, raw_offsets, raw = texts.buffers()
    offsets = np.frombuffer(raw_offsets, np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if raw is None else np.frombuffer(raw, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def release_memory() -> None:
    """Gives back what Arrow and the C library keep for later: a worker lives on, and others share its machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:
        pass  # another C library


def _is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _is_wide_space(data: np.ndarray) -> np.ndarray:
    """As ``_is_space``, for all white space of Unicode; every byte of such a character is marked."""
    space = _is_space(data)
    leads = {c.encode()[0] for c in WIDE_SPACES}
    at = np.flatnonzero(np.isin(data, np.array(sorted(leads), np.uint8)))
    for code in (c.encode() for c in WIDE_SPACES) if len(at) else ():
        found = at[at + len(code) <= len(data)]
        for i, byte in enumerate(code):
            found = found[data[found + i] == byte]
        for i in range(len(code)):
            space[found + i] = True
    return space


Coded = tuple[np.ndarray, np.ndarray, pa.Array]


def coded_pieces(data: np.ndarray, offsets: np.ndarray, wide: bool = False, blank: bool = False) -> Coded:
    """Cuts texts before every run of white space, of ASCII or (``wide``) of Unicode.

    Returns the number of the distinct piece at each place, where each text's pieces begin
    (one more at the end), and the distinct pieces. A piece is white space, possibly none,
    followed by a word, or the white space that ends a text. With ``blank`` only runs that begin
    with a blank (U+0020) count.
    """
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64), pa.array([], pa.large_binary())
    space = _is_wide_space(data) if wide else _is_space(data)
    begins = np.empty(len(data), bool)
    begins[0] = True
    np.logical_and(space[1:], ~space[:-1], out=begins[1:])
    if blank:
        begins[1:] &= data[1:] == 32
    starts = offsets[:-1]
    begins[starts[starts < offsets[1:]]] = True
    at = np.flatnonzero(begins)
    codes, distinct = _coded(data, np.append(at, len(data)))
    return codes, np.searchsorted(at, offsets), distinct


def _coded(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    coded = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def coded_words(data: np.ndarray, offsets: np.ndarray) -> Coded:
    """As ``coded_pieces``, for words alone; A-Z are lower-cased in words of ASCII characters only."""
    inside = ~_is_space(data)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = inside[heads]
    at = np.flatnonzero(begins)
    letters = np.concatenate([[0], np.cumsum(inside)])
    bounds, kept = np.append(letters[at], letters[-1]), data[inside]
    upper = np.flatnonzero((kept >= 65) & (kept <= 90))
    beyond = np.zeros(len(at), bool)
    beyond[np.searchsorted(bounds, np.flatnonzero(kept >= 128), side="right") - 1] = True
    upper = upper[~beyond[np.searchsorted(bounds, upper, side="right") - 1]]
    kept[upper] += 32
    codes, distinct = _coded(kept, bounds)
    return codes, np.searchsorted(at, offsets), distinct


def pieces(data: np.ndarray, offsets: np.ndarray, wide: bool = False) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """As ``coded_pieces``, with the distinct pieces as a list."""
    codes, bounds, distinct = coded_pieces(data, offsets, wide)
    return codes, bounds, distinct.to_pylist()


def distinct_of(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting beats the hash table that numpy's ``unique`` uses."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def gather(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``flat[b : b + s]`` for every begin and size, one after the other."""
    ends = np.cumsum(sizes)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - ends + sizes, sizes)]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """As ``pieces``, for words without white space; distinct pieces may hold the same word."""
    codes, bounds, distinct = pieces(data, offsets)
    distinct = [piece.strip(SPACES) for piece in distinct]
    blank = np.fromiter((not w for w in distinct), bool, len(distinct))
    if blank.any():
        kept = ~blank[codes]
        before = np.concatenate([[0], np.cumsum(kept)])
        codes, bounds = codes[kept], before[bounds]
    return codes, bounds, distinct


def hash_words(distinct: list[bytes], seed: int = 0) -> np.ndarray:
    hashed = (xxhash.xxh3_64_intdigest(word, seed) for word in distinct)
    return np.fromiter(hashed, np.uint64, len(distinct))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (the finalizer of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def unmixed(values: np.ndarray) -> np.ndarray:
    """The inverse of ``mixed``, which loses nothing."""
    for shift, factor in ((31, 0x94D049BB133111EB), (27, 0xBF58476D1CE4E5B9), (30, 1)):
        values = values ^ (values >> np.uint64(shift)) ^ (values >> np.uint64(2 * shift))
        values = values * np.uint64(pow(factor, -1, 1 << 64))
    return values


def rolling_hashes(values: np.ndarray, length: int, base: int = _GOLDEN) -> np.ndarray:
    """Rabin-Karp hash modulo 2**64 of every window of ``length`` values, mixed.

    The polynomial of a window comes from those of its halves, so a length costs as many
    passes as it has binary digits.
    """
    if len(values) < length:
        return np.zeros(0, np.uint64)
    part, span, power = values, 1, base  # windows of span values; base ** span
    whole, done = None, 0
    remaining = length
    while remaining:
        if remaining & 1:
            if whole is None:
                whole, done = part, span
            else:
                n = len(part) - done
                whole = whole[:n] * np.uint64(power) + part[done:]
                done += span
        remaining >>= 1
        if remaining:
            n = len(part) - span
            part = part[:n] * np.uint64(power) + part[span:]
            span, power = span * 2, power * power & 0xFFFFFFFFFFFFFFFF
    return mixed(whole)


#: Two primes below 2**32: hashes modulo both, side by side, have 64 bits.
PRIMES = (4294967291, 4294967279)


def drawn_bases() -> tuple[int, ...]:
    """A base for each prime, drawn anew for every run, so nobody can build texts that collide."""
    return tuple(secrets.randbelow(p - 65536) + 65535 for p in PRIMES)


def _modulo(values: np.ndarray, p: int) -> np.ndarray:
    p = np.uint64(p)  # dividing by one number is fast, numpy's remainder is not
    return values - values // p * p


def prime_hashes(values: np.ndarray, length: int, bases: tuple[int, ...]) -> np.ndarray:
    """Rabin-Karp hash, modulo both primes, of every window of ``length`` values, mixed.

    The polynomial of a window comes from those of its halves, as in ``rolling_hashes``.
    """
    if len(values) < length:
        return np.zeros(0, np.uint64)
    both = np.zeros(len(values) - length + 1, np.uint64)
    for p, base in zip(PRIMES, bases, strict=True):
        part, span, power = _modulo(values, p), 1, base
        whole, done, remaining = None, 0, length
        while remaining:
            if remaining & 1:
                if whole is None:
                    whole, done = part, span
                else:
                    whole = _modulo(_modulo(whole[: len(part) - done] * np.uint64(power), p) + part[done:], p)
                    done += span
            remaining >>= 1
            if remaining:
                part = _modulo(_modulo(part[: len(part) - span] * np.uint64(power), p) + part[span:], p)
                span, power = span * 2, power * power % p
        both = (both << np.uint64(32)) | whole
    return mixed(both)


def _powers(base: int, p: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1 modulo p; the worker keeps the longest list of each base."""
    kept = sys.modules.setdefault("kept_powers", types.ModuleType("kept_powers")).__dict__.setdefault("lists", {})
    found = kept.get((base, p))
    if found is None or len(found) < n:
        if len(kept) >= 2 * len(PRIMES):
            kept.clear()
        found, factor = np.ones(1, np.uint64), base
        while len(found) < n:
            found = np.concatenate([found, _modulo(found * np.uint64(factor), p)])
            factor = factor * factor % p
        found = kept[base, p] = found.astype(np.uint32)
    return found[:n].astype(np.uint64)


class PlaceHashes:
    """Rabin-Karp hashes, modulo both primes, of windows of any length at chosen places, mixed.

    Prefix sums of value times power give each window's polynomial; multiplying by the inverse
    power makes equal windows agree wherever they start.
    """

    def __init__(self, values: np.ndarray, bases: tuple[int, ...]):
        n, self._tables = len(values), []
        for p, base in zip(PRIMES, bases, strict=True):
            terms = _modulo(_modulo(values, p) * _powers(base, p, n), p)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
            self._tables.append((p, sums, pow(base, -1, p)))
        self._n = n

    def of(self, places: np.ndarray, length: int) -> np.ndarray:
        both = np.zeros(len(places), np.uint64)
        for p, sums, inverse in self._tables:
            window = _modulo(sums[places + length] - sums[places], p)
            window = _modulo(window * _powers(inverse, p, self._n)[places], p)
            both = (both << np.uint64(32)) | window
        return mixed(both)


def inside(offsets: np.ndarray, length: int, n: int) -> np.ndarray:
    """For the first ``n`` places: does a window of ``length`` from here end in the same text?"""
    ends = np.repeat(offsets[1:], np.diff(offsets))[:n]
    return np.arange(n) + length <= ends


def covered(marked: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a window of ``length`` that starts at a marked place."""
    edges = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(marked)
    edges[at] += 1
    after = at + length
    edges[after[after < n]] -= 1
    return np.cumsum(edges[:-1], dtype=np.int32) > 0


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` for each text."""
    before = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return before[offsets[1:]] - before[offsets[:-1]]


def ragged(items: list[np.ndarray], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``items[c]`` for each code one after the other, and where each begins (one more at the end)."""
    lengths = np.fromiter((len(x) for x in items), np.int64, len(items))
    flat = np.concatenate(items) if items else np.zeros(0, np.int64)
    origin = np.cumsum(lengths) - lengths
    sizes = lengths[codes]
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    at = np.arange(bounds[-1]) + np.repeat(origin[codes] - bounds[:-1], sizes)
    return flat[at], bounds
