"""Collocation mining: frequent phrases by language, counted in quotient filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievegate.llm import arrays, repeats
from sievegate.llm.shared import drop, stored
from sievegate.operators.ranking import top_k_per_group

LONGEST = 5
LEAST_COUNT = 100
MOST_PHRASES = 2_000
#: Language of documents without one.
NO_LANGUAGE = "und"
#: Entries that blocks send for each word of the corpus, for the number of ranges.
ENTRIES_PER_WORD = 0.2
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_STATE = (
    "block long, langs array<string>, totals binary, hashes binary, lengths binary, text binary, "
    "of binary, counts binary, codes binary"
)
_LEVEL = "block long, places binary, found binary, last binary"
_SENT_WORDS = (
    "range int, block long, head long, langs array<string>, lengths binary, text binary, of binary, counts binary"
)
_SENT = "range int, block long, filter binary"
_WORDS = "array<struct<id:bigint,lang:string,word:string,a:bigint>>"
_PHRASES = "array<struct<id:bigint,first:bigint,last:bigint,a:bigint>>"
_TOLD = "block long, range int, head long, told binary, rows "


class CountingFilter:
    """A counting quotient filter: a multiset of integers below ``2**bits``, without loss.

    Each integer is split into a quotient (its upper bits) and the full remainder. A bit for every
    quotient tells whether it occurs, a bit for every entry whether it ends its quotient's run;
    remainders follow in order, so filters merge as sorted lists do. Counts take one byte, larger
    ones eight more.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, bits: int):
        self.keys, self.counts, self.bits = keys, counts, bits

    def pack(self) -> bytes:
        n = len(self.keys)
        quotient_bits = min(self.bits, max(0, n - 1).bit_length())
        rest = self.bits - quotient_bits
        quotients = self.keys >> np.uint64(rest) if rest < 64 else np.zeros(n, np.uint64)
        occupied = np.zeros(1 << quotient_bits, np.uint8)
        occupied[quotients.astype(np.int64)] = 1
        ends = np.ones(n, np.uint8)
        ends[:-1] = quotients[1:] != quotients[:-1]
        planes = self.keys.astype("<u8").view(np.uint8).reshape(n, 8)[:, : (rest + 7) // 8].copy()
        if rest % 8:
            planes[:, -1] &= (1 << rest % 8) - 1
        large = self.counts >= 255
        head = np.array([n, self.bits, quotient_bits, large.sum()], "<u8").tobytes()
        return b"".join(
            [
                head, np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), planes.T.tobytes(),
                np.minimum(self.counts, 255).astype(np.uint8).tobytes(), self.counts[large].astype("<u8").tobytes(),
            ]
        )

    @classmethod
    def unpack(cls, blob: bytes) -> CountingFilter:
        n, bits, quotient_bits, n_large = np.frombuffer(blob, "<u8", 4).astype(int).tolist()
        rest, at = bits - quotient_bits, 32

        def take(size: int) -> np.ndarray:
            nonlocal at
            at += size
            return np.frombuffer(blob, np.uint8, size, at - size)

        occupied = np.unpackbits(take(((1 << quotient_bits) + 7) // 8), count=1 << quotient_bits)
        ends = np.unpackbits(take((n + 7) // 8), count=n)
        width = (rest + 7) // 8
        planes = np.zeros((n, 8), np.uint8)
        planes[:, :width] = take(n * width).reshape(width, n).T
        run = np.cumsum(ends, dtype=np.int64) - ends
        quotients = np.flatnonzero(occupied).astype(np.uint64)[run]
        high = quotients << np.uint64(rest) if rest < 64 else np.zeros(n, np.uint64)
        counts = take(n).astype(np.int64)
        counts[counts == 255] = take(8 * n_large).view("<u8")
        return cls(planes.view("<u8").ravel() | high, counts, bits)

    @classmethod
    def merged(cls, filters: list[CountingFilter]) -> CountingFilter:
        keys = np.concatenate([f.keys for f in filters])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.add.reduceat(np.concatenate([f.counts for f in filters])[order], heads)
        return cls(keys[heads], counts, filters[0].bits)


class Permutation:
    """An invertible map of the integers below ``2**bits`` that spreads them evenly."""

    def __init__(self, bits: int):
        if not 0 < bits <= 64:
            raise ValueError(f"a packed phrase takes {bits} bits, more than 64")
        self.bits = bits
        self._mask = np.uint64((1 << bits) - 1)
        self._half = np.uint64(max(1, (bits + 1) // 2))
        self._factors = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93]

    def __call__(self, values: np.ndarray) -> np.ndarray:
        for factor in self._factors:
            values = values ^ (values >> self._half)
            values = (values * np.uint64(factor)) & self._mask
        return values ^ (values >> self._half)

    def inverse(self, values: np.ndarray) -> np.ndarray:
        # a shift by half of the bits or more undoes itself
        values = values ^ (values >> self._half)
        for factor in reversed(self._factors):
            values = (values * np.uint64(pow(factor, -1, 1 << 64))) & self._mask
            values = values ^ (values >> self._half)
        return values


def _squeeze(values: np.ndarray, kind: str = "<i4") -> bytes:
    planes = values.astype(kind).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _expand(blob: bytes, kind: str = "<i4") -> np.ndarray:
    n, width = int.from_bytes(blob[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(blob[8:], n * width, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).ravel().astype(np.int64)


def words_and_gaps(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """Words of texts, which gap number each has before it, and the text each is from.

    A-Z are lower-cased; words are runs without blanks, tabs and piece ends. Words of one piece
    share a number; it grows with every piece end and every text.
    """
    data = data.copy()
    data[(data >= 65) & (data <= 90)] += 32
    ends = np.isin(data, np.frombuffer(_PIECE_ENDS, np.uint8))
    inside = ~(ends | (data == 32) | (data == 9))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = inside[heads]
    at = np.flatnonzero(begins)
    text = np.searchsorted(offsets, at, side="right") - 1
    gaps = np.cumsum(ends, dtype=np.int64)[at] + text
    letters = np.concatenate([[0], np.cumsum(inside)])
    bounds = np.append(letters[at], letters[-1]).astype(np.int64)
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[inside]))]
    return pa.Array.from_buffers(pa.large_binary(), len(at), buffers).dictionary_encode(), gaps, text


def _text(data: np.ndarray) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data.tobytes(), "zstd", asbytes=True)


def _untext(blob: bytes) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    return np.frombuffer(pa.decompress(blob[8:], size, "zstd", asbytes=True), np.uint8)


def _state(number: int, texts: pa.Array, langs: pa.Array) -> dict:
    """A block's words: the distinct (word, language) pairs with their counts, and the text as their codes.

    Pairs are in the order of a hash. Codes start at 1; a 0 stands between pieces.
    """
    data, offsets = arrays.text_bytes(texts)
    words, gaps, text = words_and_gaps(data, offsets)
    coded = langs.dictionary_encode()
    names = coded.dictionary.to_pylist()
    lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]
    keys = words.indices.to_numpy(zero_copy_only=False).astype(np.int64) * max(1, len(names)) + lang
    unique, codes, counts = np.unique(keys, return_inverse=True, return_counts=True)
    word, of = np.divmod(unique, max(1, len(names)))
    seeds = np.array([xxhash.xxh3_64_intdigest(name) for name in names], np.uint64)
    hashes = arrays.mixed(hash_strings(*arrays.text_bytes(words.dictionary))[word] ^ seeds[of])
    order = np.argsort(hashes, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    steps = np.zeros(len(gaps), np.int64)
    steps[1:] = gaps[1:] != gaps[:-1]
    line = np.zeros(len(codes) + int(steps.sum()), np.int64)
    line[np.arange(len(codes)) + np.cumsum(steps)] = rank[codes] + 1
    letters, bounds = arrays.text_bytes(words.dictionary.take(pa.array(word[order])))
    return {
        "block": number, "langs": names, "totals": np.bincount(lang, minlength=len(names)).tobytes(),
        "hashes": hashes[order].tobytes(), "lengths": _squeeze(np.diff(bounds)), "text": _text(letters),
        "of": _squeeze(of[order]), "counts": _squeeze(counts[order]), "codes": _squeeze(line),
    }


def _first_level(state: DataFrame, least: int, range_bits: int) -> tuple[DataFrame, DataFrame]:
    """Texts as ids of frequent words, and the table of these words.

    Every block sends its distinct words with their counts, cut by ranges of a hash that only
    spreads them; a range compares the words themselves.
    """
    ranges = 1 << range_bits

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes = np.frombuffer(row["hashes"], np.uint64)
                lengths, of, counts = (_expand(row[c]) for c in ("lengths", "of", "counts"))
                text, ends = _untext(row["text"]), np.concatenate([[0], np.cumsum(lengths)])
                lowest = np.arange(ranges, dtype=np.uint64) << np.uint64(64 - range_bits)
                cuts = np.append(np.searchsorted(hashes, lowest), len(hashes))
                filled = np.flatnonzero(np.diff(cuts))
                parts = [(int(cuts[r]), int(cuts[r + 1])) for r in filled]
                yield pa.RecordBatch.from_pydict(
                    {
                        "range": pa.array(filled, pa.int32()),
                        "block": pa.array([row["block"]] * len(parts), pa.int64()),
                        "head": pa.array([lo for lo, _ in parts], pa.int64()),
                        "langs": pa.array([row["langs"]] * len(parts), pa.list_(pa.string())),
                        "lengths": pa.array([_squeeze(lengths[lo:hi]) for lo, hi in parts], pa.binary()),
                        "text": pa.array([_text(text[ends[lo] : ends[hi]]) for lo, hi in parts], pa.binary()),
                        "of": pa.array([_squeeze(of[lo:hi]) for lo, hi in parts], pa.binary()),
                        "counts": pa.array([_squeeze(counts[lo:hi]) for lo, hi in parts], pa.binary()),
                    }
                )

    def tell(key: tuple, sent: pa.Table) -> pa.Table:
        number, names, words, langs, counts = key[0].as_py(), {}, [], [], []
        for row in sent.select(["langs", "lengths", "text", "of", "counts"]).to_pylist():
            bounds = np.concatenate([[0], np.cumsum(_expand(row["lengths"]))]).astype(np.int64)
            buffers = [None, pa.py_buffer(bounds), pa.py_buffer(_untext(row["text"]))]
            words.append(pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers))
            known = np.array([names.setdefault(name, len(names)) for name in row["langs"]], np.int64)
            langs.append(known[_expand(row["of"])])
            counts.append(_expand(row["counts"]))
        coded = pa.concat_arrays(words).dictionary_encode()
        keys = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(names) + np.concatenate(langs)
        unique, place = np.unique(keys, return_inverse=True)
        totals = np.bincount(place, np.concatenate(counts), minlength=len(unique)).astype(np.int64)
        frequent = totals >= least
        ids = np.where(frequent, np.cumsum(frequent) * ranges + number, 0)
        ends = np.cumsum([len(x) for x in words])
        told = [_squeeze(part, "<i8") for part in np.split(ids[place], ends[:-1])]
        word, lang = np.divmod(unique[frequent], len(names))
        spelled = coded.dictionary.take(pa.array(word)).to_pylist()
        called = list(names)
        rows = [
            {"id": i, "lang": called[o], "word": w.decode(), "a": a}
            for i, o, w, a in zip(
                ids[frequent].tolist(), lang.tolist(), spelled, totals[frequent].tolist(), strict=True
            )
        ]
        return _answer(number, sent.column("block"), sent.column("head"), told, rows, _WORD_ROWS)

    def number(mine: pa.Table, answers: pa.Table) -> pa.Table:
        line = _expand(mine.column("codes")[0].as_py())
        table = np.zeros(int(line.max(initial=0)) + 1, np.int64)
        for answer in answers.to_pylist():
            ids = _expand(answer["told"], "<i8")
            table[answer["head"] + 1 : answer["head"] + 1 + len(ids)] = ids
        line = table[line]
        places = np.flatnonzero(line)
        return _level(mine.column("block")[0].as_py(), places, line[places], line[places])

    narrow = state.select("block", "langs", "hashes", "lengths", "text", "of", "counts")
    sent = narrow.mapInArrow(send, _SENT_WORDS)
    told = stored(sent.groupBy("range").applyInArrow(tell, _TOLD + _WORDS), "told-1")
    answers = told.filter(F.col("block") != repeats.SUMMARY).select("block", "head", "told")
    met = state.select("block", "codes").groupBy("block").cogroup(answers.groupBy("block"))
    level = stored(met.applyInArrow(number, _LEVEL), "level-1")
    words = told.filter(F.col("block") == repeats.SUMMARY).selectExpr("inline(rows)")
    words = stored(words, "vocabulary")
    drop(told)
    return level, words


def hash_strings(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each string ``data[bounds[i] : bounds[i + 1]]`` that spreads them; equal strings agree."""
    sizes = np.diff(bounds)
    place = np.arange(len(data), dtype=np.uint64) - np.repeat(bounds[:-1], sizes).astype(np.uint64)
    values = arrays.mixed(data.astype(np.uint64) + np.uint64(1)) * (arrays.mixed(place + np.uint64(1)) | np.uint64(1))
    before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return arrays.mixed(before[bounds[1:]] - before[bounds[:-1]] + sizes.astype(np.uint64))


_WORD_ROWS = pa.struct([("id", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("a", pa.int64())])
_PHRASE_ROWS = pa.struct([(c, pa.int64()) for c in ("id", "first", "last", "a")])


def _answer(number: int, blocks, heads, told: list[bytes], rows: list, kind: pa.DataType) -> pa.Table:
    """What a range tells each block, and one more row with its table of frequent entries."""
    n = len(told)
    return pa.table(
        {
            "block": pa.array([*blocks.to_pylist(), repeats.SUMMARY], pa.int64()),
            "range": pa.array([number] * (n + 1), pa.int32()),
            "head": pa.array([*heads.to_pylist(), 0], pa.int64()),
            "told": pa.array([*told, b""], pa.binary()),
            "rows": pa.array([None] * n + [rows], pa.list_(kind)),
        }
    )


def _level(block: int, places: np.ndarray, found: np.ndarray, last: np.ndarray) -> pa.Table:
    """Places of frequent phrases, their ids and their last words' ids; single ones are of no more use."""
    near = np.diff(places) == 1
    kept = np.concatenate([near, [False]]) | np.concatenate([[False], near]) if len(places) else np.zeros(0, bool)
    row = {
        "block": block, "places": _squeeze(np.diff(places[kept], prepend=0)),
        "found": _squeeze(found[kept], "<i8"), "last": _squeeze(last[kept], "<i8"),
    }
    return pa.Table.from_pylist([row], schema=_LEVEL_SCHEMA)


_LEVEL_SCHEMA = pa.schema([("block", pa.int64()), *((c, pa.binary()) for c in ("places", "found", "last"))])


class _Packing:
    """How a phrase of some length becomes one integer: the id of all but its last word, and that word's."""

    def __init__(self, size: int, highest: int, word_bits: int, range_bits: int):
        self.size, self.word_bits, self.range_bits = size, word_bits, range_bits
        self.permutation = Permutation(max(highest.bit_length() + word_bits, range_bits + 1))
        self.bits = self.permutation.bits - range_bits  # in the filter of one range

    def candidates(self, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of phrases whose parts without the last and the first word are frequent, last words, and keys."""
        places, found, last = np.cumsum(_expand(row["places"])), _expand(row["found"], "<i8"), _expand(row["last"], "<i8")
        follows = np.flatnonzero(np.diff(places) == 1)
        last = last[follows + 1]
        packed = (found[follows].astype(np.uint64) << np.uint64(self.word_bits)) | last.astype(np.uint64)
        return places[follows], last, self.permutation(packed)

    def parts(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        packed = self.permutation.inverse(keys)
        return packed >> np.uint64(self.word_bits), packed & np.uint64((1 << self.word_bits) - 1)

    def cuts(self, keys: np.ndarray) -> np.ndarray:
        """Where each range begins among sorted keys (one more)."""
        lowest = np.arange(1 << self.range_bits, dtype=np.uint64) << np.uint64(self.bits)
        return np.append(np.searchsorted(keys, lowest), len(keys))


def _next_level(level: DataFrame, packing: _Packing, least: int) -> tuple[DataFrame, DataFrame]:
    """Texts as ids of frequent phrases one word longer, and the table of these phrases.

    Every block counts its candidates in a filter, cut by ranges of the quotient. A range merges
    the filters of all blocks, numbers the frequent phrases and tells each block theirs.
    """
    ranges = 1 << packing.range_bits
    low = np.uint64((1 << packing.bits) - 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = np.unique(packing.candidates(row)[2], return_counts=True)
                cuts = packing.cuts(keys)
                filled = np.flatnonzero(np.diff(cuts))
                blobs = [
                    CountingFilter(keys[cuts[r] : cuts[r + 1]] & low, counts[cuts[r] : cuts[r + 1]], packing.bits).pack()
                    for r in filled
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "range": pa.array(filled, pa.int32()),
                        "block": pa.array([row["block"]] * len(filled), pa.int64()),
                        "filter": pa.array(blobs, pa.binary()),
                    }
                )

    def tell(key: tuple, sent: pa.Table) -> pa.Table:
        number = key[0].as_py()
        filters = [CountingFilter.unpack(blob) for blob in sent.column("filter").to_pylist()]
        whole = CountingFilter.merged(filters)
        frequent = whole.counts >= least
        ids = np.where(frequent, np.cumsum(frequent) * ranges + number, 0)
        told = [_squeeze(ids[np.searchsorted(whole.keys, f.keys)], "<i8") for f in filters]
        full = whole.keys[frequent] | np.uint64(number << packing.bits)
        first, last = packing.parts(full)
        columns = (x.tolist() for x in (ids[frequent], first, last, whole.counts[frequent]))
        rows = [dict(zip(("id", "first", "last", "a"), row, strict=True)) for row in zip(*columns, strict=True)]
        heads = pa.array([0] * len(told), pa.int64())
        return _answer(number, sent.column("block"), heads, told, rows, _PHRASE_ROWS)

    def number(mine: pa.Table, answers: pa.Table) -> pa.Table:
        row = mine.to_pylist()[0]
        places, last, keys = packing.candidates(row)
        unique, place = np.unique(keys, return_inverse=True)
        cuts, ids = packing.cuts(unique), np.zeros(len(unique), np.int64)
        for answer in answers.to_pylist():
            ids[cuts[answer["range"]] : cuts[answer["range"] + 1]] = _expand(answer["told"], "<i8")
        found = ids[place]
        hit = found > 0
        return _level(row["block"], places[hit], found[hit], last[hit])

    sent = level.mapInArrow(send, _SENT)
    told = stored(sent.groupBy("range").applyInArrow(tell, _TOLD + _PHRASES), f"told-{packing.size}")
    answers = told.filter(F.col("block") != repeats.SUMMARY).select("block", "range", "told")
    met = level.groupBy("block").cogroup(answers.groupBy("block"))
    longer = stored(met.applyInArrow(number, _LEVEL), f"level-{packing.size}")
    table = told.filter(F.col("block") == repeats.SUMMARY).selectExpr("inline(rows)")
    table = stored(table, f"phrases-{packing.size}")
    drop(told)
    return longer, table


def frequent_phrases(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST_COUNT, text_column: str = "text",
    lang_column: str = "lang",
) -> tuple[DataFrame, DataFrame]:
    """Every phrase of up to ``longest`` words that occurs ``least`` times in its language, and word totals.

    The first table has ``lang, words`` (an array), ``phrase`` and ``a``, the second ``lang`` and
    ``n``, all words of the language. A phrase can only be frequent if its parts are, so texts
    become ids of frequent words, then of frequent phrases of two words, three words, and so on.
    """

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << repeats.BLOCK_BITS
        for batch in batches:
            for part in arrays.chunks_of(batch, "text"):
                yield pa.RecordBatch.from_pylist([_state(block, part.column("text"), part.column("lang"))], schema)
                block += 1

    names = ("totals", "hashes", "lengths", "text", "of", "counts", "codes")
    schema = pa.schema(
        [("block", pa.int64()), ("langs", pa.list_(pa.string()))] + [(c, pa.binary()) for c in names]
    )
    source = docs.select(
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(lang_column).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
    )
    state = stored(source.mapInArrow(states, _STATE), "state")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sums = np.frombuffer(row["totals"], np.int64)
                yield pa.RecordBatch.from_pydict({"lang": pa.array(row["langs"], pa.string()), "n": pa.array(sums)})

    sizes = state.select("langs", "totals").mapInArrow(totals, "lang string, n long")
    sizes = stored(sizes.groupBy("lang").agg(F.sum("n").alias("n")), "languages")
    words = sizes.agg(F.sum("n")).first()[0] or 0
    ranges = max(repeats.LEAST_RANGES, int(words * ENTRIES_PER_WORD) // repeats.RANGE_KEYS + 1)
    range_bits = (ranges - 1).bit_length()

    level, known = _first_level(state, least, range_bits)
    drop(state)
    highest = known.agg(F.max("id")).first()[0] or 0
    word_bits = max(1, highest.bit_length())
    phrases = known.select("id", "lang", F.array("word").alias("words"), "a")
    found = [phrases]
    for size in range(2, longest + 1):
        longer, table = _next_level(level, _Packing(size, highest, word_bits, range_bits), least)
        drop(level)
        level = longer
        highest = table.agg(F.max("id")).first()[0] or 0
        first = phrases.select(F.col("id").alias("first"), "lang", "words")
        last = known.select(F.col("id").alias("last"), "word")
        whole = table.join(first, "first").join(last, "last")
        phrases = stored(whole.select("id", "lang", F.concat("words", F.array("word")).alias("words"), "a"), "whole")
        drop(table)
        found.append(phrases)
    drop(level)
    every = found[0]
    for table in found[1:]:
        every = every.union(table)
    every = every.select("lang", "words", F.array_join("words", " ").alias("phrase"), "a")
    return every, sizes


def scored(phrases: DataFrame, sizes: DataFrame) -> DataFrame:
    """Phrases of two words or more with the cut that scores lowest.

    A cut after k words has ``l`` and ``r``, the counts of both parts, and the score
    floor(1000 * a * n / (l * r)), in exact integers; the first of equally low cuts counts.
    """
    candidates = phrases.filter(F.size("words") > 1)
    cuts = candidates.select("lang", "words", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    rest = F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ")
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("_l"), rest.alias("_r")
    )
    parts = phrases.select("lang", F.col("phrase").alias("_part"), F.col("a").alias("_count"))
    left = parts.select("lang", F.col("_part").alias("_l"), F.col("_count").alias("l"))
    right = parts.select("lang", F.col("_part").alias("_r"), F.col("_count").alias("r"))
    whole = cuts.join(left, ["lang", "_l"]).join(right, ["lang", "_r"]).join(sizes, "lang")
    wide = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    score = F.expr(f"(CAST(1000 AS DECIMAL(4, 0)) * {wide('a')} * {wide('n')}) DIV ({wide('l')} * {wide('r')})")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return whole.groupBy("lang", "phrase", "a", "n").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def covered(phrases: DataFrame) -> DataFrame:
    """``lang, phrase`` of the phrases that some longer one holds and that never occur without it.

    It is enough to look one word further: a longer phrase as frequent as its part has only parts as frequent.
    """
    longer = phrases.filter(F.size("words") > 2)
    begin = F.array_join(F.slice("words", F.lit(1), F.size("words") - 1), " ")
    end = F.array_join(F.slice("words", F.lit(2), F.size("words") - 1), " ")
    parts = longer.select("lang", F.explode(F.array(begin, end)).alias("phrase"), "a")
    most = parts.groupBy("lang", "phrase").agg(F.max("a").alias("_most"))
    return phrases.join(most, ["lang", "phrase"]).filter(F.col("_most") >= F.col("a")).select("lang", "phrase")


def mine_phrases(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST_COUNT, most: int = MOST_PHRASES,
    text_column: str = "text", lang_column: str = "lang",
) -> DataFrame:
    """The ``most`` best collocations of every language, with their counts and score.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and those into words at
    blanks and tabs. Candidates are phrases of two to ``longest`` words within a piece that occur at
    least ``least`` times in their language, overlaps included; those that occur only inside a longer
    candidate are dropped. Scores compare a phrase with its parts, as told at ``scored``; ties go to
    the larger count, then the smaller phrase. All counts are exact.

    Null and empty texts have no words; documents without a language form the language ``und``;
    repeated rows count each for itself; a piece may be as long as its text. An empty table gives no
    rows. Other columns are ignored.
    """
    phrases, sizes = frequent_phrases(docs, longest, least, text_column, lang_column)
    phrases = stored(phrases, "frequent")
    kept = scored(phrases, sizes).join(covered(phrases), ["lang", "phrase"], "left_anti")
    order: list[Column] = [F.col("_score"), F.col("_a"), F.col("phrase")]
    kept = kept.withColumn("_score", -F.col("score")).withColumn("_a", -F.col("a"))
    best = top_k_per_group(kept, ["lang"], order, most)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
