"""Alignment of the tokens that two tokenizers make of the same text."""

from __future__ import annotations

import os
import re
import sys
import types
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievegate.llm import arrays, repeats
from sievegate.llm.shared import drop, stored
from sievegate.llm.tokens import Growing, PieceMemory

# Distinct pieces that an aligner remembers before it starts afresh, and learns at once.
REMEMBERED = 500_000
_PART = 8_192
#: Distinct id pairs for each byte of text, for the number of ranges.
PAIRS_PER_BYTE = 0.05
_ID_BITS = 32
_KEPT = "kept_aligners"
_STATE = (
    "block long, ids array<bigint>, counts binary, bounds binary, codes binary, groups binary, "
    "links binary, pairs binary, documents binary"
)
_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
)


def byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write every byte as one printable character: this maps it back.

    Printable Latin-1 characters stand for themselves, all other bytes in turn for U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class Aligner:
    """Aligns pieces of texts and remembers every piece it has seen.

    Texts, a blank before each, are cut before every run of white space that begins with a blank.
    Neither tokenizer makes a token across such a place (the piece file has no piece with a blank
    behind another character, which is checked), so the tokens of a text are those of its pieces
    and both sides have a token end at every cut.
    """

    def __init__(self, byte_file: str, piece_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(byte_file)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        alphabet, vocabulary = byte_alphabet(), self._a.get_vocab()
        bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            bytes_a[number] = bytes(alphabet[c] for c in token) if set(token) <= set(alphabet) else token.encode()
        names = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        if any(re.search("[^▁]▁", name) for name in names):
            raise ValueError("this piece file has pieces across blanks")
        bytes_b = [
            bytes([int(name[3:-1], 16)]) if self._b.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        self._spelled = [arrays.text_bytes(pa.array(x, pa.large_binary())) for x in (bytes_a, bytes_b)]
        self._digits = [b"%d" % i for i in range(max(len(bytes_a), len(bytes_b)))]
        self._blank = [self._b.piece_to_id("▁")]
        self._forget()

    def _forget(self) -> None:
        self._memory = PieceMemory()
        # by piece: its tokens spell something else; tokens A, tokens B, groups and links; group strings; links
        self._odd, self._sizes = Growing(bool), [Growing(np.int32) for _ in range(4)]
        self._groups, self._ends, self._links = Growing(np.uint8), Growing(np.int64), Growing(np.int64)
        self._ends.append(np.zeros(1, np.int64))

    def numbers(self, distinct: pa.Array, document: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Number of every distinct piece; the new ones lie in ``document`` at ``place``."""
        if len(self._memory) > REMEMBERED:
            self._forget()
        data, bounds = arrays.text_bytes(distinct)
        known, fresh = self._memory.numbers(data, bounds)
        for first in range(0, len(fresh), _PART):
            part = fresh[first : first + _PART]
            self._learn(distinct.take(pa.array(part)), document[part], place[part])
        return known

    def _learn(self, pieces: pa.Array, document: np.ndarray, place: np.ndarray) -> None:
        texts, n = pieces.cast(pa.large_string()).to_pylist(), len(pieces)
        found_a = [e.ids for e in self._a.encode_batch_fast(texts, add_special_tokens=False)]
        found_b = [ids or self._blank for ids in self._b.encode([t[1:] for t in texts], num_threads=1)]
        data, bounds = arrays.text_bytes(pieces)
        lengths, odd, sides = np.diff(bounds), np.zeros(n, bool), []
        for found, (letters, at) in zip((found_a, found_b), self._spelled, strict=True):
            count = np.fromiter(map(len, found), np.int64, n)
            ids = np.fromiter(chain.from_iterable(found), np.int64, int(count.sum()))
            sizes, piece = at[ids + 1] - at[ids], np.repeat(np.arange(n), count)
            same = np.bincount(piece, sizes, minlength=n).astype(np.int64) == lengths
            spelled = arrays.gather(letters, at[ids][same[piece]], sizes[same[piece]])
            wrong = spelled != arrays.gather(data, bounds[:-1][same], lengths[same])
            odd |= ~same
            odd[np.repeat(np.flatnonzero(same), lengths[same])[wrong]] = True
            sides.append((ids, piece, sizes))
        for i, side in enumerate(sides):
            ids, piece, sizes = (x[~odd[side[1]]] for x in side)
            count = np.bincount(piece, minlength=n)
            ends = np.cumsum(sizes)
            # positions in the block: the piece's place and what lies before in the piece
            before = np.concatenate([[0], ends])[np.cumsum(count) - count]
            start = place[piece] + ends - sizes - before[piece]
            sides[i] = ids, piece, start, start + sizes, document[piece], count
        text, sizes, links = align(*sides, n, self._digits)
        if odd.any():
            lines = iter(text.split(b"\n"))
            text = b"\n".join([b"" if o else next(lines) for o in odd.tolist()]) + b"\n"
        letters = np.frombuffer(text, np.uint8)
        self._odd.append(odd)
        for column, values in zip(self._sizes, sizes, strict=True):
            column.append(values)
        self._ends.append(len(self._groups) + np.flatnonzero(letters == 10) + 1)
        self._groups.append(letters)
        self._links.append(links)

    def odd(self, numbers: np.ndarray) -> np.ndarray:
        """Which pieces have tokens that spell something else: the piece file reads U+2581 as a blank.

        That makes a text shorter, so no other piece can make up for it.
        """
        return self._odd.values[numbers]

    def sizes(self, numbers: np.ndarray) -> list[np.ndarray]:
        """Tokens A, tokens B, groups and links of pieces."""
        return [column.values[numbers].astype(np.int64) for column in self._sizes]

    def groups(self, numbers: np.ndarray) -> bytes:
        """The groups of pieces, each with a line end behind."""
        begins = self._ends.values[numbers]
        return arrays.gather(self._groups.values, begins, self._ends.values[numbers + 1] - begins).tobytes()

    def links(self, numbers: np.ndarray) -> np.ndarray:
        """All links of pieces, one piece after the other."""
        sizes = self._sizes[3].values
        begins = (np.cumsum(sizes, dtype=np.int64) - sizes)[numbers]
        return arrays.gather(self._links.values, begins, sizes[numbers].astype(np.int64))


Side = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def align(a: Side, b: Side, n: int, digits: list[bytes]) -> tuple[bytes, list[np.ndarray], np.ndarray]:
    """Groups and links of ``n`` pieces, given ids, pieces, starts, ends, documents and counts of both sides.

    As-of joins keyed by document find the covering token: for every start of A the last start of B
    at or before it, and the other way round. The union of both directions holds every pair whose
    byte ranges overlap; pairs with equal starts come from both and are kept once. Ends that both
    sides have cut the tokens into groups, which are written with ``digits`` for the ids, a line for each
    piece that has tokens.
    """
    ids_a, piece_a, start_a, end_a, document_a, count_a = a
    ids_b, piece_b, start_b, end_b, document_b, count_b = b
    frame_a = pd.DataFrame({"start": start_a, "document": document_a, "token": np.arange(len(ids_a))})
    frame_b = pd.DataFrame({"start": start_b, "document": document_b, "token": np.arange(len(ids_b))})
    over_a = pd.merge_asof(frame_a, frame_b, on="start", by="document")["token_y"].to_numpy(np.int64)
    over_b = pd.merge_asof(frame_b, frame_a, on="start", by="document")["token_y"].to_numpy(np.int64)
    more = start_a[over_b] != start_b
    left = np.concatenate([np.arange(len(ids_a)), over_b[more]])
    right = np.concatenate([over_a, np.flatnonzero(more)])
    order = np.argsort(left, kind="stable")
    left, right = left[order], right[order]
    links = (ids_a[left] << _ID_BITS) | ids_b[right]
    common = np.intersect1d(end_a, end_b, assume_unique=True)
    piece_of_end = piece_a[np.searchsorted(end_a, common)]
    sizes = [count_a, count_b, np.bincount(piece_of_end, minlength=n), np.bincount(piece_a[left], minlength=n)]
    # tokens by group, A before B; what follows a token: the next of its side, the other side, a group, a piece
    group = np.concatenate([np.searchsorted(common, end_a), np.searchsorted(common, end_b)])
    side = np.repeat([0, 1], [len(ids_a), len(ids_b)])
    order = np.lexsort((side, group))
    group, side = group[order], side[order]
    piece = np.concatenate([piece_a, piece_b])[order]
    kind = np.zeros(len(order), np.int64)
    kind[:-1][side[1:] > side[:-1]] = 1
    kind[:-1][group[1:] != group[:-1]] = 2
    kind[:-1][piece[1:] != piece[:-1]] = 3
    kind[-1:] = 3
    ids = np.concatenate([ids_a, ids_b])[order].tolist()
    parts = [b""] * (2 * len(ids))
    parts[::2] = map(digits.__getitem__, ids)
    parts[1::2] = map((b",", b"|", b";", b"\n").__getitem__, kind.tolist())
    return b"".join(parts), sizes, links


def aligner_for(byte_file: str, piece_file: str) -> Aligner:
    """The aligner of this Python worker, whose memory serves all tasks that the worker runs."""
    kept = sys.modules.setdefault(_KEPT, types.ModuleType(_KEPT))
    name = f"{byte_file}:{piece_file}"
    if not hasattr(kept, name):
        setattr(kept, name, Aligner(byte_file, piece_file))
    return getattr(kept, name)


def _packed(values: np.ndarray) -> bytes:
    """Length, and the bytes of int32 values in planes, compressed."""
    planes = values.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(pa.decompress(blob[8:], 4 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<i4").ravel().astype(np.int64)


def _aligned_block(number: int, ids: list, texts: pa.Array, aligner: Aligner) -> dict:
    """The state of a block: tokens, groups and links of its documents, with every distinct piece once."""
    raw, raw_offsets = arrays.text_bytes(texts)
    some = np.diff(raw_offsets) > 0
    data = np.insert(raw, raw_offsets[:-1][some], 32)
    offsets = raw_offsets + np.concatenate([[0], np.cumsum(some)])
    codes, bounds, distinct = arrays.coded_pieces(data, offsets, wide=True, blank=True)
    n, document = len(distinct), np.repeat(np.arange(len(ids)), np.diff(bounds))
    _, ends = arrays.text_bytes(distinct)
    sizes = np.diff(ends)[codes]
    first = np.zeros(n, np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    numbers = aligner.numbers(distinct, document[first], (np.cumsum(sizes) - sizes)[first])
    keep = arrays.sums(aligner.odd(numbers)[codes], bounds)[document] == 0
    codes, document = codes[keep], document[keep]
    bounds = np.searchsorted(document, np.arange(len(ids) + 1))
    by_piece = aligner.sizes(numbers)
    counts = np.stack([arrays.sums(size[codes], bounds) for size in by_piece])
    n_links = by_piece[3]
    pairs, place = np.unique(aligner.links(numbers), return_inverse=True)
    # documents that hold a pair: distinct (document, piece), then distinct (document, pair)
    held = arrays.distinct_of(document * max(1, n) + codes)
    in_document, piece = np.divmod(held, max(1, n))
    pair = arrays.gather(place, (np.cumsum(n_links) - n_links)[piece], n_links[piece])
    both = arrays.distinct_of(np.repeat(in_document, n_links[piece]) * max(1, len(pairs)) + pair)
    documents = np.bincount(both % max(1, len(pairs)), minlength=len(pairs))
    used = documents > 0  # pieces of left-out documents may have pairs that no other has
    renumbered = np.where(used, np.cumsum(used) - 1, 0)
    text = aligner.groups(numbers)
    return {
        "block": number, "ids": ids, "counts": counts.tobytes(), "bounds": bounds.tobytes(), "codes": _packed(codes),
        "groups": len(text).to_bytes(8, "little") + pa.compress(text, "zstd", asbytes=True),
        "links": _packed(np.concatenate([[len(n_links)], n_links, renumbered[place]])),
        "pairs": pairs[used].tobytes(), "documents": documents[used].astype("<u4").tobytes(),
    }


def _mixed_order(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """A block's pairs as mixed 64-bit keys (nothing is lost), and the order that sorts them."""
    keys = arrays.mixed(np.frombuffer(row["pairs"], np.uint64))
    return keys, np.argsort(keys)


def align_documents(
    docs: DataFrame, byte_file: str, piece_file: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: how the tokens of a byte-level file (A) and of a piece file (B) align.

    A encodes a blank and the text, B the text, to which it adds the blank, both without special
    tokens. ``groups`` writes the ids of the smallest runs of tokens that cover the same bytes on
    both sides (``a1,a2|b1;a3|b2``). A link is a pair of an A and a B token whose bytes overlap;
    the count of an id pair is the number of documents of the whole table that hold it linked.
    ``n_best`` counts the links whose pair has the highest count of all pairs of its A id, ties
    included, ``count_sum`` sums the counts over all links.

    Every distinct piece of text is tokenized and aligned once in a worker, by as-of joins keyed by
    document. Blocks of some megabytes then send each distinct pair once with the number of their
    documents; ranges of pairs sum up and answer. The highest count of every A id, at most one row
    for each id of its vocabulary, is broadcast.

    Null and empty texts, and those whose tokens' bytes do not spell a blank and the text, have no
    tokens: zeros and empty groups. Repeated rows count as documents of their own; a null id stays
    null; a text of any length is one row of one block. An empty table gives no rows. Other columns
    are ignored.
    """

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_for(byte_file, piece_file)
        for batch in batches:
            for row in range(batch.num_rows):
                block = repeats.Block(batch, row)
                lengths = pa.py_buffer(block.offsets)
                texts = pa.Array.from_buffers(
                    pa.large_string(), len(block.ids), [None, lengths, pa.py_buffer(block.data)]
                )
                state = _aligned_block(block.number, block.ids, texts, aligner)
                yield pa.RecordBatch.from_pylist([state], schema=schema)

    schema = pa.schema(
        [("block", pa.int64()), ("ids", pa.list_(pa.int64()))]
        + [(c, pa.binary()) for c in ("counts", "bounds", "codes", "groups", "links", "pairs", "documents")]
    )
    blocks = repeats.pack_blocks(docs, id_column, text_column)
    ranges = repeats.range_count(blocks, PAIRS_PER_BYTE)
    state = stored(blocks.mapInArrow(states, _STATE), "aligned")
    drop(blocks)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, order = _mixed_order(row)
                documents = np.frombuffer(row["documents"], "<u4")
                yield from repeats.counted_keys(row["block"], keys[order], documents[order], ranges, 64).to_batches()

    def highest(keys: np.ndarray, totals: np.ndarray) -> bytes:
        first, place = np.unique(arrays.unmixed(keys) >> np.uint64(_ID_BITS), return_inverse=True)
        most = np.zeros(len(first), np.int64)
        np.maximum.at(most, place, totals)
        return np.stack([first.astype(np.int64), most]).tobytes()

    sent = state.select("block", "pairs", "documents").mapInArrow(send, repeats.COUNTED)
    told = repeats.ask_totals(sent, "pairs", highest)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("totals").to_pylist():
                first, most = np.frombuffer(blob, np.int64).reshape(2, -1)
                yield pa.RecordBatch.from_pydict({"first": pa.array(first), "most": pa.array(most)})

    tops = told.filter(F.col("block") == repeats.SUMMARY).select("totals").mapInArrow(spread, "first long, most long")
    rows = tops.groupBy("first").agg(F.max("most").alias("most")).toArrow()
    best = np.zeros(int(np.max(rows.column("first").to_numpy(), initial=0)) + 1, np.int64)
    best[rows.column("first").to_numpy()] = rows.column("most").to_numpy()
    shared_best = docs.sparkSession.sparkContext.broadcast(best)

    def result(mine: pa.Table, answers: pa.Table) -> pa.Table:
        if sys.modules.pop(_KEPT, None):  # this worker's aligner is done
            arrays.release_memory()
        row = mine.to_pylist()[0]
        keys, order = _mixed_order(row)
        totals = np.zeros(len(keys), np.int64)
        totals[order] = repeats.totals_of(answers, keys[order], ranges, 64)
        leads = totals == shared_best.value[np.frombuffer(row["pairs"], np.int64) >> _ID_BITS]
        bounds, codes = np.frombuffer(row["bounds"], np.int64), _unpacked(row["codes"])
        links = _unpacked(row["links"])
        n_links, place = links[1 : 1 + links[0]], links[1 + links[0] :]
        origin = np.concatenate([[0], np.cumsum(n_links)])
        counts = np.frombuffer(row["counts"], np.int64).reshape(4, -1)
        size = int.from_bytes(row["groups"][:8], "little")
        pieces = pa.decompress(row["groups"][8:], size, "zstd", asbytes=True).split(b"\n")
        per_link = [x[place] if len(x) else np.zeros(len(place), np.int64) for x in (leads.astype(np.int64), totals)]
        per_piece = [arrays.sums(x, origin) for x in per_link]
        places = codes.tolist()
        groups = [
            b";".join([pieces[c] for c in places[lo:hi]])
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        ]
        return pa.table(
            {
                "doc_id": pa.array(row["ids"], pa.int64()),
                **{name: pa.array(counts[i]) for i, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
                "n_best": pa.array(arrays.sums(per_piece[0][codes], bounds)),
                "count_sum": pa.array(arrays.sums(per_piece[1][codes], bounds)),
                "groups": pa.array(groups, pa.binary()).cast(pa.string()),
            }
        )

    answers = told.filter(F.col("block") != repeats.SUMMARY)
    return state.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(result, _RESULT)
