"""Token ids of whole texts, with every distinct piece of text encoded once in a task."""

from __future__ import annotations

import os
import sys
import types
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa

from sievegate.llm.arrays import chunks_of, coded_pieces, coded_words, gather, mixed, release_memory, text_bytes

# Distinct pieces that an encoder remembers before it starts afresh.
REMEMBERED = 1_500_000
# Bytes of text that an encoder cuts into pieces at once, a longer text alone: each takes some forty bytes more.
PART_BYTES = 1 << 20
_PART = 4096


class Growing:
    """An array to which parts are appended."""

    def __init__(self, kind: type):
        self._values, self._n = np.zeros(1024, kind), 0

    def append(self, part: np.ndarray) -> None:
        size = self._n + len(part)
        if size > len(self._values):
            larger = np.zeros(max(size, len(self._values) * 5 // 4), self._values.dtype)
            larger[: self._n] = self._values[: self._n]
            self._values = larger
        self._values[self._n : size] = part
        self._n = size

    def __len__(self) -> int:
        return self._n

    @property
    def values(self) -> np.ndarray:
        return self._values[: self._n]


class PieceMemory:
    """Numbers for the byte strings seen so far, without a Python object for each.

    Strings are found by a 64-bit hash and then compared byte by byte, so equal hashes of
    different strings do no harm.
    """

    def __init__(self):
        self._hashes, self._numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self._data, self._ends = Growing(np.uint8), Growing(np.int64)
        self._ends.append(np.zeros(1, np.int64))

    def __len__(self) -> int:
        return len(self._ends) - 1

    @staticmethod
    def _hash(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        sizes = np.diff(bounds)
        place = np.arange(len(data), dtype=np.uint64) - np.repeat(bounds[:-1], sizes).astype(np.uint64)
        values = _LETTERS[data] * (mixed(place + np.uint64(1)) | np.uint64(1))
        before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return mixed(before[bounds[1:]] - before[bounds[:-1]] + sizes.astype(np.uint64))

    def numbers(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of every string ``data[bounds[i] : bounds[i + 1]]`` and which of them are new.

        The strings must be distinct; the new ones get the next numbers, in their order.
        """
        hashes, sizes = self._hash(data, bounds), np.diff(bounds)
        found = np.full(len(sizes), -1, np.int64)
        low, high = (np.searchsorted(self._hashes, hashes, side=side) for side in ("left", "right"))
        turn = 0
        while True:
            open_ = np.flatnonzero((found < 0) & (low + turn < high))
            if not len(open_):
                break
            guess = self._numbers[low[open_] + turn].astype(np.int64)
            begins, ends = self._ends.values[guess], self._ends.values[guess + 1]
            same = ends - begins == sizes[open_]
            open_, guess, begins = open_[same], guess[same], begins[same]
            own = gather(data, bounds[:-1][open_], sizes[open_])
            differs = own != gather(self._data.values, begins, sizes[open_])
            before = np.concatenate([[0], np.cumsum(differs)])
            ends = np.cumsum(sizes[open_])
            same = before[ends] == before[ends - sizes[open_]]
            found[open_[same]] = guess[same]
            turn += 1
        fresh = np.flatnonzero(found < 0)
        found[fresh] = len(self) + np.arange(len(fresh))
        self._data.append(gather(data, bounds[:-1][fresh], sizes[fresh]))
        self._ends.append(self._ends.values[-1] + np.cumsum(sizes[fresh]))
        order = np.argsort(hashes[fresh])
        at = np.searchsorted(self._hashes, hashes[fresh][order])
        self._hashes = np.insert(self._hashes, at, hashes[fresh][order])
        self._numbers = np.insert(self._numbers, at, found[fresh][order].astype(np.int32))
        return found, fresh


_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class PieceEncoder:
    """Encodes texts with a tokenizers file, special strings in a text counting as ordinary text.

    Both public BPE files used here look at no more than one run of white space and the word after
    it when they cut a text, so a text cut before every run of white space gives the same ids piece
    by piece. Where spaces matter, a run is one of Unicode white space, which the file merges as a
    whole (space, U+00A0, space); where they are dropped, words without white space are enough, in
    lower case where they are ASCII. Pieces repeat, hence a memory from pieces to ids.
    """

    def __init__(self, path: str, spaces_matter: bool = True, remembered: int = REMEMBERED):
        self._wide, self._remembered = spaces_matter, remembered
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._forget()

    def _forget(self) -> None:
        self._memory = PieceMemory()
        self._ids, self._begins = Growing(np.uint32), Growing(np.int64)
        self._begins.append(np.zeros(1, np.int64))

    def _learn(self, fresh: list[str]) -> None:
        for first in range(0, len(fresh), _PART):
            encoded = self._tokenizer.encode_batch_fast(fresh[first : first + _PART], add_special_tokens=False)
            lists = [e.ids for e in encoded]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            self._begins.append(len(self._ids) + np.cumsum(sizes))
            self._ids.append(np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids begin (one more)."""
        rows = pa.RecordBatch.from_arrays([texts], ["text"])
        parts = [self._encode_part(part.column(0)) for part in chunks_of(rows, "text", PART_BYTES)]
        release_memory()
        ids = np.concatenate([np.zeros(0, np.uint32), *(part for part, _ in parts)])
        begins, bounds = 0, [np.zeros(1, np.int64)]
        for part, inner in parts:
            bounds.append(begins + inner[1:])
            begins += len(part)
        return ids, np.concatenate(bounds)

    def _encode_part(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = text_bytes(texts)
        codes, bounds, distinct = coded_pieces(data, offsets, True) if self._wide else coded_words(data, offsets)
        if len(self._memory) > self._remembered or len(self._ids) > 8 * self._remembered:
            self._forget()
        known, fresh = self._memory.numbers(*text_bytes(distinct))
        self._learn(distinct.take(pa.array(fresh)).cast(pa.large_string()).to_pylist())
        begins = self._begins.values
        known = known[codes]
        sizes = begins[known + 1] - begins[known]
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return gather(self._ids.values, begins[known], sizes), ends[bounds]


def encoder_for(path: str, spaces_matter: bool = True, remembered: int = REMEMBERED) -> PieceEncoder:
    """The encoder of this Python worker, whose memory serves all tasks that the worker runs."""
    kept = sys.modules.setdefault("kept_piece_encoders", types.ModuleType("kept_piece_encoders"))
    name = f"{path}:{spaces_matter}:{remembered}"
    if not hasattr(kept, name):
        setattr(kept, name, PieceEncoder(path, spaces_matter, remembered))
    return getattr(kept, name)


def forget_encoder(path: str, spaces_matter: bool = True, remembered: int = REMEMBERED) -> None:
    """Gives back the memory of this Python worker's encoder, where nothing else refers to it."""
    vars(sys.modules.get("kept_piece_encoders", types)).pop(f"{path}:{spaces_matter}:{remembered}", None)
    release_memory()


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after every text."""
    out = np.insert(ids, bounds[1:], np.uint32(end_id))
    return out, bounds + np.arange(len(bounds))


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
