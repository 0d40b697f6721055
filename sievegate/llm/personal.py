"""Personal data: fixed patterns, and a skip-chain conditional random field over the tokens near them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievegate.llm import arrays
from sievegate.llm.shared import drop, stored

#: Kinds of spans, in their order; the field's labels are "no entity" (0) and these (1 to 4).
KINDS = ("email", "ip", "card", "phone")
#: Spans that only the field finds carry this prefix and come after the base kinds.
PREFIX = "field_"
# What the base patterns accept.
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(rb"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

#: Documents whose base spans train the field, and tokens of each: bounds at any input size.
SAMPLE_DOCUMENTS, SAMPLE_TOKENS = 1_000, 200
#: Rounds of message passing, and the probability from which a token counts as an entity.
ROUNDS, THRESHOLD = 8, 0.9
#: Steps of the weights' ascent on the pseudo-likelihood, its rate and the pull towards zero.
STEPS, RATE, SHRINK = 600, 5.0, 1e-4
#: How much equal or similar tokens rather agree before any example is seen.
AGREE = 2.0
_EXAMPLE = ["features", "labels", "follows", "skips"]
_SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"
_DIGITS = np.zeros(256, bool)
_DIGITS[48:58] = True


def _member(alphabet: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(alphabet, np.uint8)] = True
    return table


_IN_EMAIL, _IN_IP = _member(_LOCAL + b"@"), _member(b"0123456789.")
_IN_CARD, _IN_PHONE = _member(b"0123456789 -"), _member(b"0123456789 ().-+")


def _runs(data: np.ndarray, offsets: np.ndarray, allowed: np.ndarray, needed: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of allowed bytes within one text that hold a needed one."""
    inside = allowed[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[heads] = inside[heads]
    begins = np.flatnonzero(opens)
    if not len(begins):
        return []
    stops = ~inside
    stops[heads] = True
    stops = np.append(np.flatnonzero(stops), len(data))
    ends = stops[np.searchsorted(stops, begins, side="right")]
    hits = np.concatenate([[0], np.cumsum(needed)])
    some = hits[ends] > hits[begins]
    return list(zip(begins[some].tolist(), ends[some].tolist(), strict=True))


def _emails(run: bytes) -> Iterator[tuple[int, int]]:
    """Leftmost matches without overlap, in one pass: every @ with what may stand before and behind it."""
    free = 0  # the first byte that a local part may take
    at = run.find(b"@")
    while at >= 0:
        found = _DOMAIN.match(run, at + 1) if at > free else None
        if found:
            yield free, found.end()
        free = found.end() if found else at + 1
        at = run.find(b"@", free)


def _ips(run: bytes) -> Iterator[tuple[int, int]]:
    for chain in _DOTTED.finditer(run):
        at, groups = chain.start(), chain.group().split(b".")
        for i in range(0, len(groups) - 3, 4):
            size = sum(map(len, groups[i : i + 4])) + 3
            if all(len(g.lstrip(b"0")) <= 3 and int(g.lstrip(b"0") or b"0") <= 255 for g in groups[i : i + 4]):
                yield at, at + size
            at += size + 1


def _luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = (c - 48) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _cards(run: bytes) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(run):
        digits = found.group().translate(None, b" -")
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and _luhn(digits):
            yield found.span()


def _phones(run: bytes) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(run):
        digits = len(found.group().translate(None, b" ().-+"))
        if PHONE_DIGITS[0] <= digits <= PHONE_DIGITS[1]:
            yield found.span()


def base_spans(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows (start, end, rank) in bytes of all matches of the fixed patterns, by start, then kind.

    A match lies within a run of bytes that its pattern knows, so only runs with an ``@``, a digit
    or a ``+`` are looked at. Every pattern is matched in time linear in its run.
    """
    digit = _DIGITS[data]
    looks = (
        (_IN_EMAIL, data == 64, _emails), (_IN_IP, digit, _ips), (_IN_CARD, digit, _cards),
        (_IN_PHONE, data == 43, _phones),
    )
    found = [
        (lo + a, lo + b, rank)
        for rank, (allowed, needed, matches) in enumerate(looks)
        if needed.any()
        for lo, hi in _runs(data, offsets, allowed, needed)
        for a, b in matches(data[lo:hi].tobytes())
    ]
    found.sort(key=lambda span: (span[0], span[2]))
    return np.array(found, np.int64).reshape(-1, 3)


@dataclass
class Tokens:
    """The tokens that may be part of an entity: maximal runs without white space that hold a digit or an ``@``.

    All other tokens are no entity for certain. They cut the chain, so that only their effect on
    the tokens next to them is left (in the features), and the field is as small as the numbers and
    addresses of a text.
    """

    begins: np.ndarray
    ends: np.ndarray
    document: np.ndarray
    features: np.ndarray  # a row of feature numbers for each token
    follows: np.ndarray  # the next token stands directly behind, with a blank between
    skips: np.ndarray  # rows (a, b): a token and the next one of its document that is equal or similar


_TRIM_LEFT, _TRIM_RIGHT = b"\"'([{<*#$%&|", b"\"')]}>*#$%&|.,;:!?"
#: Features of a token: its value in each of these has a weight for every label.
_BOUNDS = (17, 6, 4, 4, 2, 2, 2, 4, 3, 3)
N_FEATURES = sum(_BOUNDS) + 1
_FIRST = np.cumsum((1, *_BOUNDS[:-1]))  # number 0 is the constant


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    space = (data == 32) | ((data >= 9) & (data <= 13))
    needed = _DIGITS[data] | (data == 64)
    allowed = ~space
    runs = _runs(data, offsets, _member(bytes(set(range(256)) - set(arrays.SPACES))), needed) if len(data) else []
    spans, shapes, keys = [], [], []
    for lo, hi in runs:
        raw = data[lo:hi].tobytes()
        core = raw.lstrip(_TRIM_LEFT)
        lo = hi - len(core)
        core = core.rstrip(_TRIM_RIGHT)
        hi = lo + len(core)
        digits = core.translate(None, _NOT_DIGITS)
        n, dots, at = len(digits), core.count(b"."), core.find(b"@")
        plain = len(core) == n
        kind = 0 if plain else 3 if core.isalnum() else 2 if not core.translate(None, b"0123456789.()+-") else 1
        mail = (at >= 0) + (at > 0 and b"." in core[at:]) + (core.count(b"@") > 1)
        edge = (core[:1] == b"+") + 2 * (raw[:1] == b"(")
        shapes.append((min(n, 16), min(dots, 5), mail, edge, plain, b"-" in core, len(core) > 64, kind))
        spans.append((lo, hi))
        keys.append(digits if n >= 6 and len(core) - n <= 6 else core.lower())
    spans_ = np.array(spans, np.int64).reshape(-1, 2)
    begins, ends = spans_[:, 0], spans_[:, 1]
    n = len(begins)
    document = np.searchsorted(offsets, begins, side="right") - 1 if n else np.zeros(0, np.int64)
    follows = np.zeros(n, bool)
    if n:
        solid = np.concatenate([[0], np.cumsum(allowed)])
        raw_begins, raw_ends = (np.array([r[i] for r in runs], np.int64) for i in (0, 1))
        gap = raw_begins[1:] - raw_ends[:-1]
        follows[:-1] = (document[1:] == document[:-1]) & (solid[raw_begins[1:]] == solid[raw_ends[:-1]]) & (gap == 1)
    before = np.concatenate([[False], follows[:-1]]) if n else follows
    shape = np.array(shapes, np.int64).reshape(-1, 8)
    shape = np.column_stack([shape, follows * 1 + (shape[:, 0] > 2) * follows, before * 1 + (shape[:, 0] > 2) * before])
    features = np.column_stack([np.zeros(n, np.int64), shape + _FIRST])
    last: dict[tuple[int, bytes], int] = {}
    skips = []
    for i, (d, key) in enumerate(zip(document.tolist(), keys, strict=True)):
        j = last.get((d, key))
        if j is not None and len(key) >= 4:
            skips.append((j, i))
        last[d, key] = i
    return Tokens(begins, ends, document, features, follows, np.array(skips, np.int64).reshape(-1, 2))


_NOT_DIGITS = bytes(set(range(256)) - set(range(48, 58)))


@dataclass(frozen=True)
class Field:
    """Weights of the field: of every feature by label, of neighbouring labels, and of labels joined by a skip."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def probabilities(self, tokens: Tokens, rounds: int = ROUNDS) -> np.ndarray:
        """Probability of every label of every token, by loopy sum-product message passing.

        Edges join neighbouring tokens and, over any distance, equal or similar tokens of a
        document. All messages of a round are computed at once from those of the round before; on
        texts without skips this is exact as soon as the rounds reach the length of a chain.
        """
        alone = self.unary[tokens.features].sum(axis=1)
        near = np.flatnonzero(tokens.follows)
        pairs = np.concatenate([np.column_stack([near, near + 1]), tokens.skips])
        n, labels = alone.shape
        if not len(pairs):
            return _softmax(alone)
        tables = np.concatenate(
            [np.broadcast_to(self.chain, (len(near), labels, labels)),
             np.broadcast_to(self.skip, (len(tokens.skips), labels, labels))]
        )
        forward, backward = np.zeros((len(pairs), labels)), np.zeros((len(pairs), labels))
        for _ in range(rounds):
            belief = alone.copy()
            np.add.at(belief, pairs[:, 1], forward)
            np.add.at(belief, pairs[:, 0], backward)
            # what a token tells the other one leaves out what it was told by it
            there = _logsum((belief[pairs[:, 0]] - backward)[:, :, None] + tables, 1)
            back = _logsum((belief[pairs[:, 1]] - forward)[:, None, :] + tables, 2)
            forward, backward = there - there.max(axis=1, keepdims=True), back - back.max(axis=1, keepdims=True)
        belief = alone
        np.add.at(belief, pairs[:, 1], forward)
        np.add.at(belief, pairs[:, 0], backward)
        return _softmax(belief)


def _logsum(values: np.ndarray, axis: int) -> np.ndarray:
    most = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - most).sum(axis=axis)) + most.squeeze(axis)


def _softmax(values: np.ndarray) -> np.ndarray:
    values = np.exp(values - values.max(axis=1, keepdims=True))
    return values / values.sum(axis=1, keepdims=True)


def labels_of(tokens: Tokens, spans: np.ndarray) -> np.ndarray:
    """The label of every token that a base span touches, else 0; of several the first one counts."""
    labels = np.zeros(len(tokens.begins), np.int64)
    for start, end, rank in spans[::-1]:
        lo = np.searchsorted(tokens.ends, start, side="right")
        hi = np.searchsorted(tokens.begins, end, side="left")
        labels[lo:hi] = rank + 1
    return labels


def train(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> Field:
    """Weights that make labels likely given the labels around them (pseudo-likelihood), by gradient ascent.

    ``parts`` hold features, labels, ``follows`` and skips of the tokens of a document each. Rare
    labels weigh as much as frequent ones. Weights are pulled towards a start at which nothing is an
    entity and joined tokens rather agree.
    """
    n_labels = len(KINDS) + 1
    unary, chain = np.zeros((N_FEATURES, n_labels)), np.zeros((n_labels, n_labels))
    unary[0, 0], skip = 2.0, AGREE * np.eye(n_labels)
    first = unary, chain, skip
    starts = np.concatenate([[0], np.cumsum([len(p[1]) for p in parts])]).astype(np.int64)
    n = int(starts[-1])
    if not n:
        return Field(*first)
    features, labels = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    near = np.concatenate([np.flatnonzero(p[2]) + s for p, s in zip(parts, starts, strict=False)])
    skips = np.concatenate([p[3] + s for p, s in zip(parts, starts, strict=False)])
    held = np.zeros((n, N_FEATURES), np.float32)
    np.put_along_axis(held, features, 1, axis=1)
    one_hot = np.eye(n_labels)[labels]
    counts = np.bincount(labels, minlength=n_labels)
    weight = (1 / np.maximum(counts, 1))[labels] / (counts > 0).sum()
    edges = [(near, near + 1), (skips[:, 0], skips[:, 1])]
    for _ in range(STEPS):
        score = held @ unary
        for table, (a, b) in zip((chain, skip), edges, strict=True):
            np.add.at(score, a, table.T[labels[b]])
            np.add.at(score, b, table[labels[a]])
        rest = (one_hot - _softmax(score)) * weight[:, None]
        steps = [held.T @ rest]
        for a, b in edges:
            # a table's rows are the labels of the first token, its columns those of the second
            steps.append(one_hot[a].T @ rest[b] + rest[a].T @ one_hot[b])
        pulled = zip((unary, chain, skip), steps, first, strict=True)
        unary, chain, skip = (w + RATE * (step - SHRINK * (w - start)) for w, step, start in pulled)
    return Field(unary, chain, skip)


def fit_field(
    docs: DataFrame, most: int = SAMPLE_DOCUMENTS, id_column: str = "doc_id", text_column: str = "text"
) -> Field:
    """The field trained on the base spans of the documents of at most ``most`` ids, chosen by a hash.

    Of a document the first ``SAMPLE_TOKENS`` tokens with a digit or an ``@`` count, so what comes
    to the driver is bounded: the features and labels of these tokens. Documents without an id
    are not chosen.
    """

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data, offsets = arrays.text_bytes(batch.column("text").slice(i, 1))
                tokens = tokens_of(data, offsets)
                labels = labels_of(tokens, base_spans(data, offsets))[:SAMPLE_TOKENS]
                skips = tokens.skips[(tokens.skips < len(labels)).all(axis=1)]
                follows = tokens.follows[: len(labels)].copy()
                follows[-1:] = False
                columns = (
                    tokens.features[: len(labels)].astype(np.int16), labels.astype(np.int8), follows, skips,
                )
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in columns], _EXAMPLE)

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    rows = rows.filter(F.col("text").rlike("[0-9@]"))
    ids = rows.select("id").filter("id IS NOT NULL").distinct()
    chosen = stored(ids.orderBy(F.xxhash64("id", F.lit("field")), "id").limit(most), "chosen")
    found = rows.join(chosen, "id", "left_semi").select("text")
    found = found.mapInArrow(examples, ", ".join(f"{c} binary" for c in _EXAMPLE)).toArrow().to_pylist()
    drop(chosen)
    # in an order of their own, so that sums come out alike in every run
    found = sorted([r[c] for c in _EXAMPLE] for r in found)
    return train(
        [
            (
                np.frombuffer(features, np.int16).reshape(-1, len(_BOUNDS) + 1).astype(np.int64),
                np.frombuffer(labels, np.int8).astype(np.int64), np.frombuffer(follows, bool),
                np.frombuffer(skips, np.int64).reshape(-1, 2),
            )
            for features, labels, follows, skips in found
        ]
    )


def field_spans(data: np.ndarray, tokens: Tokens, field: Field, base: np.ndarray, threshold: float) -> np.ndarray:
    """Rows (start, end, rank) of runs of neighbouring tokens with one label that touch no base span."""
    if not len(tokens.begins):
        return np.zeros((0, 3), np.int64)
    probability = field.probabilities(tokens)
    label = probability.argmax(axis=1)
    label[probability.max(axis=1) < threshold] = 0
    joined = tokens.follows[:-1] & (label[1:] == label[:-1])
    heads = np.flatnonzero(np.concatenate([[True], ~joined]) & (label > 0))
    tails = np.flatnonzero(np.concatenate([~joined, [True]]) & (label > 0))
    spans = np.column_stack([tokens.begins[heads], tokens.ends[tails], label[heads] - 1 + len(KINDS)])
    spans = spans[spans[:, 0] < spans[:, 1]]
    if len(base):
        # base spans by start, with the furthest end up to each
        furthest = np.maximum.accumulate(base[:, 1])
        at = np.searchsorted(base[:, 0], spans[:, 1], side="left") - 1
        spans = spans[(at < 0) | (furthest[np.maximum(at, 0)] <= spans[:, 0])]
    return spans


def find_personal_data(
    docs: DataFrame, field: Field, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, base, spans``: sorted arrays of (start, rank, kind, end) for every document.

    ``base`` holds the leftmost matches without overlap of the fixed patterns: addresses, IPv4
    numbers, cards with a right check digit and international telephone numbers. ``spans`` adds
    those of the field: tokens that the patterns miss and that look like an entity, stand beside
    one, or are repeated from or similar to another place of the document, so that an entity
    keeps its label wherever it occurs (kinds ``field_email`` and so on). They touch no base span.
    Places count code points, ends are exclusive.

    A null or empty text has no spans. Rows are judged one by one, so repeated rows get equal
    results; a null id stays null. Time is linear in a text of any length. An empty table gives no
    rows. Other columns are ignored. Nothing is shuffled.
    """
    names = [*KINDS, *(PREFIX + k for k in KINDS)]
    kind = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.chunks_of(batch, "text"):
                data, offsets = arrays.text_bytes(part.column("text"))
                base, tokens = base_spans(data, offsets), tokens_of(data, offsets)
                every = np.concatenate([base, field_spans(data, tokens, field, base, threshold)])
                # code points before each byte of interest, counted from the start of its text
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                n = part.num_rows
                out = {"doc_id": part.column("id")}
                for name, rows in (("base", base), ("spans", every)):
                    document = np.searchsorted(offsets, rows[:, 0], side="right") - 1
                    local = rows.copy()
                    local[:, 0] = points[rows[:, 0]] - points[offsets[document]]
                    local[:, 1] = points[rows[:, 1]] - points[offsets[document]]
                    order = np.lexsort((rows[:, 2], rows[:, 0]))
                    counts = np.bincount(document, minlength=n)
                    local = local[order]
                    fields = [
                        pa.array(local[:, 0], pa.int32()), pa.array(local[:, 2], pa.int32()),
                        pa.array([names[r] for r in local[:, 2].tolist()], pa.string()), pa.array(local[:, 1], pa.int32()),
                    ]
                    values = pa.StructArray.from_arrays(fields, fields=list(kind))
                    ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                    out[name] = pa.ListArray.from_arrays(ends, values)
                yield pa.RecordBatch.from_pydict(out)

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return source.mapInArrow(find, f"doc_id long, base {_SPANS}, spans {_SPANS}")
