"""Personal data: patterns against plain regular expressions, the field against adding up every labelling."""

import hashlib
import random
import re
import time
from itertools import product

import numpy as np
import pytest

from sievegate.llm import arrays, queries
from sievegate.llm.personal import KINDS, Field, base_spans, find_personal_data, fit_field, tokens_of, train

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, c in enumerate(number[::-1]):
        d = int(c) * (2 if i % 2 else 1)
        total += d // 10 + d % 10
    return total % 10 == 0


def plain(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), rank, kind, m.end()))
    return sorted(found)


def odd_texts():
    rng = random.Random(6)
    parts = ["a", "b.c", "@", "@x.y", ".", "..", "1", "23", "255", "256", "0", "4111111111111111", "4111 1111-1111 1111", " ", " ", "-",
             "+", "+1", "(", ")", "é", "漢", "\n", "%", "_", "555-1234", "x@y", "10.0.0.1", "٣", "²"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    return texts + ["", None, "@", "a@", "a@b", "a@b.c@d.e", "a@b@c.d", "a@b.c..d", "1.2.3.4.5.6.7.8.9", "01.002.3.0255"]


@pytest.fixture(scope="module")
def fitted(spark):
    return fit_field(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_base_equals_plain_patterns(spark, rows_of, fitted):
    texts = odd_texts()
    got = {r.doc_id: r for r in find_personal_data(rows_of(list(enumerate(texts))), fitted).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        base = [tuple(s) for s in got[i].base]
        assert base == plain(text), repr(text)
        spans = [tuple(s) for s in got[i].spans]
        more = [s for s in spans if s[1] >= len(KINDS)]
        assert sorted([*base, *more]) == spans and all(s[2] == "field_" + KINDS[s[1] - 4] for s in more)
        assert all(a[3] <= b[0] or b[3] <= a[0] for a in more for b in spans if a != b)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.op13_personal_data(spark, folder).collect()
    assert len(got) == len(docs)
    for r in got:
        want = plain(docs[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for a, _, k, b in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == i for s in want) for i in range(4)]
        if not want and not re.search("[0-9@]", docs[r.doc_id] or ""):
            assert r.spans == ""


def tokens(text):
    return tokens_of(*arrays.text_bytes(__import__("pyarrow").array([text])))


def exact(field, found):
    """Probabilities by adding up every labelling."""
    alone = field.unary[found.features].sum(axis=1)
    near = [(i, i + 1) for i in np.flatnonzero(found.follows)]
    n, labels = alone.shape
    out = np.zeros((n, labels))
    for labelling in product(range(labels), repeat=n):
        score = sum(alone[i, y] for i, y in enumerate(labelling))
        score += sum(field.chain[labelling[a], labelling[b]] for a, b in near)
        score += sum(field.skip[labelling[a], labelling[b]] for a, b in found.skips)
        for i, y in enumerate(labelling):
            out[i, y] += np.exp(score)
    return out / out.sum(axis=1, keepdims=True)


def random_field(seed, size=1.0):
    rng = np.random.default_rng(seed)
    base = train([])
    return Field(*(rng.normal(0, size, x.shape) for x in (base.unary, base.chain, base.skip)))


@pytest.mark.parametrize("text", ["a1 b2 c3 d4", "x9 and 12345 then x77 12345", "77777777 some words 7777-7777 and (77777777)", "1 2"])
def test_messages_equal_adding_up_on_trees(text):
    found, field = tokens(text), random_field(len(text))
    assert np.allclose(field.probabilities(found), exact(field, found))


def test_messages_come_near_on_loops():
    found, field = tokens("12345 67890 x 12345 67890"), random_field(3, 0.4)
    assert len(found.skips) == 2 and found.follows.sum() == 2
    assert np.abs(field.probabilities(found, 50) - exact(field, found)).max() < 0.02


def test_repeats_share_their_label(fitted):
    """A number that is a telephone at one place is one at another, far away, without its country code."""
    text = "Please call +44 207 555 0199 soon. " + "More plain words here. " * 50 + "Again: {}"
    same, other = (tokens(text.format(x)) for x in ("555-0199.", "555-0188."))
    with_same, with_other = tokens("call +1 (499) 555-6503 " + "w " * 400 + "or 555-6503"), tokens("call +1 (499) 555-6503 " + "w " * 400 + "or 555-6777")
    assert len(with_same.skips) == 1 and not len(with_other.skips)
    phone = KINDS.index("phone") + 1
    assert fitted.probabilities(with_same)[-1, phone] > fitted.probabilities(with_other)[-1, phone]
    assert len(same.begins) == len(other.begins)


def test_the_field_finds_what_the_patterns_miss(rows_of, fitted):
    text = "ntsh is onntes a thhees. +1 (605) 555-9305 4078918989542222 On thwh hawh."
    (row,) = find_personal_data(rows_of([(1, text)]), fitted).collect()
    assert not row.base and [(text[s.start : s.end], s.kind) for s in row.spans] == [
        ("+1 (605) 555-9305", "field_phone"), ("4078918989542222", "field_card")
    ]


def test_training_is_reproducible_and_needs_no_rows(spark, rows_of, fitted):
    again = fit_field(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(7))
    assert all((a == b).all() for a, b in zip((fitted.unary, fitted.chain, fitted.skip), (again.unary, again.chain, again.skip), strict=True))
    none = fit_field(rows_of([(1, "no numbers"), (2, None)]))
    docs = rows_of([(1, "a 12 b"), (1, "a 12 b"), (None, "x@y.zz"), (2, None), (3, "")])
    got = sorted((r.doc_id is None, r.doc_id, len(r.base), len(r.spans)) for r in find_personal_data(docs, none).collect())
    assert got == [(False, 1, 0, 0), (False, 1, 0, 0), (False, 2, 0, 0), (False, 3, 0, 0), (True, None, 1, 1)]
    assert find_personal_data(docs.limit(0), none).count() == 0


def test_long_texts_take_linear_time(rows_of, fitted):
    texts = ["a@" * 1_000_000, "x" * 3_000_000 + "@", "1" * 3_000_000, "1." * 1_500_000, "+" + "1 " * 1_500_000, "b@c.d " * 300_000]
    started = time.monotonic()
    got = {r.doc_id: len(r.base) for r in find_personal_data(rows_of(list(enumerate(texts))), fitted).collect()}
    assert time.monotonic() - started < 60
    assert got[5] == 300_000 and got[3] == 375_000 and got[0] == got[1] == got[2] == got[4] == 0


def test_base_spans_of_nothing():
    assert base_spans(np.zeros(0, np.uint8), np.zeros(1, np.int64)).shape == (0, 3)
