"""Phrase mining against counting every phrase, and the filters that count."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from sievegate.llm.phrases import CountingFilter, Permutation, mine_phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, longest=5, least=100, most=2000):
    """(lang, rank, phrase, a, l, r, n, score) of rows of (text, lang)."""
    counts, sizes = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for size in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    found = {key: a for key, a in counts.items() if a >= least and len(key[1]) > 1}
    held = set()
    for (lang, words), a in found.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if j - i < len(words) and a >= counts[lang, words[i:j]]:
                    held.add((lang, words[i:j]))
    rows = []
    for (lang, words), a in found.items():
        if (lang, words) in held:
            continue
        n, cuts = sizes[lang], []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * n // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        rows.append((lang, -score, -a, " ".join(words).encode(), left, right, n))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right, n in sorted(rows):
        rank[lang] += 1
        if rank[lang] <= most:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, n, -score))
    return out


def frame_of(spark, rows, partitions=3):
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "text string, lang string, block long, n long, phrase long")
    return frame.repartition(partitions)


def odd_rows():
    rng = random.Random(3)
    words = ["The", "the", "New", "york", "é", "É", "to be", "\x1c", "x", "y", "漢", "a", "b"]
    ends = [" ", " ", " ", " ", "  ", "\t", ", ", ".", "\n", "!", "\r\n", " ; "]
    rows = [
        ("".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 60))), rng.choice(["en", "fr", None]))
        for _ in range(300)
    ]
    rows += [("york new york new york", "en")] * 40 + [("", "de"), (None, None), (" \t ", "de"), ("x " * 3000, "long")]
    return rows + [("New York City is big", "en")] * 120 + [("und here", "und"), ("one of a kind", None)] * 100


@pytest.mark.parametrize("least, longest, most", [(100, 5, 2000), (3, 4, 10)])
def test_equals_counting_every_phrase(spark, least, longest, most):
    rows = odd_rows()
    got = mine_phrases(frame_of(spark, rows), longest, least, most).collect()
    want = plain(rows, longest, least, most)
    assert want and sorted(map(tuple, got)) == sorted(want)


def test_no_rows_and_no_words(spark):
    frame = frame_of(spark, [("", "en"), (None, None)])
    assert mine_phrases(frame).count() == 0 and mine_phrases(frame.limit(0)).count() == 0


def test_scores_beyond_64_bits(spark):
    from sievegate.llm.phrases import scored

    big = 3 * 10**12
    phrases = spark.createDataFrame(
        [("en", ["a"], "a", big), ("en", ["b"], "b", big + 7), ("en", ["a", "b"], "a b", big - 1)],
        "lang string, words array<string>, phrase string, a long",
    )
    sizes = spark.createDataFrame([("en", 9 * 10**14)], "lang string, n long")
    (row,) = scored(phrases, sizes).collect()
    assert row.score == 1000 * (big - 1) * 9 * 10**14 // (big * (big + 7)) and (row.l, row.r) == (big, big + 7)


@pytest.mark.parametrize("bits", [1, 2, 7, 8, 13, 33, 40, 63, 64])
def test_filters_lose_nothing(bits):
    rng = np.random.default_rng(bits)
    filters, sums = [], Counter()
    for size in (0, 1, 5, 700):
        keys = np.unique(rng.integers(0, 2**bits, size, dtype=np.uint64, endpoint=False)) if bits < 64 else np.unique(
            rng.integers(0, 2**64 - 1, size, dtype=np.uint64)
        )
        counts = rng.choice([1, 2, 254, 255, 256, 2**40], len(keys))
        filters.append(CountingFilter(keys, counts, bits))
        sums.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
    again = [CountingFilter.unpack(f.pack()) for f in filters]
    for f, g in zip(filters, again, strict=True):
        assert f.keys.tolist() == g.keys.tolist() and f.counts.tolist() == g.counts.tolist()
    whole = CountingFilter.merged(again)
    assert dict(zip(whole.keys.tolist(), whole.counts.tolist(), strict=True)) == dict(sums)
    assert (np.diff(whole.keys.astype(object)) > 0).all()


@pytest.mark.parametrize("bits", [1, 2, 3, 8, 12, 31, 64])
def test_permutation_has_an_inverse(bits):
    permutation = Permutation(bits)
    values = np.arange(min(1 << bits, 4096), dtype=np.uint64)
    if bits > 12:
        values = np.random.default_rng(1).integers(0, 2**bits - 1, 4096, dtype=np.uint64)
    mapped = permutation(values)
    assert (permutation.inverse(mapped) == values).all() and int(mapped.max()) < 1 << bits
    assert len(np.unique(mapped)) == len(np.unique(values))


def test_a_text_of_ten_megabytes(spark):
    rows = [("some very long text " * 500_000, "en"), ("short one", "en")]
    got = {r.phrase: r for r in mine_phrases(frame_of(spark, rows, 1), 5, 100).collect()}
    assert got["some very long text some"].a == 499_999 and got["some very long text some"].n == 2_000_002
