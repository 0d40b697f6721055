"""Repeated windows and strings against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest

from sievegate.llm.suffix_dedup import remove_repeated_strings
from sievegate.llm.substring_dedup import remove_repeated_windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def spans_of(flags):
    return sum(1 for i, f in enumerate(flags) if f and not (i and flags[i - 1]))


def brute(sequences, length):
    """(n, removed flags) of each sequence."""
    seen = Counter(tuple(s[i : i + length]) for s in sequences for i in range(len(s) - length + 1))
    for s in sequences:
        flags = [False] * len(s)
        for i in range(len(s) - length + 1):
            if seen[tuple(s[i : i + length])] > 1:
                flags[i : i + length] = [True] * length
        yield s, flags


def corpus():
    random.seed(5)
    vocabulary = [f"w{i}é" for i in range(60)] + ["a b", "x y"]
    fresh = lambda n: [random.choice(vocabulary) for _ in range(n)]
    passage, long_passage = fresh(35), fresh(260)
    texts = [" ".join(fresh(random.randint(0, 120))) for _ in range(20)]
    texts += [" ".join(fresh(30) + passage + fresh(9)), "\t".join(passage), "\n ".join(fresh(3) + passage[:-1])]
    texts += [" ".join(fresh(50) + long_passage[20:200] + fresh(20)), " ".join(long_passage)]
    texts += [" ".join(long_passage[:90] + ["edit"] + long_passage[91:])] * 3
    texts += ["same " * 90, "same " * 90, "", None, "   ", " lead", "z" * 399, "z" * 199]
    return texts


def check_windows(frame, texts, window):
    got = {r.doc_id: r for r in remove_repeated_windows(frame, window).collect()}
    assert len(got) == len(texts)
    for i, (words, flags) in enumerate(brute([WORD.findall(t or "") for t in texts], window)):
        kept = " ".join(w for w, f in zip(words, flags, strict=True) if not f)
        want = (len(words), sum(flags), spans_of(flags), hashlib.sha256(kept.encode()).hexdigest(), kept)
        r = got[i]
        assert (r.n_words, r.n_removed, r.n_spans, r.kept_sha256, r.kept_text) == want, i


def check_strings(frame, texts, length):
    got = {r.doc_id: r for r in remove_repeated_strings(frame, length).collect()}
    assert len(got) == len(texts)
    for i, (data, flags) in enumerate(brute([(t or "").encode() for t in texts], length)):
        kept = bytes(b for b, f in zip(data, flags, strict=True) if not f)
        want = (len(data), sum(flags), spans_of(flags), hashlib.sha256(kept).hexdigest(), kept)
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept_bytes)) == want, i


@pytest.mark.parametrize("window", [35, 7])
def test_windows_equal_brute_force(rows_of, window):
    texts = corpus()
    check_windows(rows_of(list(enumerate(texts))), texts, window)


@pytest.mark.parametrize("length", [200, 150])
def test_strings_equal_brute_force(rows_of, length):
    texts = corpus()
    check_strings(rows_of(list(enumerate(texts)), 2), texts, length)


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    check_windows(docs.repartition(5), texts, 35)
    check_strings(docs.repartition(5), texts, 200)


def test_repeated_rows_and_no_rows(rows_of):
    text = " ".join(f"n{i}" for i in range(50))
    twice = rows_of([(4, text), (4, text), (None, "short")])
    assert sorted(r.n_removed for r in remove_repeated_windows(twice).collect()) == [0, 50, 50]
    removed = len(text.encode()) if len(text) >= 200 else 0
    assert sorted(r.n_removed for r in remove_repeated_strings(twice).collect()) == [0, removed, removed]
    assert remove_repeated_windows(twice.limit(0)).count() == 0
    assert remove_repeated_strings(twice.limit(0)).count() == 0


def thue_morse(first, second, n=32):
    order = [bin(i).count("1") % 2 for i in range(n)]
    return [[(first, second)[x ^ flip] for x in order] for flip in (0, 1)]


def test_structured_words_that_occur_once_stay(rows_of):
    """Such orders collide under any polynomial modulo a power of two."""
    one, other = thue_morse("4a130e", "594a7c")
    rows = [(i, " ".join([*words, "three", "shared", "words"])) for i, words in enumerate((one, other))]
    assert [r.n_removed for r in remove_repeated_windows(rows_of(rows)).collect()] == [0, 0]


def test_structured_bytes_that_occur_once_stay(rows_of):
    one, other = thue_morse("P45e", "iQqB")
    rows = [(i, "xy"[i] + "".join(blocks) + "t" * 72) for i, blocks in enumerate((one, other))]
    assert all(len(text) == 201 for _, text in rows)
    assert [r.n_removed for r in remove_repeated_strings(rows_of(rows)).collect()] == [0, 0]
