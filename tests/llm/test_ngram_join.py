"""Jaccard classes against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from sievegate.llm import ngram_join, repeats
from sievegate.llm.components import roots

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def set_of(text, size=3):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, words=3, link=90):
    sets = [set_of(text, words) for _, text in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= link * max(len(a), len(b)) and 100 * len(a & b) >= link * len(a | b):
                parent[top(i)] = top(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in (smallest.get(top(i)), doc_id) if x is not None]
        smallest[top(i)] = min(known) if known else None
    key = lambda r: tuple((x is None, x or 0) for x in r)
    return sorted(((d, len(sets[i]), smallest[top(i)]) for i, (d, _) in enumerate(rows)), key=key), key


def check(frame, rows):
    want, key = brute(rows)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join_classes(frame).collect()]
    assert sorted(got, key=key) == want


def edited(words, n, rng):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("frequent", [6, 2])
def test_classes_equal_brute_force(rows_of, monkeypatch, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    if frequent == 2:
        monkeypatch.setattr(ngram_join, "TILE_ROWS", 7)
        monkeypatch.setattr(ngram_join, "TASK_ROWS", 50)
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)]
    fresh = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = [" ".join(fresh(rng.randint(0, 200))) for _ in range(60)]
    for size in (12, 40, 90, 300):
        base = fresh(size)
        texts += [" ".join(base).upper(), "\n".join(base)]
        texts += [" ".join(edited(base, rng.randint(1, max(1, size // 45)), rng)) for _ in range(30)]
        chain = base
        for _ in range(8):  # neighbours link, the ends do not
            chain = chain[max(1, size // 25) :] + [f"c{rng.randrange(10**6)}"] * max(1, size // 25)
            texts.append(" ".join(chain))
    line = fresh(12)
    texts += [" ".join(line + fresh(rng.randint(5, 60))) for _ in range(90)]
    texts += ["a b", "A b", "b a", "a", "a", "", "", None, " x y z ", "x  Y z", "É b c", "é b c"]
    texts += [" ".join(vocabulary[:11]), " ".join(vocabulary[:12]), " ".join(vocabulary[1:12])]
    rows = list(enumerate(texts)) + [(3, texts[70]), (3, "something else"), (None, texts[70]), (None, "no id at all")]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    check(rows_of(shuffled, 4), shuffled)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(4)
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_no_rows_and_nothing_to_link(rows_of):
    frame = rows_of([(1, "one two three four"), (2, None)])
    assert ngram_join.join_classes(frame.limit(0)).count() == 0
    check(frame, [(1, "one two three four"), (2, None)])


def test_roots_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (300, 200), (250, 300)]
    got = {r.node: r.root for r in roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(1, 30))
    assert got[300] == got[250] == got[200] == 200


def linked_sets(rng, link):
    """Two sets of hashes as different as two sets that link may be."""
    n = rng.randint(1, 60)
    shared = [rng.getrandbits(64) for _ in range(n)]
    spare = 100 * n // link - n
    own = rng.randint(0, spare)
    a = shared + [rng.getrandbits(64) for _ in range(own)]
    return a, shared + [rng.getrandbits(64) for _ in range(spare - own)]


@pytest.mark.parametrize("link", [80, 90])
def test_sets_that_link_share_a_signature(link):
    rng = random.Random(link)

    def signed(members):
        hashes = np.sort(np.array(members, np.uint64))
        n, levels = len(hashes), np.full(len(hashes), ngram_join.FREQUENT)
        allowed = ngram_join.fewest_missing(n, link)
        return set(ngram_join.signatures(hashes, levels, allowed, ngram_join.bands_of(n, link)))

    for _ in range(5000):
        a, b = linked_sets(rng, link)
        assert set(a) == set(b) or signed(a) & signed(b), (len(a), len(b))


@pytest.mark.parametrize("frequent", [6, 1])
def test_five_words_at_four_fifths(rows_of, monkeypatch, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    rng = random.Random(5)
    texts = []
    for size in [*range(5, 22), 40, 100, 260]:
        base = [f"s{size}w{i}" for i in range(size)]
        texts += [" ".join(base), " ".join(base[1:]), " ".join(["new", *base]), " ".join(base[:-2])]
        texts += [" ".join(edited(base, rng.randint(1, max(1, size // 30)), rng)) for _ in range(4)]
    rows = list(enumerate(texts))
    sets = []
    for text in texts:
        words = text.split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if label[i] != label[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    got = ngram_join.join_classes(rows_of(rows), words=5, link=80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [
        (i, len(s), label[i]) for i, s in enumerate(sets)
    ]


@pytest.mark.parametrize("link", [80, 90])
def test_a_very_long_text_in_many_copies_has_no_more_signatures_than_shingles(link):
    rng = np.random.default_rng(3)
    base, own = rng.integers(0, 2**64, 20_000, np.uint64), rng.integers(0, 2**64, 800, np.uint64)
    near = np.concatenate([base[400:], own[:400]])

    def signed(members):
        hashes = np.unique(members)
        n, levels = len(hashes), np.full(len(hashes), ngram_join.FREQUENT)
        allowed = ngram_join.fewest_missing(n, link)
        return ngram_join.signatures(hashes, levels, allowed, ngram_join.bands_of(n, link))

    a, b = signed(base), signed(near)
    assert len(a) <= len(base) and len(b) <= len(near) and set(a) & set(b)


ODD_TEXTS = ["Été a b c", None, "", "x " * 40, "日本 \n", None, "end"]


def test_texts_come_back_from_the_body(rows_of):
    rows = rows_of([*enumerate(ODD_TEXTS), (None, ODD_TEXTS[0] + "?")], 2)
    want = sorted(((r.n_chars, r.text, r.doc_id, r.key) for r in rows.collect()), key=repr)
    got = ngram_join.one_per_class(rows, ("n_chars", "text", "doc_id", "key")).collect()
    assert sorted(map(tuple, got), key=repr) == want
    texts = sorted((t for _, t, _, _ in want), key=repr)
    assert sorted((r.text for r in ngram_join.one_per_class(rows, ("text",)).collect()), key=repr) == texts
    other = ngram_join.one_per_class(rows.withColumnRenamed("text", "other"), ("other", "key"), text_column="other")
    assert sorted((r.other for r in other.collect()), key=repr) == texts


def test_a_kept_text_is_stored_once_and_asked_alone(rows_of, monkeypatch):
    rng = random.Random(8)
    rows = rows_of([(i, " ".join(f"{rng.getrandbits(64):x}" for _ in range(400))) for i in range(40)])
    size = lambda blocks: sum(len(b.body) + len(b.rest or b"") for b in blocks.collect())
    plain = size(repeats.pack_blocks(rows, "doc_id", "text"))
    assert size(repeats.pack_blocks(rows, "doc_id", "text", keep=("doc_id", "text", "lang"))) < 1.1 * plain
    asked, plainly = [], ngram_join.index_entries
    monkeypatch.setattr(ngram_join, "index_entries", lambda blocks, rule: asked.append(blocks) or plainly(blocks, rule))
    assert ngram_join.one_per_class(rows, ("doc_id", "text")).count() == 40
    assert "rest" not in asked[0].columns
