"""Quality rules and secret scans against plain Python."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievegate.llm import quality, secret_scan

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KINDS = (("assign", ASSIGN, lambda m: len(m[2]) >= 8), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
         ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32))
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")


def measured(text):
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, again = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            again |= set(range(i, i + 5))
    n, chars = len(words), sum(map(len, words))
    symbols, dup = sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines))
    fails = (n < 10, 100 * len(again) > 20 * n, chars < 2 * n, chars > 20 * n, 100 * symbols > 25 * n, 2 * dup > len(lines))
    return (n, chars, symbols, dup, len(again), fails[0] or fails[1], not any(fails), sum(f << i for i, f in enumerate(fails)), len(lines))


def texts():
    rng = random.Random(6)
    words = ["a", "bb", "ccc", "é", "日本", "x#y", "|", "<>", "🙂"]
    joins = [" ", " ", "\n", "\t", "  ", " \n", "\r\n", "\x0b", " "]
    out = ["".join(rng.choice(words) + rng.choice(joins) for _ in range(rng.randint(0, 60))) for _ in range(250)]
    out += [" ".join(rng.choice(["of", "the", "and", "one"]) for _ in range(n)) for n in (5, 6, 10, 40, 3000)]
    return out + ["", None, " ", "\n\n", "one two three four five " * 3, "x" * 500, "same line here\n" * 30, "w1 w2 w3 w4 w5"]


def test_measurements_equal_plain_python(rows_of):
    rows = list(enumerate(texts())) + [(3, "twice " * 20), (3, "twice " * 20), (None, "no id")]
    got = quality.judged(rows_of(rows)).collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *measured(t)) for i, t in rows)
    assert quality.judged(rows_of(rows).limit(0)).count() == 0


def test_ablation_counts_rules(rows_of):
    rows = list(enumerate(texts()))
    got = {r.rule: r for r in quality.ablation(quality.ledger(rows_of(rows).select("doc_id", "text"))).collect()}
    masks = [measured(t)[7] for _, t in rows]
    for bit, rule in enumerate(quality.rules()):
        assert got[rule.name].n_failed == sum(m >> bit & 1 for m in masks)
        assert got[rule.name].n_kept_without == sum(m == 1 << bit for m in masks)


def secret_texts():
    rng = random.Random(9)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    base = lambda n: "".join(rng.choice(secret_scan.ALPHABET[:62] + "+/") for _ in range(n))
    return [
        f"PassWord = '{base(12)}' and token=short token: {base(9)}", f"api_key:{hexes(40)} apikey\"  :  \"{base(20)}",
        "token=secret:abcdefgh12 password=password:abcdefgh12", f"AKIA{base(20).upper()} AKIAAKIA AKIAABCDEFGHIJKL AKIA1",
        f"é🙂 {hexes(32)} {hexes(31)} {hexes(64)}Z", "ſecret=abcdefghijk toKen=abcdefghijk", f"key {base(40)} end", f"x{base(48)}",
        "internationalization_configuration_manager", "ordinary words only, nothing to see", "a" * 40, "", None,
        "password\n=abcdefghijk", f"secret=é token=={base(10)}", "https/example/path/to/some/resource/page",
    ] + [f"{base(30)} " * 40]


@pytest.fixture(scope="module")
def models(spark):
    folder = "/root/testdata/sf0.001"
    return secret_scan.labelled_models(
        spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    )


def plain_score(models, token):
    size, known = len(secret_scan.ALPHABET), [secret_scan.ALPHABET.find(c) for c in token]
    return sum(models.ratios[a * size + b] for a, b in zip(known, known[1:], strict=False)) / (len(token) - 1)


def plain_spans(models, text):
    text = text or ""
    base = [(m.start(), rank, kind, m.end()) for rank, (kind, p, keep) in enumerate(KINDS) for m in p.finditer(text) if keep(m)]
    more = [(m.start(), 3, "markov", m.end()) for m in CANDIDATE.finditer(text)
            if plain_score(models, m[0]) >= secret_scan.THRESHOLD
            and not any(b[0] < m.end() and m.start() < b[3] for b in base)]
    return sorted(base), sorted(base + more)


def joined(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def test_spans_equal_plain_python(spark, rows_of, models):
    rows = list(enumerate(secret_texts())) + [(2, secret_texts()[2]), (None, "token=abcdefghij")]
    found = secret_scan.find_secrets(rows_of(rows).select("doc_id", "text"), models)
    got = found.select("doc_id", "text", secret_scan.joined(found.base).alias("b"), secret_scan.joined(found.spans).alias("s"),
                       secret_scan.redacted(found.text, found.spans).alias("r")).collect()
    assert len(got) == len(rows)
    for r in got:
        base, spans = plain_spans(models, r.text)
        assert (r.b, r.s) == (joined(base), joined(spans)), r.text
        if r.text is not None:
            out, at = "", 0
            for start, _, _, end in spans:
                if start >= at:
                    out += r.text[at:start] + "[secret]"
                at = max(at, end)
            assert r.r == out + r.text[at:]


def test_counts_and_digest(spark, rows_of):
    rows = list(enumerate(secret_texts()))
    labels = spark.createDataFrame([(9, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in secret_scan.scan(rows_of(rows), labels).collect()}
    for i, text in rows:
        base, _ = plain_spans(secret_scan.Models((0.0,) * len(secret_scan.ALPHABET) ** 2), text)
        kinds = Counter(s[2] for s in base)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert got[i].base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
    assert secret_scan.scan(rows_of(rows).limit(0), labels.limit(0)).count() == 0


def test_models_tell_held_out_strings_apart(spark, models):
    random_half = secret_scan.random_strings(spark, 25_000).filter("length(token) >= 20").collect()[-2_000:]
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    ordinary = secret_scan.ordinary_identifiers(docs, labels).filter("length(token) >= 20").limit(2_000).collect()
    hit = lambda rows: sum(plain_score(models, r.token) >= secret_scan.THRESHOLD for r in rows) / len(rows)
    assert hit(random_half) > 0.97 and hit(ordinary) < 0.03


def test_a_text_with_a_hundred_thousand_matches(spark, rows_of, models):
    """Time grows little more than in proportion to the matches of one text."""
    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rng = random.Random(11)
    lines = ["".join(rng.choices(base64, k=30)) for _ in range(98_000)] + ["token = abcdefgh12", "a" * 40] * 1_000
    rng.shuffle(lines)
    text = "\n".join(lines)
    frame = rows_of([(1, text), (2, "\n".join(lines[:50]))], 1)
    started = time.monotonic()
    found = {r.doc_id: r for r in secret_scan.find_secrets(frame, models).collect()}
    spent = time.monotonic() - started
    assert [tuple(s) for s in found[1].spans] == plain_spans(models, text)[1]
    started = time.monotonic()
    spans = secret_scan.find_secrets(frame.filter("doc_id = 1"), models)
    (row,) = spans.select(secret_scan.redacted(F.col("text"), F.col("spans")).alias("t")).collect()
    out, at = [], 0
    for start, _, _, end in found[1].spans:
        if start >= at:
            out += [text[at:start], "[secret]"]
        at = max(at, end)
    assert row.t == "".join(out) + text[at:] and spent < 60 and time.monotonic() - started < 90


def test_redaction_of_overlapping_and_far_spans(spark):
    rng = random.Random(5)
    for n in (1, 5, 40):
        text = "".join(rng.choice("aé漢🙂 \n") for _ in range(6_000))
        spans = sorted((a, 0, "k", min(6_000, a + rng.choice([1, 7, 900, 2_500]))) for a in rng.sample(range(6_000), n))
        frame = spark.createDataFrame([(text, spans)], "t string, s array<struct<start:int,rank:int,kind:string,end:int>>")
        out, at = "", 0
        for start, _, _, end in spans:
            if start >= at:
                out += text[at:start] + "[secret]"
            at = max(at, end)
        assert frame.select(secret_scan.redacted(F.col("t"), F.col("s"))).first()[0] == out + text[at:]


def test_clashing_names_are_replaced(spark, rows_of, models):
    frame = rows_of([(1, "token = abcdefgh12 and more words")]).selectExpr(
        "*", "1 AS base", "2 AS spans", "3 AS n_words", "4 AS failed", "5 AS `a.b`", "6 AS __text", "7 AS _words")
    (row,) = secret_scan.find_secrets(frame, models).collect()
    assert len(row.base) == 1 and len(row.spans) == 1 and row["a.b"] == 5 and row["__text"] == 6
    (entry,) = quality.ledger(frame).collect()
    assert entry.n_words == 6 and entry.failed == 1 and entry["_words"] == 7
