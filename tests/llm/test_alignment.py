"""Alignment of two tokenizations against plain encoding of whole texts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import sentencepiece
from test_tokens import odd_texts
from tokenizers import Tokenizer

from sievegate.llm import arrays, queries
from sievegate.llm.alignment import align_documents, byte_alphabet
from sievegate.llm.tokens import tokenizer_path

FILES = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def plain(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every text."""
    byte_file = Tokenizer.from_file(FILES[0])
    byte_file.encode_special_tokens = True
    piece_file = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    alphabet, links, groups, found = byte_alphabet(), [], [], []
    for text in texts:
        whole = f" {text}".encode() if text else b""
        a = byte_file.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = piece_file.encode(text) if text else []
        spelled_a = [bytes(alphabet[c] for c in byte_file.id_to_token(i)) for i in a]
        names = [piece_file.id_to_piece(i) for i in b]
        spelled_b = [
            bytes([int(n[3:-1], 16)]) if piece_file.is_byte(i) else n.replace("▁", " ").encode()
            for i, n in zip(b, names, strict=True)
        ]
        if b"".join(spelled_a) != whole or b"".join(spelled_b) != whole:
            a, b, spelled_a, spelled_b = [], [], [], []
        ends = [np.cumsum([len(x) for x in side], dtype=int).tolist() for side in (spelled_a, spelled_b)]
        begins = [[0, *e[:-1]] for e in ends]
        pairs, j = [], 0
        for i, token in enumerate(a):
            while ends[1][j] <= begins[0][i]:
                j += 1
            k = j
            while k < len(b) and begins[1][k] < ends[0][i]:
                pairs.append((token, b[k]))
                k += 1
        cuts = sorted(set(ends[0]) & set(ends[1]))
        runs = []
        for lo, hi in zip([0, *cuts], cuts, strict=False):
            sides = (
                ",".join(str(t) for t, e in zip(ids, end, strict=True) if lo < e <= hi)
                for ids, end in zip((a, b), ends, strict=True)
            )
            runs.append("|".join(sides))
        links.append(pairs)
        groups.append(";".join(runs))
        found.append((len(a), len(b), len(cuts), len(pairs)))
    counts = Counter(p for pairs in links for p in set(pairs))
    most = defaultdict(int)
    for (first, _), n in counts.items():
        most[first] = max(most[first], n)
    for row, pairs, text in zip(found, links, groups, strict=True):
        yield *row, sum(counts[p] == most[p[0]] for p in pairs), sum(counts[p] for p in pairs), text


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def check(frame, texts):
    rows = align_documents(frame, *FILES).collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(rows) == len(texts)
    for i, want in enumerate(plain(texts)):
        assert got[i] == want, repr(texts[i])


def test_odd_texts_equal_plain_encoding(rows_of):
    texts = odd_texts() + ["a▁b plain words", "▁", " ", "   ", "  x", "x   y", "\r", "x;\r\n y", "\x00", "<0x41> </s>"]
    check(rows_of(list(enumerate(texts))), texts)


def test_whole_table_equals_plain_encoding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    check(docs.repartition(5), texts)


def test_a_text_of_ten_megabytes_and_one_word_of_half_a_million(rows_of):
    texts = ["long words here " * 650_000, "ab" * 250_000, "short"]
    rows = {r.doc_id: r for r in align_documents(rows_of(list(enumerate(texts))), *FILES).drop("groups").collect()}
    one = next(plain(["long words here " * 10]))
    assert rows[0].n_groups > 65_000 * one[2] // 10 * 9 and rows[1].n_a > 0 and rows[2].n_groups > 0


def test_repeated_rows_null_ids_and_no_rows(rows_of):
    twice = rows_of([(4, "the same text"), (4, "the same text"), (None, "the same text"), (5, None), (6, "")])
    rows = align_documents(twice, *FILES).collect()
    full = [r for r in rows if r.n_a]
    assert len(rows) == 5 and len(full) == 3 and {r.count_sum for r in full} == {3 * full[0].n_links}
    assert {tuple(r)[1:] for r in rows if not r.n_a} == {(0, 0, 0, 0, 0, 0, "")}
    assert align_documents(twice.limit(0), *FILES).count() == 0


def test_query_digests_the_groups(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op11_token_alignment(spark, folder).collect()}
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()]
    for i, want in enumerate(plain(texts)):
        assert got[i].groups_sha256 == (hashlib.sha256(want[-1].encode()).hexdigest() if want[0] else "")


def test_mixing_can_be_undone():
    values = np.random.default_rng(4).integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    assert (arrays.unmixed(arrays.mixed(values)) == values).all()
