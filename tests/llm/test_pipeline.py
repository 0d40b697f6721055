"""The stages one by one on small corpora, and the whole run, against plain versions."""

import os
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from sievegate.llm import packing
from sievegate.session import shared_folder
from test_ngram_join import brute
from test_quality_secrets import measured, plain_spans
from test_shares import targets_of
from test_tokens import checksum, plain

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """What each stage gives on the smallest tables, read again."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(number))
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return [t.collect() for t in out]


def test_columns_of_documents_stay(tables):
    for rows in tables[1:-1]:
        assert tuple(rows[0].asDict()) == corpus_pipeline.COLUMNS


def test_quality_stage(tables):
    docs, kept = tables[0], tables[1]
    assert sorted(map(tuple, kept)) == sorted(tuple(r) for r in docs if measured(r.text)[6])


def test_join_stage(tables):
    docs, kept = tables[1], tables[2]
    want, _ = brute([(r.doc_id, r.text) for r in docs], corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.LINK)
    stay = {component for _, _, component in want}
    assert sorted(map(tuple, kept)) == sorted(tuple(r) for r in docs if r.doc_id in stay)


def test_secret_stage(spark, tables):
    docs, kept = {r.doc_id: r for r in tables[2]}, tables[3]
    frame = spark.createDataFrame(tables[2])
    fitted = corpus_pipeline.secret_scan.labelled_models(frame, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert len(kept) == len(docs)
    for r in kept:
        before = docs[r.doc_id].text
        out, at = "", 0
        for start, _, _, end in plain_spans(fitted, before)[1]:
            if start >= at:
                out += before[at:start] + "[secret]"
            at = max(at, end)
        assert r.text == out + before[at:]
        assert r.n_chars == (len(r.text) if at else docs[r.doc_id].n_chars)


def test_mixing_stage(tables):
    docs, mixed = {r.doc_id: r for r in tables[3]}, tables[4]
    sizes, taken, copies = Counter(), Counter(), defaultdict(list)
    for r in docs.values():
        sizes[r.source] += len(r.text.split())
    for r in mixed:
        taken[r.source] += len(r.text.split())
        copies[r.doc_id].append(r.text)
        assert docs[r.doc_id].text.startswith(r.text) and r.n_chars == len(r.text)
        assert (r.lang, r.source) == (docs[r.doc_id].lang, docs[r.doc_id].source)
    for source, target in targets_of(sizes).items():
        assert abs(taken[source] - target) <= 0.5
    for doc_id, texts in copies.items():
        assert len(texts) <= 3 and sum(t != docs[doc_id].text for t in texts) <= 1


def check_packing(mixed, pieces):
    """Every id of every document lies in one piece, and sequences are full without gaps."""
    ids_of, documents, sequences = plain("byte_bpe_50k.json"), defaultdict(list), defaultdict(list)
    for p in pieces:
        documents[p.doc_id, p.doc_tokens].append((p.start, p.length, p.ids_crc32))
        sequences[p.sequence_id].append((p.offset, p.length))
    want = defaultdict(list)
    for r in mixed:
        ids = ids_of(r.text) + [1]
        want[r.doc_id, len(ids)].append(ids)
    assert set(want) == set(documents)
    for key, copies in want.items():
        found = sorted(documents[key])
        assert sum(n for _, n, _ in found) == key[1] * len(copies)
        assert sum(start == 0 for start, _, _ in found) == len(copies)
        assert set(found) <= {(start, n, checksum(ids[start : start + n])) for ids in copies for start, n, _ in found}
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at in {1 << i for i in range(12)}


def test_packing_stage(tables):
    check_packing(tables[4], tables[5])


def test_run_is_the_stages_in_turn(spark, tables):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    check_packing(tables[4], corpus_pipeline.run(spark, FOLDER).collect())
    folder = shared_folder(spark)
    left = {name.rsplit("-", 1)[0] for name in os.listdir(folder)}
    before = corpus_pipeline.run(spark, FOLDER)
    assert before.count() and {n.rsplit("-", 1)[0] for n in os.listdir(folder)} == left


def test_ties_share_their_words(spark, rows_of):
    """Rows equal in id and text cannot be told apart: they share the last epoch in equal parts."""
    rows = [(1, "one two three four five", "a"), (1, "one two three four five", "a"), (2, "six seven", "b"), (3, None, "c")]
    mixed = corpus_pipeline.mix(spark, rows_of(rows), FOLDER).collect()
    taken = Counter()
    for r in mixed:
        taken[r.source] += len(r.text.split())
    for source, target in targets_of({"a": 10, "b": 2, "c": 0}).items():
        assert target - 2 < taken[source] <= target + 0.5


ODD = [(1, None, "a"), (2, "", None), (2, "", None), (3, "many words in this text are good enough to stay here " * 2, None),
       (None, "the text without an id also has quite enough words to be kept", "b"), (4, "word " * 5_000, "a"),
       (5, "a plain text with more than ten words that has nothing wrong in it", "a"),
       (5, "a plain text with more than ten words that has nothing wrong in it", "a"),
       (6, "token = abcdefgh12345678 sits among some other words of this one text", "b")]


@pytest.mark.parametrize("number", range(5))
def test_stages_take_odd_rows_and_none(spark, rows_of, number):
    name, stage = corpus_pipeline.STAGES[number]
    docs = rows_of(ODD).selectExpr("*", "3 AS n_words", "'y' AS spans", "4 AS base", "5 AS row", "6 AS failed")
    out = stage(spark, docs, FOLDER)
    rows = out.collect()
    if number < 4:
        assert out.columns == list(corpus_pipeline.COLUMNS)
    ids = Counter(r.doc_id for r in rows)
    expected = {
        0: Counter({None: 1, 5: 2, 6: 1}),
        1: Counter({1: 1, 2: 2, 3: 1, None: 1, 4: 1, 5: 1, 6: 1}),
        2: Counter(r[0] for r in ODD),
    }
    if number in expected:
        assert ids == expected[number], name
    if number == 2:
        assert [r.text for r in rows if r.doc_id == 6] == ["[secret] sits among some other words of this one text"]
    if number == 4:
        assert set(ids) == {r[0] for r in ODD}
    none = stage(spark, docs.limit(0), FOLDER)
    assert none.count() == 0


def test_workers_of_the_packing_stage_get_small_batches(spark, rows_of, monkeypatch):
    """The stage as the pipeline's table lists it, which its callers run one by one."""
    cut = packing.chunks_of

    def bounded(batch, column):
        if batch.nbytes > 6 << 20:
            raise MemoryError(f"{batch.nbytes} bytes in a batch")
        return cut(batch, column)

    monkeypatch.setattr(packing, "chunks_of", bounded)
    name, stage = corpus_pipeline.STAGES[-1]
    docs = rows_of([(i, "ab " * 350_000) for i in range(12)]).coalesce(1)
    got = stage(spark, docs, FOLDER).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in got}.keys() == set(range(12)) and len({r[1] for r in got}) == 1


def test_join_stage_drops_copies_with_two_edits_in_a_hundred_words(spark, rows_of):
    words = [f"w{i}" for i in range(100)]
    near = [*words[:30], "x", *words[31:65], "y", *words[66:]]
    docs = rows_of([(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(words[50:]))])
    assert sorted(r.doc_id for r in corpus_pipeline.keep_one_of_near_copies(spark, docs, FOLDER).collect()) == [1, 3]
