import json

import pytest
from pyspark.sql import functions as F

from sievegate import schemas
from sievegate.functions.acl import team_by_sha
from sievegate.operators import linear_model, splits, trainset
from sievegate.operators.encode import mean_cosine
from sievegate.operators.labelling import review_sample
from sievegate.operators.upsert import staging_counts, update_vectors
from sievegate.plans import bench, classify, index, labels, prep
from sievegate.sources import files

MEMO = "\n".join(f"Berth {i}: {'barge ' * (1 + i % 5)}moored until tide {i + 3}." for i in range(55))
MESSAGES = [
    ("The north crane is back in service since noon.", "North crane"),
    ("The north crane is back in service since noon.", "North crane"),
    ("the NORTH crane\tis back in  service since noon.", "Fw: crane"),
    (MEMO, "Berths"),
]


@pytest.fixture(scope="module")
def corpus_path(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("prep")
    raw = spark.createDataFrame(MESSAGES, "email_body string, subject_line string").toPandas()
    (folder / "raw").mkdir()
    raw.to_parquet(folder / "raw" / "train-00000-of-00001.parquet")
    stats = prep.run(spark, str(folder / "raw"), str(folder / "corpus"))
    return str(folder / "corpus"), stats


def test_prep_job(spark, corpus_path):
    path, stats = corpus_path
    assert (stats["raw_rows"], stats["cleaned_rows"], stats["exact_removed"], stats["normalized_removed"]) == (4, 4, 1, 1)
    corpus = files.read_table(spark, path, schemas.CORPUS)
    rows = corpus.orderBy("doc_id", "chunk_ord").collect()
    assert len(rows) > 2 and len({r.doc_id for r in rows}) == 2
    assert stats["chunk_rows"] == len(rows)
    for doc in {r.doc_id for r in rows}:
        assert [r.chunk_ord for r in rows if r.doc_id == doc] == list(range(sum(r.doc_id == doc for r in rows)))
    assert all(r.char_len == len(r.text) and r.text.strip() for r in rows)
    written = [json.loads(r.value) for r in spark.read.text(f"{path}-stats").collect()]
    assert written[0]["chunk_rows"] == len(rows)


def test_prep_is_independent_of_partitioning(spark):
    raw = spark.createDataFrame([(b, s, "train") for b, s in MESSAGES], "email_body string, subject_line string, split string")
    first = sorted(map(tuple, prep.build_corpus(raw.repartition(1)).collect()))
    assert first == sorted(map(tuple, prep.build_corpus(raw.repartition(7)).collect()))


def test_raw_splits(spark, tmp_path):
    frame = spark.createDataFrame(MESSAGES[:1], "email_body string, subject_line string").toPandas()
    frame.to_parquet(tmp_path / "test-00000-of-00001.parquet")
    frame.to_parquet(tmp_path / "train-00001-of-00002.parquet")
    frame.to_parquet(tmp_path / "other-00000.parquet")
    assert sorted(r.split for r in files.read_raw_splits(spark, str(tmp_path)).collect()) == ["test", "train"]
    with pytest.raises(FileNotFoundError):
        files.read_raw_splits(spark, str(tmp_path / "none"))


def test_schema_drift(spark, tmp_path):
    frame = spark.createDataFrame([("a",)], "doc_id string")
    with pytest.raises(schemas.SchemaDrift):
        files.write_table(frame, str(tmp_path / "x"), schemas.CORPUS)
    frame.write.parquet(str(tmp_path / "y"))
    with pytest.raises(schemas.SchemaDrift):
        files.read_table(spark, str(tmp_path / "y"), schemas.CORPUS)


def small_corpus(spark):
    rows = [
        ("doc1", "t1", "train", "Harbour", 0, "the ferry at dawn.", 18), ("doc1", "t1", "train", "Harbour", 1, "or later", 8),
        ("doc2", "t2", "train", "Crew", 0, "the mate has 987-65-4321", 24), ("doc3", "t1", "train", "Q3", 0, "the forecast", 12),
    ]
    return spark.createDataFrame(rows, schemas.CORPUS)


def test_label_job(spark, tmp_path):
    path = str(tmp_path / "corpus")
    files.write_table(small_corpus(spark), path, schemas.CORPUS)
    stats = labels.run(spark, path, str(tmp_path / "labels"), str(tmp_path / "gold"), sample=3, splits=True)
    assert stats["chunks"] == 4 and stats["label_dist"] == {"public": 2, "confidential": 1, "internal": 1}
    assert stats["gold_candidates"] == 3 and sum(stats["splits"].values()) == 3
    manifest = files.read_manifest(spark, str(tmp_path / "gold" / "splits"))
    assert sorted(r.doc_id for r in manifest.collect()) == ["doc1", "doc2", "doc3"]
    owner = {r.doc_id: r.split for r in manifest.collect()}
    assert owner["doc1"] == owner["doc3"]
    problems = splits.split_violations(small_corpus(spark), manifest).first()
    assert tuple(problems) == (0, 0, 0, 0)
    with pytest.raises(ValueError, match="too small"):
        labels.run(spark, path, str(tmp_path / "labels2"), str(tmp_path / "gold2"), sample=50)


def test_review_sample_fills_from_everything(spark):
    rows = [(f"d{i:03d}", "t", "train", "x", 0, "y", 1) for i in range(100)]
    corpus = spark.createDataFrame(rows, schemas.CORPUS)
    weak = [(r[0], 0, "confidential" if i < 5 else "public", [], []) for i, r in enumerate(rows)]
    frame = spark.createDataFrame(weak, schemas.WEAK_LABELS)
    sample = review_sample(corpus, frame, 30).collect()
    assert len({(r.doc_id, r.chunk_ord) for r in sample}) == 30
    assert sum(r.weak_label == "confidential" for r in sample) == 5
    again = review_sample(corpus.repartition(6), frame.repartition(3), 30).collect()
    assert sorted(r.doc_id for r in sample) == sorted(r.doc_id for r in again)


def test_manifest_text_files(spark, tmp_path):
    for name, ids in (("train", "b\n a \n\n"), ("test", "c\n")):
        (tmp_path / f"{name}.txt").write_text(ids)
    got = {(r.doc_id, r.split) for r in files.read_manifest(spark, str(tmp_path)).collect()}
    assert got == {("a", "train"), ("b", "train"), ("c", "test")}


def test_train_data_job_leaves_no_gold_thread(spark, tmp_path):
    path = str(tmp_path / "corpus")
    corpus = files.write_table(small_corpus(spark), path, schemas.CORPUS)
    from sievegate.operators.labelling import label_chunks

    files.write_table(label_chunks(corpus), str(tmp_path / "labels"), schemas.WEAK_LABELS)
    gold = {"doc_id": "doc3", "chunk_ord": 0, "text": "the forecast", "title": "Q3", "weak_label": "internal",
            "weak_pii": [], "gold_label": "internal", "note": ""}
    (tmp_path / "gold.jsonl").write_text(json.dumps(gold) + "\n")
    (tmp_path / "splits").mkdir()
    (tmp_path / "splits" / "train.txt").write_text("doc1\ndoc2\n")
    (tmp_path / "splits" / "dev.txt").write_text("doc3\n")
    args = (spark, path, str(tmp_path / "labels"), str(tmp_path / "gold.jsonl"), str(tmp_path / "splits"), str(tmp_path / "out"))
    stats = classify.run_data(*args, train_size=(1, 10), gold_size=1)
    assert stats["train_rows"] == 1 and stats["weak_dist"] == {"confidential": 1}
    assert (stats["gold_threads"], stats["thread_cut_docs"], stats["thread_cut_chunks"], stats["doc_cut_docs"]) == (1, 1, 2, 0)
    assert stats["max_gold_thread_docs"] == 2
    assert [r.split for r in spark.read.json(str(tmp_path / "out" / "eval")).collect()] == ["dev"]
    with pytest.raises(ValueError, match="train rows"):
        classify.run_data(*args, train_size=(5, 10), gold_size=1)
    with pytest.raises(ValueError, match="gold rows"):
        classify.run_data(*args, train_size=(1, 10), gold_size=2)


def test_split_tags(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "doc_id string")
    manifest = spark.createDataFrame([("a", "train"), ("a", "test"), ("b", "dev")], "doc_id string, split string")
    assert {r.doc_id: r.split for r in trainset.tag_splits(rows, manifest).collect()} == {"a": "test", "b": "dev"}
    with pytest.raises(Exception, match="in no split"):
        trainset.tag_splits(rows, manifest.filter("doc_id = 'a'")).collect()
    with pytest.raises(ValueError, match="gold"):
        trainset.require_known(rows, manifest.filter("doc_id = 'a'"), "gold documents")


def test_vectors_round_trip_and_resume(spark, tmp_path, corpus_path):
    path, _ = corpus_path
    out = str(tmp_path / "vectors")
    first = index.run_embed(spark, path, out, 16, n_blocks=3)
    stored = files.read_vector_blocks(spark, out, 16)
    keys = {(r.doc_id, r.chunk_ord) for r in stored.collect()}
    assert len(keys) == stored.count() == first["rows"]
    calls = spark.sparkContext.accumulator(0)

    def load():
        def encode(texts):
            calls.add(len(texts))
            import numpy as np

            return np.ones((len(texts), 16))

        return encode

    index.run_embed(spark, path, out, 16, load_encoder=load)
    assert calls.value == 0, "finished blocks are not encoded again"
    assert files.read_vector_blocks(spark, out, 16).count() == first["rows"]
    grown = str(tmp_path / "grown")
    more = files.read_table(spark, path, schemas.CORPUS)
    more = more.union(more.withColumn("doc_id", F.concat(F.lit("new-"), F.col("doc_id"))))
    files.write_table(more, grown, schemas.CORPUS)
    second = index.run_embed(spark, grown, out, 16, load_encoder=load)
    assert second["rows"] == 2 * first["rows"] and second["added"] == first["rows"] == calls.value
    vectors = files.read_vector_blocks(spark, out, 16)
    assert vectors.select("doc_id", "chunk_ord").distinct().count() == vectors.count() == second["rows"]
    with pytest.raises(Exception, match="expected 15 finite values"):
        files.read_vector_blocks(spark, out, 15).collect()
    bad = spark.createDataFrame([("d", 0, [1.0, float("nan")], 0)], "doc_id string, chunk_ord int, vector array<float>, block int")
    with pytest.raises(Exception, match="expected 2 finite values"):
        files.write_vector_blocks(bad, str(tmp_path / "bad"), 2)
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "chunk-00000.jsonl").write_text('{"doc_id": "d", "chunk_ord": 0, "vector": [1.0, 2.0]}\n')
    assert files.read_vector_blocks(spark, str(lines), 2, "json").first().vector == [1.0, 2.0]


def test_refresh_keeps_grants_and_vectors(spark):
    corpus = small_corpus(spark)
    from sievegate.operators.labelling import label_chunks

    incoming = index.document_rows(corpus, label_chunks(corpus).filter("doc_id <> 'doc3'"))
    empty = spark.createDataFrame([], schemas.DOCUMENTS)
    documents = index.refresh_documents(empty, incoming)
    by_id = {r.id: r for r in documents.collect()}
    assert by_id["doc2"].label == "confidential" and by_id["doc3"].label == "internal"
    assert by_id["doc1"].allowed_roles == []
    granted = index.seed_grants(documents, team_by_sha)
    again = {r.id: r for r in index.refresh_documents(granted, incoming.withColumn("title", F.lit("new"))).collect()}
    assert again["doc1"].title == "new" and again["doc1"].allowed_roles == ["Everyone"] and len(again) == 3
    chunks = index.refresh_chunks(spark.createDataFrame([], schemas.CHUNKS), index.chunk_rows(corpus))
    vectors = spark.createDataFrame([("doc1", 0, [1.0]), ("gone", 0, [2.0])], schemas.VECTORS)
    filled = index.attach_vectors(chunks, vectors)
    assert {r.id: r.embedding for r in filled.collect()}["doc1:0"] == [1.0] and filled.count() == 4
    kept = index.refresh_chunks(filled, index.chunk_rows(corpus).withColumn("text", F.lit("z")))
    assert {(r.id, r.text, tuple(r.embedding or ())) for r in kept.collect()} >= {("doc1:0", "z", (1.0,))}
    staged = spark.createDataFrame([("doc1:0", [3.0]), ("no", [1.0])], "id string, embedding array<float>")
    assert tuple(staging_counts(filled, staged).first()) == (2, 1)
    assert {r.id: r.embedding for r in update_vectors(filled, staged).collect()}["doc1:0"] == [3.0]


def test_images(spark, tmp_path):
    rows = spark.createDataFrame([("7", (b"png", "p.png"))], "id string, image struct<bytes: binary, path: string>")
    rows.write.parquet(str(tmp_path / "forms"))
    images = files.read_images(spark, str(tmp_path / "forms"))
    assert bytes(images.first().bytes) == b"png"
    plan = images._jdf.queryExecution().executedPlan().toString()
    assert "path" not in plan.split("ReadSchema")[1]
    documents, chunks = files.image_rows(images.select("id"))
    assert documents.first().asDict() == {
        "id": "funsd:7", "source": "funsd", "title": "FUNSD form 7", "modality": "image", "thread_id": "funsd:7", "label": "internal",
    }
    assert tuple(chunks.first()) == ("funsd:7:0", "funsd:7", 0, "")


def test_eval_rows_and_tags(spark, tmp_path):
    path = tmp_path / "eval.jsonl"
    lines = [{"doc_id": "a", "chunk_ord": 0, "text": "t", "gold_label": "public", "gold": "internal", "split": "test"},
             {"doc_id": "b", "chunk_ord": 1, "text": "t", "gold": "internal", "split": "dev"}]
    path.write_text("\n\n".join(map(json.dumps, lines)) + "\n")
    assert [r.gold for r in files.read_eval_rows(spark, str(path)).orderBy("doc_id").collect()] == ["public", "internal"]
    assert files.read_eval_rows(spark, str(path), "gold").orderBy("doc_id").first().gold == "internal"
    assert files.read_split_tags(spark, str(path)).count() == 2
    assert files.read_split_tags(spark, str(tmp_path / "none.jsonl")) is None
    path.write_text(json.dumps({"doc_id": "a", "gold": "odd"}) + "\n")
    with pytest.raises(Exception, match="bad gold label"):
        files.read_eval_rows(spark, str(path)).collect()


def prediction_file(method, cost, key="cost_per_1k_usd"):
    probs = {"public": 0.8, "internal": 0.1, "confidential": 0.1}
    row = {"doc_id": "a", "gold": "public", "pred": "public", "probs": probs}
    rows = [{**row, "chunk_ord": i, "latency_ms": i + 1.0} for i in range(4)]
    config = {"method": method, key: cost} if method else {key: cost}
    return json.dumps({"config": config, "rows": rows}, indent=1)


def test_prediction_files_and_comparison(spark, tmp_path):
    results = tmp_path / "results"
    results.mkdir()
    (results / "a.json").write_text(prediction_file("one", 0.5))
    (results / "b.json").write_text(prediction_file(None, 0.25, "cost_usd_per_1k"))
    (results / "broken.json").write_text('{"config": ')
    (results / "probe.json").write_text(prediction_file("probe", 0.0))
    rows = files.read_predictions(spark, str(results), ("probe",))
    assert {(r.method, r.cost_per_1k_usd) for r in rows.collect()} == {("one", 0.5), ("b", 0.25)}
    tags = tmp_path / "eval.jsonl"
    tags.write_text("\n".join(json.dumps({"doc_id": "a", "chunk_ord": i, "split": s}) for i, s in enumerate(("test", "dev"))))
    summary = classify.compare(spark, str(results), str(tags), ("probe",))
    got = {(r.method, r.subset): r for r in summary.collect()}
    assert got["one", "all"].n == 4 and got["one", "test"].n == 1 and got["b", "all"].accuracy == 1.0
    assert got["one", "all"].ece == pytest.approx(0.2) and got["one", "all"].p50 == 2.0
    table = classify.comparison_table(summary)
    assert table.count("\n") == 5 and "| one | all | 4 | 1.000 |" in table


def test_tagged_csv(spark, tmp_path):
    path = tmp_path / "pii.csv"
    path.write_bytes(
        b'Template,Filled Template,Tokens\n"x","My pin, is\x00 1","[\'O\', \'B-PIN\']"\n"x","","[\'O\']"\n"x","city ""a""\nb","[\'B-CITY\']"\n'
    )
    got = {r.text: (r.label, r.tags) for r in files.read_tagged_texts(spark, str(path)).collect()}
    assert got == {"My pin, is 1": ("confidential", ["O", "B-PIN"]), 'city "a"\nb': ("internal", ["B-CITY"])}


def test_frozen_queries(spark, tmp_path):
    documents = spark.createDataFrame(
        [("test:1", "A long enough subject", "text"), ("test:2", "Re: a long enough subject", "text"),
         ("train:3", "Another long subject here", "text"), ("test:4", "A picture with long title", "image")],
        "doc_id string, title string, modality string",
    )
    text = "cut words " * 20
    chunks = spark.createDataFrame(
        [("test:1", 0, text), ("test:1", 2, text), ("test:1", 1, "first " + text), ("test:2", 1, "short"), ("train:3", 1, text)],
        "doc_id string, ord int, text string",
    )
    frozen = bench.freeze_queries(documents, chunks, 5)
    got = {r.qid: r for r in frozen.collect()}
    assert set(got) == {"subj-000", "chunk-000"}
    assert got["subj-000"].text == "A long enough subject" and got["chunk-000"].text == text
    digest = files.content_digest(frozen).first()
    assert digest == files.content_digest(frozen.repartition(3)).first() and len(digest.digest) == 16
    assert digest != files.content_digest(frozen.unionByName(frozen)).first()
    files.write_rows(frozen, str(tmp_path / "q"))
    assert files.read_frozen_queries(spark, str(tmp_path / "q")).count() == 2


def test_all_held_out_documents_are_asked(spark):
    ids = [f"test:{i * 7919 % 4096:03x}{i:02x}" for i in range(170)]
    documents = spark.createDataFrame([(i, "A long enough subject", "text") for i in ids], "doc_id string, title string, modality string")
    chunks = spark.createDataFrame([(i, 1, "cut words " * 20) for i in ids], "doc_id string, ord int, text string")
    got = {r.qid: r.relevant_doc for r in bench.freeze_queries(documents, chunks, None).collect()}
    want = [(f"{kind}-{at:03d}", i) for kind in ("subj", "chunk") for at, i in enumerate(sorted(ids))]
    assert got == dict(want)
    first = bench.freeze_queries(documents, chunks).collect()
    assert {r.qid: r.relevant_doc for r in first} == {q: i for q, i in want if int(q.split("-")[1]) < 150}


def test_articles(spark):
    rows = spark.createDataFrame([(3, " " + "a" * 3000), (1, "b" * 499 + "  "), (2, "c" * 500)], "id int, text string")
    got = files.sample_articles(rows, "id", 5).collect()
    assert [(r.id, len(r.text)) for r in got] == [(2, 500), (3, 2000)]


def test_linear_model_round_trip(spark, tmp_path):
    names = ("public", "internal", "confidential")
    rows = [(f"k{i}", names[i % 3], [float(i % 3 == c) + 0.01 * ((i * 7) % 5) for c in range(3)]) for i in range(60)]
    frame = spark.createDataFrame(rows, "key string, label string, vector array<float>")
    best, means = linear_model.choose_c(frame, ["key"], (0.01, 10.0))
    assert best == max((0.01, 10.0), key=means.get) and set(means) == {0.01, 10.0}
    model = linear_model.fit(frame, 10.0)
    weights = linear_model.export_weights(model)
    linear_model.save_weights(spark, weights, str(tmp_path / "w"))
    loaded = linear_model.load_weights(spark, str(tmp_path / "w"), 3)
    scored = linear_model.predict(model, frame).select("key", "probs", "pred", "label").orderBy("key").collect()
    plain = linear_model.score_with_weights(loaded, frame).orderBy("key").collect()
    for a, b in zip(scored, plain, strict=True):
        assert a.pred == b.pred == a.label
        assert all(abs(a.probs[n] - b.probs[n]) < 1e-6 for n in names)
    two = linear_model.fit(frame.filter("label <> 'confidential'"), 1.0)
    assert len(linear_model.export_weights(two).coefficients) == 3
    two_pred = linear_model.predict(two, frame.filter("label <> 'confidential'"))
    assert two_pred.filter("pred <> label").count() == 0
    with pytest.raises(ValueError, match="not 3 x 4"):
        linear_model.load_weights(spark, str(tmp_path / "w"), 4)
    with pytest.raises(Exception, match="unexpected label"):
        linear_model.fit(frame.withColumn("label", F.lit("odd")), 1.0)


def test_missing_vector_is_an_error(spark):
    rows = spark.createDataFrame([("a", 0)], "doc_id string, chunk_ord int")
    vectors = spark.createDataFrame([("b", 0, [1.0])], schemas.VECTORS)
    with pytest.raises(Exception, match="no vector for a:0"):
        trainset.join_vectors(rows, vectors).collect()
    assert tuple(trainset.key_differences(rows, vectors).first()) == (1, 1, 0)
    assert tuple(mean_cosine(vectors, vectors, ["doc_id"]).first()) == (1, 1.0)


def test_integrity_profile_finds_planted_faults(spark):
    from sievegate.operators.corpus import integrity_profile

    rows = [("a", "t", "s", "x", 0, "one", 3), ("a", "t", "s", "x", 2, "two", 9), ("b", "t", "s", "x", 0, "", 0), ("b", "t", "s", "x", 0, "z", 1)]
    got = integrity_profile(spark.createDataFrame(rows, schemas.CORPUS)).first()
    assert (got.documents, got.threads, got.chunks, got.empty_texts, got.length_mismatches) == (2, 1, 4, 1, 1)
    assert (got.documents_with_gaps, got.duplicate_keys, got.rows_with_nulls) == (2, 1, 0)


def test_repeated_incoming_keys_are_an_error(spark):
    from sievegate.operators.upsert import update_vectors, upsert

    old = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int")
    new = spark.createDataFrame([("b", 5), ("c", 6)], "id string, n int")
    assert sorted(map(tuple, upsert(old, new, "id", ["n"]).collect())) == [("a", 1), ("b", 5), ("c", 6)]
    with pytest.raises(Exception, match="more than once"):
        upsert(old, new.union(new), "id", ["n"]).collect()
    chunks = spark.createDataFrame([("a", [1.0])], "id string, embedding array<double>")
    staged = spark.createDataFrame([("a", [2.0]), ("a", [3.0])], "id string, embedding array<double>")
    with pytest.raises(Exception, match="more than once"):
        update_vectors(chunks, staged).collect()
