import os

import pytest
from pyspark.sql import functions as F

from sievegate import schemas
from sievegate.operators.corpus import whole_texts
from sievegate.operators.upsert import upsert
from sievegate.sources import buckets, files

ROW = "id string, note string"


def layout(spark):
    return spark.createDataFrame([], ROW).schema


def put(spark, path, rows, n=8):
    frame = spark.createDataFrame(rows, ROW)
    return buckets.merge_buckets(spark, path, frame, "id", layout(spark), lambda s, i: upsert(s, i, "id", ["note"]), n)


def stored_files(path):
    return {os.path.join(a, f) for a, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


def table(spark, path):
    return {r.id: r.note for r in buckets.read_buckets(spark, path, layout(spark)).collect()}


def test_merge_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path)
    assert table(spark, path) == {}
    first = put(spark, path, [(f"k{i}", "old") for i in range(60)])
    assert first == {"version": 0, "touched": 8, "kept": 0}
    before = stored_files(path)
    second = put(spark, path, [("k7", "new"), ("k61", "new")], n=99)
    assert second["touched"] in (1, 2) and second["touched"] + second["kept"] == 8
    assert before < stored_files(path)
    assert table(spark, path) == {f"k{i}": "old" for i in range(60)} | {"k7": "new", "k61": "new"}
    manifest = {r.bucket: r.since for r in buckets.read_manifest(spark, path).collect()}
    assert sum(since == 1 for since in manifest.values()) == second["touched"]
    assert put(spark, path, []) == {"version": 1, "touched": 0, "kept": 8}
    put(spark, path, [("k7", "newer")])
    want = table(spark, path)
    assert buckets.drop_old_versions(spark, path, keep=1) == (1 if second["touched"] == 1 else 0)
    assert table(spark, path) == want and want["k7"] == "newer"


def test_merge_refuses_repeated_and_null_keys(spark, tmp_path):
    path = str(tmp_path)
    put(spark, path, [("a", "1")])
    for rows, message in (([("b", "1"), ("b", "2")], "more than once"), ([(None, "1")], "id is null")):
        with pytest.raises(Exception, match=message):
            put(spark, path, rows)
    assert table(spark, path) == {"a": "1"}


def test_of_two_merges_at_once_the_later_fails(spark, tmp_path):
    path = str(tmp_path)
    put(spark, path, [("a", "1")])

    def slow(stored, incoming):
        put(spark, path, [("a", "theirs")])
        return upsert(stored, incoming, "id", ["note"])

    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        buckets.merge_buckets(spark, path, spark.createDataFrame([("a", "mine")], ROW), "id", layout(spark), slow)
    assert table(spark, path) == {"a": "theirs"}


def corpus(spark, n):
    rows = [(f"d{i // 3:04d}", "t", "train", "x", i % 3, f"text {i}", 6) for i in range(n)]
    return spark.createDataFrame(rows, schemas.CORPUS).repartition(5)


def test_sorted_tables_are_read_by_key(spark, tmp_path):
    path = str(tmp_path / "corpus")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    rows = corpus(spark, 600).withColumn("text", counted("text")).select(*schemas.CORPUS.fieldNames())
    files.write_table(rows, path, schemas.CORPUS, sort_by=("doc_id", "chunk_ord"), n_files=8)
    assert seen.value == 600
    assert tuple(files.order_report(spark, path, ("doc_id", "chunk_ord")).first()) == (600, 0, 0)
    assert not os.path.exists(f"{path}-unsorted")
    keys = spark.createDataFrame([("d0007",), ("d0008",), ("d9999",), ("",), (None,), ("d0007",)], "doc_id string")
    names, n_files = files.files_with_keys(spark, path, keys)
    assert n_files == 8 and 1 <= len(names) <= 2
    found = files.read_keys(spark, path, schemas.CORPUS, keys).collect()
    assert sorted({r.doc_id for r in found}) == ["d0007", "d0008"] and len(found) == 6
    assert files.read_keys(spark, path, schemas.CORPUS, keys.filter("doc_id = ''")).count() == 0


def test_order_report_sees_disorder(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.createDataFrame([("b",), ("a",), ("c",)], "k string").coalesce(1).write.json(path)
    spark.createDataFrame([("b",)], "k string").coalesce(1).write.mode("append").json(path)
    assert tuple(files.order_report(spark, path, ("k",), form="json").first()) == (4, 1, 1)


def test_empty_table_is_sorted(spark, tmp_path):
    path = str(tmp_path / "none")
    assert files.write_table(corpus(spark, 3).limit(0), path, schemas.CORPUS, sort_by=("doc_id",)).count() == 0
    keys = spark.createDataFrame([("a",)], "doc_id string")
    assert files.read_keys(spark, path, schemas.CORPUS, keys).count() == 0


def test_whole_texts_gather_what_the_cut_can_reach(spark):
    chunks = spark.createDataFrame([("a", i, "x" * 30) for i in range(50)] + [("b", 0, "")], "doc_id string, chunk_ord int, text string")
    titles = spark.createDataFrame([("a", "title"), ("b", "empty")], "doc_id string, title string")
    got = {r.doc_id: r.text for r in whole_texts(chunks, titles, 100).collect()}
    assert got == {"a": "\n".join(["title"] + ["x" * 30] * 50)[:100], "b": "empty\n"}
