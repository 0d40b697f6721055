from pyspark.sql import functions as F

from sievegate.plans.prep import build_corpus
from sievegate.streaming.incremental import message_stream, start_prep

SHAPE = "email_body string, subject_line string, split string"


def rows(spark, path, *columns):
    return sorted(tuple(r) for r in spark.read.parquet(path).select(*columns).collect())


def test_incremental_runs_add_each_message_once(spark, tmp_path):
    inbox, out, progress = (str(tmp_path / n) for n in ("inbox", "out", "progress"))
    first = [("meeting at noon", "one", "train"), ("plain words", "two", "train")]
    second = [("plain words", "two", "train"), ("more words " * 200, "three", "test")]

    def deliver(batch):
        spark.createDataFrame(batch, SHAPE).coalesce(1).write.mode("append").parquet(inbox)
        stream = message_stream(spark, inbox, spark.createDataFrame([], SHAPE).schema)
        start_prep(stream, out, progress).awaitTermination()

    deliver(first)
    deliver(second)
    expected = build_corpus(spark.createDataFrame(first + second, SHAPE))
    columns = ["doc_id", "chunk_ord", "text"]
    assert rows(spark, f"{out}/corpus", *columns) == sorted(tuple(r) for r in expected.select(*columns).collect())
    assert len(rows(spark, f"{out}/labels", "doc_id", "chunk_ord")) == expected.count()
    deliver([])
    assert spark.read.parquet(f"{out}/corpus").count() == expected.count()
    batches = spark.read.parquet(f"{out}/corpus").agg(F.count_distinct("batch")).first()[0]
    assert batches == 2


def test_history_is_neither_read_nor_forgotten(spark, tmp_path):
    """Earlier output may be gone: what has been seen is known from the keyed state."""
    inbox, progress = str(tmp_path / "inbox"), str(tmp_path / "progress")
    batch = [("Quay  four is closed", "a", "train"), ("quay four IS closed", "b", "test"), (None, "c", "test"), ("", None, "train")]
    batch += [("the same notice", f"n{i}", "train") for i in range(300)]

    def deliver(rows_, out):
        spark.createDataFrame(rows_, SHAPE).repartition(3).write.mode("append").parquet(inbox)
        stream = message_stream(spark, inbox, spark.createDataFrame([], SHAPE).schema, files_per_batch=1000)
        start_prep(stream, out, progress).awaitTermination()

    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    deliver(batch, one)
    expected = build_corpus(spark.createDataFrame(batch, SHAPE))
    columns = ["doc_id", "title", "text"]
    assert rows(spark, f"{one}/corpus", *columns) == sorted(tuple(r) for r in expected.select(*columns).collect())
    deliver(batch + [("crane two is closed", "d", "test")], two)
    assert [r[1] for r in rows(spark, f"{two}/corpus", *columns)] == ["d"]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")
