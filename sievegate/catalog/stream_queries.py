"""Incremental runs over the text table."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievegate.catalog import tables as t
from sievegate.catalog.registry import registry
from sievegate.session import scratch_path
from sievegate.streaming.incremental import message_stream, start_prep

QUERIES, ORACLES, query = registry()


def _stream(spark, d):
    """The documents table read as a stream of new files, prepared until it is drained."""
    out = scratch_path(spark, "incremental")
    schema = spark.read.parquet(f"{d}/documents.parquet").schema
    arrived = message_stream(spark, f"{d}/documents.parquet", schema)
    start_prep(arrived, f"{out}/tables", f"{out}/progress", t.as_messages).awaitTermination()
    return f"{out}/tables"


@query(
    "incremental_corpus",
    t.with_tables("corpus", "SELECT doc_id, chunk_ord, char_len, md5(text) AS digest FROM corpus"),
)
def incremental_corpus(spark, d):
    stored = spark.read.parquet(f"{_stream(spark, d)}/corpus")
    return stored.select("doc_id", "chunk_ord", "char_len", F.md5("text").alias("digest"))


@query(
    "incremental_labels",
    t.with_tables("corpus_labels", "SELECT label, count(*) AS n FROM corpus_labels GROUP BY label"),
)
def incremental_labels(spark, d):
    stored = spark.read.parquet(f"{_stream(spark, d)}/labels")
    return stored.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


# Splits arrive one after the other, last name first; of copies the first to arrive stays.
_ARRIVAL = t.SQL["uniq"].replace("ORDER BY doc_id", "ORDER BY split DESC, doc_id")


@query(
    "incremental_deliveries",
    t.with_tables(
        "corpus",
        """SELECT doc_id, chunk_ord, md5(text) AS digest,
        CASE split WHEN 'validation' THEN 0 WHEN 'train' THEN 1 ELSE 2 END::BIGINT AS batch FROM corpus""",
    ).replace(t.SQL["uniq"], _ARRIVAL),
)
def incremental_deliveries(spark, d):
    """Three deliveries in runs of their own, then all files once more, which must add nothing."""
    out = scratch_path(spark, "deliveries")
    messages = t.raw_messages(spark, d)
    for splits in (["validation"], ["train"], ["test"], ["validation", "train", "test"]):
        messages.filter(F.col("split").isin(splits)).write.mode("append").parquet(f"{out}/inbox")
        arrived = message_stream(spark, f"{out}/inbox", messages.schema)
        start_prep(arrived, f"{out}/tables", f"{out}/progress").awaitTermination()
    stored = spark.read.parquet(f"{out}/tables/corpus")
    return stored.select("doc_id", "chunk_ord", F.md5("text").alias("digest"), F.col("batch").cast("bigint").alias("batch"))
