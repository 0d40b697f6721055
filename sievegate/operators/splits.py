"""Thread-wise train / dev / test splits and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Percentage boundaries of the splits.
SPLIT_BOUNDS = (("train", 0, 80), ("dev", 80, 90), ("test", 90, 100))


def thread_bucket(thread_id: Column, method: str = "murmur") -> Column:
    """0..99 per thread. ``murmur`` is Spark's ``hash``; ``sha`` is portable across engines."""
    if method == "murmur":
        return F.abs(F.hash(thread_id) % 100)
    if method == "sha":
        head = F.conv(F.substring(F.sha2(thread_id, 256), 1, 8), 16, 10).cast("long")
        return (head % 100).cast("int")
    raise ValueError(f"unknown bucket method {method!r}")


def split_name(bucket: Column) -> Column:
    name = F.lit(None).cast("string")
    for split, low, high in SPLIT_BOUNDS:
        name = F.when((bucket >= low) & (bucket < high), F.lit(split)).otherwise(name)
    return name


def assign_splits(corpus: DataFrame, method: str = "murmur") -> DataFrame:
    """``doc_id, thread_id, split``: every document of a thread lands in one split."""
    documents = corpus.select("doc_id", "thread_id").distinct()
    return documents.withColumn("split", split_name(thread_bucket(F.col("thread_id"), method)))


def split_counts(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("split").agg(F.count(F.lit(1)).alias("n_docs"))


def split_violations(documents: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row of counts, all zero for a sound split.

    ``uncovered`` documents are in no manifest, ``unknown`` manifest ids in no document,
    ``repeated`` ids in several splits, ``torn_threads`` have documents in several splits.
    """
    known = documents.select("doc_id", "thread_id").distinct()
    owners = manifest.groupBy("doc_id").agg(
        F.min("split").alias("first"), F.max("split").alias("last")
    )
    joined = known.join(owners, "doc_id", "full_outer")
    by_thread = joined.groupBy("thread_id").agg(
        F.count_if(F.col("first").isNull()).alias("uncovered"),
        F.count_if(F.col("thread_id").isNull()).alias("unknown"),
        F.count_if(F.col("first") != F.col("last")).alias("repeated"),
        (
            F.col("thread_id").isNotNull()
            & (F.coalesce(F.min("first") != F.max("last"), F.lit(False)))
        ).alias("torn"),
    )
    return by_thread.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("uncovered", "unknown", "repeated")],
        F.count_if("torn").alias("torn_threads"),
    )
