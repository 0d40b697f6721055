"""Corpus, labels and vectors to the searchable document and chunk tables."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievegate.functions.acl import team_by_sha
from sievegate.functions.text import chunk_id, encoder_input
from sievegate.operators.encode import Encoder, block_of, encoder_column, hashed_vectors
from sievegate.operators.labelling import attach_document_label
from sievegate.operators.trainset import key_differences
from sievegate.operators.upsert import grant_roles, pending_rows, update_vectors, upsert
from sievegate.schemas import CHUNKS, CORPUS, DOCUMENTS, WEAK_LABELS
from sievegate.sources.files import (
    KEY,
    read_encoder_rows,
    read_table,
    read_vector_blocks,
    write_table,
    write_vector_blocks,
)

# Bytes of vectors in a block; a block is one folder and one task's work.
BLOCK_BYTES = 64 << 20


def embed_rows(
    rows: DataFrame, dim: int, load_encoder: Callable[[], Encoder] | None = None, style: str = "document"
) -> DataFrame:
    """``doc_id, chunk_ord, vector`` from ``title, text``; hashing is the default encoder."""
    ready = rows.select("doc_id", "chunk_ord", encoder_input(F.col("title"), F.col("text"), style).alias("_input"))
    if load_encoder is None:
        return hashed_vectors(ready, "_input", dim).select("doc_id", "chunk_ord", "vector")
    return ready.select(
        "doc_id", "chunk_ord", encoder_column(F.col("_input"), load_encoder, dim).alias("vector")
    )


def run_embed(
    spark: SparkSession, corpus: str, out: str, dim: int, n_blocks: int | None = None,
    load_encoder: Callable[[], Encoder] | None = None,
) -> dict:
    """Encode the rows whose vectors are not stored yet; returns row and block counts.

    Every run adds blocks of its own behind those it finds, so an interrupted run is continued, a
    grown corpus adds its new rows, and no key is ever stored twice. ``n_blocks`` fixes the number
    of blocks that this run adds.
    """
    started = time.monotonic()
    rows = read_encoder_rows(spark, corpus)
    stored, first, pending = stored_table(spark, out), 0, rows
    if stored is not None:
        last = stored.agg(F.max(F.col("block").cast("int"))).first()[0]
        first = 0 if last is None else last + 1
        pending = pending_rows(rows, stored, KEY)
    missing = pending.count()
    blocks = n_blocks or -(-missing // max(1, BLOCK_BYTES // (4 * dim)))
    if missing or stored is None:
        number = block_of(KEY, max(1, blocks)) + first
        write_vector_blocks(embed_rows(pending, dim, load_encoder).withColumn("block", number), out, dim)
    stored = read_vector_blocks(spark, out, dim)
    match = key_differences(rows, stored).first()
    if match["only_left"] or match["only_right"]:
        raise ValueError(f"vector keys differ from corpus keys: {match.asDict()}")
    return {
        "rows": match["shared"], "added": missing, "blocks": blocks, "dim": dim, "seconds": round(time.monotonic() - started, 1)
    }


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored Parquet table, or None when nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def document_rows(corpus: DataFrame, labels: DataFrame, source: str = "aeslc") -> DataFrame:
    """Incoming document rows: one per document with its strictest chunk label."""
    message = F.concat(F.lit("several titles or threads of document "), F.col("doc_id"))
    documents = corpus.groupBy("doc_id").agg(
        *[f(F.struct("title", "thread_id")).alias(n) for f, n in ((F.min, "_first"), (F.max, "_last"))]
    )
    one = F.when(F.col("_first") == F.col("_last"), F.col("_first"))
    one = F.coalesce(one, F.when(F.raise_error(message).cast("boolean"), F.col("_first")))
    documents = documents.select("doc_id", one.alias("_one")).select("doc_id", "_one.title", "_one.thread_id")
    return attach_document_label(documents, labels).select(
        F.col("doc_id").alias("id"),
        F.lit(source).alias("source"),
        "title",
        F.lit("text").alias("modality"),
        F.lit("en").alias("lang"),
        "thread_id",
        "label",
    )


def chunk_rows(corpus: DataFrame) -> DataFrame:
    return corpus.select(
        chunk_id(F.col("doc_id"), F.col("chunk_ord")).alias("id"),
        "doc_id",
        F.col("chunk_ord").alias("ord"),
        "text",
    )


def refresh_documents(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Known documents take title, thread and label; grants are kept, new ones see nobody."""
    nobody = F.array().cast("array<string>")
    return upsert(
        stored, incoming, "id", ["title", "thread_id", "label"], {"allowed_roles": nobody}
    )


def refresh_chunks(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Known chunks take the new text and keep their vector."""
    return upsert(stored, incoming, "id", ["text"])


def attach_vectors(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    staged = vectors.select(
        chunk_id(F.col("doc_id"), F.col("chunk_ord")).alias("id"), F.col("vector").alias("embedding")
    )
    return update_vectors(chunks, staged)


def seed_grants(documents: DataFrame, team=team_by_sha) -> DataFrame:
    return grant_roles(documents, team, "id")


def run_index(spark: SparkSession, corpus: str, labels: str, vectors: str, out: str, dim: int) -> dict:
    """Refresh ``out/documents`` and ``out/chunks`` from a corpus, its labels and vectors.

    Known rows are updated in place of their key, grants are seeded again, vectors replaced
    where new ones exist. The new tables are written beside the old ones and named by the
    returned version, so readers of the previous version are not disturbed.
    """
    chunks, weak = read_table(spark, corpus, CORPUS), read_table(spark, labels, WEAK_LABELS)
    versions = stored_table(spark, f"{out}/versions")
    last = versions.agg(F.max("version")).first()[0] if versions is not None else None

    def previous(name: str, schema) -> DataFrame:
        if last is None:
            return spark.createDataFrame([], schema)
        return read_table(spark, f"{out}/{name}/version={last}", schema)

    version = 0 if last is None else last + 1
    documents = refresh_documents(previous("documents", DOCUMENTS), document_rows(chunks, weak))
    seeded = seed_grants(documents)
    texts = refresh_chunks(previous("chunks", CHUNKS), chunk_rows(chunks))
    filled = attach_vectors(texts, read_vector_blocks(spark, vectors, dim))
    stored_docs = write_table(seeded, f"{out}/documents/version={version}", DOCUMENTS)
    stored_chunks = write_table(filled, f"{out}/chunks/version={version}", CHUNKS)
    counts = {"version": version, "documents": stored_docs.count(), "chunks": stored_chunks.count()}
    spark.createDataFrame([counts]).write.mode("append").parquet(f"{out}/versions")
    return counts


def read_index(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """Documents and chunks of the newest version, named for searching."""
    version = spark.read.parquet(f"{out}/versions").agg(F.max("version")).first()[0]
    documents = read_table(spark, f"{out}/documents/version={version}", DOCUMENTS)
    chunks = read_table(spark, f"{out}/chunks/version={version}", CHUNKS)
    return documents.withColumnRenamed("id", "doc_id"), chunks.withColumnRenamed("id", "chunk_id")
