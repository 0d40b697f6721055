"""Raw messages to a cleaned, de-duplicated, chunked corpus."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sievegate.functions.chunks import CHUNK_OVERLAP, CHUNK_SIZE
from sievegate.functions.text import clean_text, content_doc_id, thread_id
from sievegate.operators.corpus import explode_chunks
from sievegate.operators.dedupe import copy_counts, drop_normalized_copies
from sievegate.schemas import CORPUS
from sievegate.sources.files import read_raw_splits, write_stats, write_table


def clean_messages(raw: DataFrame, id_digits: int = 32) -> DataFrame:
    """``doc_id, thread_id, split, title, cleaned`` for messages with any text left."""
    body, subject = F.col("email_body"), F.col("subject_line")
    # A filter on the cleaned text would be pushed down and clean every text twice. Exploding
    # a list of at most one text drops the empty ones with a single evaluation.
    texts = F.filter(F.array(clean_text(body)), lambda text: text != "")
    return raw.select(
        content_doc_id(F.col("split"), body, subject, id_digits).alias("doc_id"),
        thread_id(subject).alias("thread_id"),
        "split",
        F.coalesce(subject, F.lit("")).alias("title"),
        F.explode_outer(texts).alias("cleaned"),
    ).filter(F.col("cleaned").isNotNull())


def chunk_messages(
    cleaned: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """Corpus rows from unique messages."""
    chunks = explode_chunks(cleaned, "cleaned", size, overlap)
    return chunks.select(*CORPUS.fieldNames())


def build_corpus(
    raw: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, id_digits: int = 32
) -> DataFrame:
    """The corpus; among copies the one with the smallest document id survives.

    One shuffle (on the text digest). Cleaning runs before it and chunking after it.
    """
    unique = drop_normalized_copies(clean_messages(raw, id_digits), "cleaned", "doc_id")
    return chunk_messages(unique, size, overlap)


def run(
    spark: SparkSession, raw: str | DataFrame, out: str, limit: int | None = None, id_digits: int = 32
) -> dict:
    """Write the corpus and its statistics; returns the statistics.

    Row counts are observed while the corpus is written; the copy counts come from a
    second, digest-only pass.
    """
    started = time.monotonic()
    source = read_raw_splits(spark, raw) if isinstance(raw, str) else raw
    if limit is not None:
        source = source.orderBy(*source.columns).limit(limit)
    seen, left = Observation("raw"), Observation("cleaned")
    counted = source.observe(seen, F.count(F.lit(1)).alias("rows"))
    cleaned = clean_messages(counted, id_digits).observe(left, F.count(F.lit(1)).alias("rows"))
    corpus = chunk_messages(drop_normalized_copies(cleaned, "cleaned", "doc_id"))
    stored = write_table(corpus, out, CORPUS, sort_by=("doc_id", "chunk_ord"))
    copies = copy_counts(clean_messages(source, id_digits), "cleaned").first().asDict()
    stats = {
        "raw_rows": seen.get["rows"],
        "cleaned_rows": left.get["rows"],
        **copies,
        "chunk_rows": stored.count(),
        "seconds": round(time.monotonic() - started, 1),
    }
    write_stats(spark, stats, f"{out.rstrip('/')}-stats")
    return stats
