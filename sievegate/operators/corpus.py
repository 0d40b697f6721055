"""Chunk rows, document assembly and corpus integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievegate.functions.chunks import CHUNK_OVERLAP, CHUNK_SIZE, chunk_texts
from sievegate.operators.quantiles import nearest_rank


def explode_chunks(
    df: DataFrame, text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """One row per chunk with its 0-based ordinal; ``text`` becomes the chunk's text.

    The outer form matters: for a plain explode Spark adds a non-empty filter on the list
    below it, which would run the window walk a second time.
    """
    kept = [c for c in df.columns if c != text]
    pieces = df.withColumn("_pieces", chunk_texts(F.col(text), size, overlap))
    return (
        pieces.select(*kept, F.posexplode_outer("_pieces").alias("chunk_ord", "text"))
        .filter(F.col("chunk_ord").isNotNull())
        .withColumn("char_len", F.length("text"))
    )


def whole_texts(chunks: DataFrame, titles: DataFrame, max_chars: int = 4000) -> DataFrame:
    """Title and chunk texts of a document joined in order, cut to ``max_chars``.

    A chunk that begins beyond the cut cannot reach the result. Where it begins is the sum of the
    lengths before it, so a document gathers ``max_chars`` characters and one chunk at most.
    """
    in_order = F.array_sort(F.collect_list(F.struct("chunk_ord", "text")))
    before = Window.partitionBy("doc_id").orderBy("chunk_ord").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.sum(F.length("text") + 1).over(before), F.lit(0))
    bodies = (
        chunks.filter(F.col("chunk_ord") < max_chars)
        .select("doc_id", "chunk_ord", "text", begins.alias("_begins"))
        .filter(F.col("_begins") < max_chars)
        .groupBy("doc_id")
        .agg(F.transform(in_order, lambda c: c["text"]).alias("_texts"))
    )
    joined = F.concat_ws("\n", F.col("title"), F.array_join("_texts", "\n"))
    return (
        titles.select("doc_id", "title")
        .join(bodies, "doc_id")
        .select("doc_id", F.substring(joined, 1, max_chars).alias("text"))
    )


def integrity_profile(corpus: DataFrame) -> DataFrame:
    """One row of counts that must be zero, next to the corpus size."""
    broken = F.lit(False)
    for column in corpus.columns:
        broken = broken | F.col(column).isNull()
    positions = corpus.groupBy("doc_id", "chunk_ord").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min("thread_id").alias("thread_id"),
        F.count_if(F.col("text") == "").alias("empty"),
        F.count_if(F.length("text") != F.col("char_len")).alias("wrong_length"),
        F.count_if(broken).alias("nulls"),
    )
    documents = positions.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_positions"),
        F.sum("copies").alias("n_chunks"),
        F.max("chunk_ord").alias("last"),
        F.min("thread_id").alias("thread_id"),
        F.sum("empty").alias("empty"),
        F.sum("wrong_length").alias("wrong_length"),
        F.sum("nulls").alias("nulls"),
    )
    gaps = (F.col("last") + 1 != F.col("n_positions")) | (
        F.col("n_positions") != F.col("n_chunks")
    )
    return documents.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_distinct("thread_id").alias("threads"),
        F.sum("n_chunks").alias("chunks"),
        F.sum("empty").alias("empty_texts"),
        F.sum("wrong_length").alias("length_mismatches"),
        F.sum("nulls").alias("rows_with_nulls"),
        F.count_if(gaps).alias("documents_with_gaps"),
        F.sum(F.col("n_chunks") - F.col("n_positions")).alias("duplicate_keys"),
    )


def chunks_per_document(corpus: DataFrame, quantiles: tuple[float, ...]) -> DataFrame:
    """Nearest-rank quantiles of the number of chunks a document has."""
    sizes = corpus.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chunks"))
    return nearest_rank(sizes, [], "n_chunks", quantiles)
