"""Batch question answering under access control, and the leak audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievegate.functions.acl import USERS, users_frame
from sievegate.functions.prompts import grounded_prompt
from sievegate.functions.text import snippet
from sievegate.operators.audit import all_requests, leak_audit
from sievegate.operators.encode import hashed_vectors
from sievegate.operators.permission import (
    answer_context,
    enforce,
    hit_rows,
    permitted_hits,
    recheck,
    with_signature,
)
from sievegate.operators.ranking import first_per_group
from sievegate.plans.index import read_index
from sievegate.sources.files import read_manifest


def search(
    requests: DataFrame, queries: DataFrame, chunks: DataFrame, documents: DataFrame,
    users: DataFrame, k: int, dim: int,
) -> DataFrame:
    """Complete hit rows for ``user, qid`` requests, re-checked before they leave.

    ``chunks``: chunk_id, doc_id, text, embedding. ``documents``: doc_id, title, modality,
    label, allowed_roles. ``queries``: qid, vector.
    """
    items = with_signature(chunks.select("chunk_id", "doc_id", "embedding"), documents)
    hits = permitted_hits(requests, queries, items, documents, users, k, dim)
    checked = enforce(recheck(hits, documents, users)).drop("visible")
    return hit_rows(checked, chunks, documents)


def answer_prompts(rows: DataFrame, questions: DataFrame, passage_chars: int = 1500) -> DataFrame:
    """``user, qid, prompt, citations`` from permitted hit rows and ``qid, text`` questions."""
    context = answer_context(rows, passage_chars)
    return context.join(questions.select("qid", "text"), "qid").select(
        "user", "qid", grounded_prompt(F.col("text"), F.col("passages")).alias("prompt"), "citations"
    )


def opening_queries(chunks: DataFrame, documents: DataFrame, length: int = 200) -> DataFrame:
    """``qid, text``: the start of each listed document's first chunk."""
    listed = chunks.join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
    first = first_per_group(listed.select("doc_id", "ord", "text"), ["doc_id"], ["ord"])
    return first.select(F.col("doc_id").alias("qid"), snippet(F.col("text"), length).alias("text"))


def run_leak_audit(
    queries: DataFrame, chunks: DataFrame, documents: DataFrame, k: int, dim: int,
    users: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """Every user asks every query; per-user totals with violations and shortfalls."""
    users = users or USERS
    names = users_frame(chunks.sparkSession, users)
    requests = all_requests(queries, users)
    items = with_signature(chunks.select("chunk_id", "doc_id", "embedding"), documents)
    hits = permitted_hits(requests, queries, items, documents, names, k, dim)
    return leak_audit(requests, hits, documents, names, k)


def audit_index(spark: SparkSession, index: str, manifest: str, dim: int, k: int = 10, split: str = "dev") -> DataFrame:
    """Leak audit of a stored index with the openings of one split as queries."""
    documents, chunks = read_index(spark, index)
    listed = read_manifest(spark, manifest).filter(F.col("split") == split)
    queries = opening_queries(chunks, listed)
    vectors = hashed_vectors(queries, "text", dim).select("qid", "vector")
    return run_leak_audit(vectors, chunks, documents, k, dim)
