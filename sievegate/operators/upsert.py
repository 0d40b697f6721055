"""Merging new rows into stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievegate.functions.acl import assigned_roles, role_set_key


def _unique(rows: DataFrame, key: str) -> DataFrame:
    """``rows``; running it fails if a key comes twice, which would multiply stored rows."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_times"))
    message = F.concat(F.lit(f"{key} comes more than once: "), F.col(key).cast("string"))
    once = F.when(F.col("_times") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
    return rows.join(counts, key).filter(once).select(*rows.columns)


def upsert(
    stored: DataFrame, incoming: DataFrame, key: str, updated: Sequence[str], defaults: dict | None = None
) -> DataFrame:
    """Insert new keys; for known keys replace only the ``updated`` columns.

    ``incoming`` has one row per key, more are an error. Columns it lacks keep their stored
    value, and new rows take them from ``defaults``.
    """
    defaults = defaults or {}
    incoming = _unique(incoming, key)
    joined = stored.withColumn("_old", F.lit(True)).alias("s").join(
        incoming.withColumn("_new", F.lit(True)).alias("i"), key, "full_outer"
    )
    columns = []
    for name in stored.columns:
        if name == key:
            columns.append(F.col(key))
            continue
        new = F.col(f"i.{name}") if name in incoming.columns else defaults.get(name, F.lit(None))
        old = F.col(f"s.{name}")
        if name in updated:
            value = F.when(F.col("_new"), new).otherwise(old)
        else:
            value = F.when(F.col("_old"), old).otherwise(new)
        columns.append(value.cast(stored.schema[name].dataType).alias(name))
    return joined.select(*columns)


def update_vectors(chunks: DataFrame, staged: DataFrame, key: str = "id") -> DataFrame:
    """Vectors replaced by staged ones; staged keys without a chunk are ignored, repeated ones an error."""
    stage = _unique(staged.select(key, F.col("embedding").alias("_staged")), key)
    return (
        chunks.join(stage, key, "left")
        .withColumn("embedding", F.coalesce("_staged", "embedding"))
        .drop("_staged")
        .select(*chunks.columns)
    )


def staging_counts(chunks: DataFrame, staged: DataFrame, key: str = "id") -> DataFrame:
    """One row: rows staged and rows that found their chunk."""
    marked = staged.select(key).join(
        chunks.select(key, F.lit(1).alias("_hit")), key, "left"
    )
    return marked.agg(
        F.count(F.lit(1)).alias("staged"), F.count("_hit").alias("matched")
    )


def grant_roles(documents: DataFrame, team, doc_id: str = "doc_id") -> DataFrame:
    """Documents with seeded ``allowed_roles``; ``team`` maps a key column to a team column."""
    needs_team = (F.col("modality") != "image") & (F.col("label") != "public")
    picked = team(F.when(needs_team, F.col(doc_id)))
    return documents.withColumn(
        "allowed_roles", assigned_roles(F.col("label"), F.col("modality"), picked)
    )


def role_set_counts(documents: DataFrame) -> DataFrame:
    return documents.groupBy(role_set_key(F.col("allowed_roles")).alias("role_set")).agg(
        F.count(F.lit(1)).alias("n_docs")
    )


def pending_rows(rows: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key has no result yet; rerunning a finished job yields nothing."""
    return rows.join(done.select(*keys), list(keys), "left_anti")
