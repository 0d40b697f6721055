"""Removal of exact and near-identical copies, with counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievegate.functions.text import dedupe_key


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _keep_first(df: DataFrame, key: Column, keep_by: str) -> DataFrame:
    """One row per key: the smallest ``keep_by``, remaining columns as tie-break.

    The digest is the shuffle key and copies already collapse on the map side, so a text
    repeated across a third of the input costs one row per task.
    """
    rest = [c for c in df.columns if c != keep_by]
    kept = df.groupBy(key.alias("_digest")).agg(F.min(F.struct(keep_by, *rest)).alias("_kept"))
    return kept.select("_kept.*").select(*df.columns)


def drop_exact_copies(df: DataFrame, text: str, keep_by: str) -> DataFrame:
    return _keep_first(df, _digest(F.col(text)), keep_by)


def drop_normalized_copies(df: DataFrame, text: str, keep_by: str) -> DataFrame:
    """Copies up to case and white space; exact copies share the key, so one pass does both."""
    return _keep_first(df, _digest(dedupe_key(F.col(text))), keep_by)


def copy_counts(df: DataFrame, text: str) -> DataFrame:
    """One row: rows in, after exact, after normalised removal, and both differences.

    Works on digests only, by nested counting instead of several distinct aggregates.
    """
    digests = df.select(
        _digest(dedupe_key(F.col(text))).alias("normal"), _digest(F.col(text)).alias("exact")
    )
    by_text = digests.groupBy("normal", "exact").agg(F.count(F.lit(1)).alias("n"))
    by_norm = by_text.groupBy("normal").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_exact")
    )
    totals = by_norm.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("input"),
        F.coalesce(F.sum("n_exact"), F.lit(0)).alias("after_exact"),
        F.count(F.lit(1)).alias("after_normalized"),
    )
    return totals.withColumns(
        {
            "exact_removed": F.col("input") - F.col("after_exact"),
            "normalized_removed": F.col("after_exact") - F.col("after_normalized"),
        }
    )
