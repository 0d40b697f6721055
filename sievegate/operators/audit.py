"""Leak audits over users x queries and over answered requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievegate.operators.permission import recheck


def all_requests(queries: DataFrame, users: dict[str, tuple[str, ...]]) -> DataFrame:
    """Every user asks every query; the users are a short literal list on each row."""
    names = F.array(*[F.lit(name) for name in users])
    return queries.select(F.explode(names).alias("user"), "qid")


def request_counts(requests: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """``user, qid, n_hits, short`` for every request, also those without any hit."""
    counted = hits.groupBy("user", "qid").agg(F.count(F.lit(1)).alias("n_hits"))
    return (
        requests.select("user", "qid")
        .join(counted, ["user", "qid"], "left")
        .withColumn("n_hits", F.coalesce("n_hits", F.lit(0)))
        .withColumn("short", F.col("n_hits") < k)
    )


def shortfalls(requests: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """Requests that got fewer than k hits."""
    return request_counts(requests, hits, k).filter("short").drop("short")


def leak_audit(
    requests: DataFrame, hits: DataFrame, documents: DataFrame, users: DataFrame, k: int
) -> DataFrame:
    """Per user: queries, hits checked and expected, short requests, violations, ``passed``.

    An audit without hits does not pass: every request has to be filled.
    """
    checked = recheck(hits, documents, users)
    verdicts = checked.groupBy("user", "qid").agg(
        F.count(F.lit(1)).alias("n_hits"), F.count_if(~F.col("visible")).alias("n_bad")
    )
    per_request = requests.select("user", "qid").join(verdicts, ["user", "qid"], "left")
    n_hits = F.coalesce("n_hits", F.lit(0))
    return (
        per_request.groupBy("user")
        .agg(
            F.count(F.lit(1)).alias("queries"),
            F.sum(n_hits).alias("hits_checked"),
            (F.count(F.lit(1)) * k).alias("expected_hits"),
            F.count_if(n_hits < k).alias("shortfalls"),
            F.sum(F.coalesce("n_bad", F.lit(0))).alias("violations"),
        )
        .withColumn(
            "passed", (F.col("violations") == 0) & (F.col("hits_checked") == F.col("expected_hits"))
        )
    )


def stray_citations(cited: DataFrame, returned: DataFrame) -> DataFrame:
    """Cited documents that were not among the returned hits."""
    return cited.join(returned.select("user", "qid", "doc_id"), ["user", "qid", "doc_id"], "left_anti")


def response_audit(responses: DataFrame, documents: DataFrame, users: DataFrame) -> DataFrame:
    """One row over ``user, qid, mode, answer, hits, citations`` responses.

    An answer in fast mode, a citation outside the hits, and a hit that is missing or
    forbidden are violations; an empty answer is only reported.
    """
    hits = responses.select("user", "qid", "mode", F.explode("hits").alias("doc_id"))
    bad_hits = recheck(hits, documents, users).agg(
        F.count(F.lit(1)).alias("checked"), F.count_if(~F.col("visible")).alias("forbidden_hits")
    )
    stray = F.size(F.array_except("citations", "hits")) > 0
    shape = responses.agg(
        F.count(F.lit(1)).alias("responses"),
        F.count_if((F.col("mode") == "fast") & F.col("answer").isNotNull()).alias("mode_leaks"),
        F.count_if(
            (F.col("mode") == "answer") & (F.coalesce("answer", F.lit("")) == "")
        ).alias("empty_answers"),
        F.count_if((F.col("mode") == "answer") & F.coalesce(stray, F.lit(False))).alias(
            "citation_drifts"
        ),
    )
    counts = ["responses", "mode_leaks", "empty_answers", "citation_drifts", "checked", "forbidden_hits"]
    both = shape.unionByName(bad_hits, allowMissingColumns=True)
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]).withColumn(
        "violations", F.col("mode_leaks") + F.col("citation_drifts") + F.col("forbidden_hits")
    )
