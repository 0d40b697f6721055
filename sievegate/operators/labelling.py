"""Weak labels per chunk, document labels, samples and agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievegate.functions.acl import EVERYONE, label_rank
from sievegate.functions.rules import evidence, folded, label_from_evidence, searched_text
from sievegate.operators.ranking import hash_order, number_rows, top_k_per_group
from sievegate.schemas import LABELS

DEFAULT_LABEL = "internal"


def with_evidence(df: DataFrame, title: str = "title", text: str = "text") -> DataFrame:
    """Adds one boolean per rule, prefixed ``has_``; each pattern runs once per row."""
    blob = df.withColumn("_blob", searched_text(F.col(title), F.col(text)))
    blob = blob.withColumn("_low", folded(F.col("_blob")))
    tests = evidence(F.col("_blob"), F.col("_low"))
    found = {f"has_{name}": test for name, test in tests.items()}
    return blob.withColumns(found).drop("_blob", "_low")


def label_chunks(corpus: DataFrame) -> DataFrame:
    """``doc_id, chunk_ord, label, pii, rules`` for every chunk."""
    marked = with_evidence(corpus)
    names = [c for c in marked.columns if c.startswith("has_")]
    outcome = label_from_evidence({c.removeprefix("has_"): F.col(c) for c in names})
    return marked.select(
        "doc_id", "chunk_ord", *[value.alias(name) for name, value in outcome.items()]
    )


def label_distribution(labels: DataFrame, label: str = "label") -> DataFrame:
    return labels.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def document_labels(labels: DataFrame) -> DataFrame:
    """Strictest chunk label per document (an integer maximum, so it combines early)."""
    ranked = labels.groupBy("doc_id").agg(
        F.max(F.coalesce(label_rank(F.col("label")), F.lit(0))).alias("_rank")
    )
    return ranked.select("doc_id", F.get(F.array(*map(F.lit, LABELS)), F.col("_rank")).alias("label"))


def attach_document_label(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with their label; documents nobody labelled count as internal."""
    return documents.join(document_labels(labels), "doc_id", "left").withColumn(
        "label", F.coalesce("label", F.lit(DEFAULT_LABEL))
    )


def review_sample(corpus: DataFrame, labels: DataFrame, n: int = 200, seed: int = 42) -> DataFrame:
    """``n`` chunks for review: a third per label, the remainder from everything else.

    Ordering by a digest makes the sample independent of partitioning. Keys are picked
    first and the texts joined to the few picked keys afterwards.
    """
    keys = labels.select("doc_id", "chunk_ord", "label").join(
        corpus.select("doc_id", "chunk_ord"), ["doc_id", "chunk_ord"]
    )
    drawn = keys.withColumns(
        {
            "_draw": hash_order(seed, F.col("doc_id"), F.col("chunk_ord")),
            "_fill": hash_order(seed + 1, F.col("doc_id"), F.col("chunk_ord")),
        }
    )
    share = n // 3
    per_label = top_k_per_group(
        drawn.filter(F.col("label").isin(*LABELS)),
        ["label"],
        [F.col("_draw"), F.col("doc_id"), F.col("chunk_ord")],
        share,
    )
    # At most 3 * share of the best fill candidates can already be in a stratum.
    filling = drawn.orderBy("_fill", "doc_id", "chunk_ord").limit(n + 3 * share)
    candidates = per_label.select("doc_id", "chunk_ord", F.lit(0).alias("_tier"), F.col("_draw").alias("_at"))
    candidates = candidates.unionByName(
        filling.select("doc_id", "chunk_ord", F.lit(1).alias("_tier"), F.col("_fill").alias("_at"))
    )
    picked = (
        candidates.groupBy("doc_id", "chunk_ord")
        .agg(F.min(F.struct("_tier", "_at")).alias("_first"))
        .orderBy("_first", "doc_id", "chunk_ord")
        .limit(n)
        .select("doc_id", "chunk_ord")
    )
    return (
        corpus.join(picked, ["doc_id", "chunk_ord"])
        .join(labels.select("doc_id", "chunk_ord", "label", "pii"), ["doc_id", "chunk_ord"])
        .select(
            "doc_id",
            "chunk_ord",
            "text",
            "title",
            F.col("label").alias("weak_label"),
            F.col("pii").alias("weak_pii"),
        )
    )


def stratified_folds(
    df: DataFrame, keys: list[str], label: str, folds: int = 5, seed: int = 42
) -> DataFrame:
    """Adds ``fold``: shuffled inside each label, sizes per label differ by at most one."""
    draw = hash_order(seed, *[F.col(k) for k in keys])
    numbered = number_rows(
        df.withColumn("_draw", draw),
        [F.col("_draw"), *[F.col(k) for k in keys]],
        F.substring("_draw", 1, 4),
        partition_by=[label],
        name="_position",
    )
    return numbered.withColumn("fold", F.pmod(F.col("_position"), F.lit(folds)).cast("int")).drop(
        "_draw", "_position"
    )


def weak_gold_agreement(gold: DataFrame) -> DataFrame:
    """Counts per (weak, gold) pair with the overall agreement rate on every row."""
    pairs = gold.groupBy("weak_label", "gold_label").agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(0))  # over the few label pairs, not over the rows
    same = F.when(F.col("weak_label") == F.col("gold_label"), F.col("n")).otherwise(0)
    return pairs.withColumn("agreement", F.sum(same).over(every) / F.sum("n").over(every))


def index_profile(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """Long table ``metric, key, n`` describing the searchable state."""

    def rows(df: DataFrame, metric: str, key) -> DataFrame:
        return df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(metric).alias("metric"), "key", "n"
        )

    exposed = documents.filter(
        (F.col("label") == "confidential") & F.array_contains("allowed_roles", EVERYONE)
    )
    return (
        rows(documents, "label", F.col("label"))
        .unionByName(rows(documents, "modality", F.col("modality")))
        .unionByName(
            chunks.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit("chunks").alias("metric"), F.lit("all").alias("key"), "n"
            )
        )
        .unionByName(
            chunks.agg(F.count_if(F.col("embedding").isNull()).alias("n")).select(
                F.lit("chunks").alias("metric"), F.lit("without_vector").alias("key"), "n"
            )
        )
        .unionByName(
            exposed.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit("label").alias("metric"), F.lit("confidential_to_everyone").alias("key"), "n"
            )
        )
    )
