"""Training data, model and comparison of classification methods."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievegate.operators import linear_model
from sievegate.operators.labelling import label_distribution
from sievegate.operators.scoring import full_summary
from sievegate.operators.trainset import (
    allowed_documents,
    document_sizes,
    exclusion_stats,
    join_vectors,
    leaked_rows,
    require_known,
    require_row_count,
    subset_by_split,
    tag_splits,
    train_rows,
)
from sievegate.schemas import CORPUS, WEAK_LABELS
from sievegate.sources.files import (
    read_gold,
    read_manifest,
    read_predictions,
    read_split_tags,
    read_table,
    write_rows,
    write_stats,
)

def run_data(
    spark: SparkSession, corpus: str, labels: str, gold: str, manifest: str, out: str,
    train_size: tuple[int | None, int | None] = (None, None), gold_size: int | None = None,
) -> dict:
    """Write ``train`` and ``eval`` rows without any thread in common; returns statistics.

    Expected sizes are checked where they are given.
    """
    started = time.monotonic()
    chunks, weak = read_table(spark, corpus, CORPUS), read_table(spark, labels, WEAK_LABELS)
    reviewed, splits = read_gold(spark, gold), read_manifest(spark, manifest)
    n_gold = require_row_count(reviewed, gold_size, gold_size, "gold rows")
    documents = document_sizes(chunks)
    require_known(reviewed, documents, "gold documents")
    train = splits.filter(F.col("split") == "train")
    allowed = allowed_documents(documents, reviewed, train)
    write_rows(train_rows(chunks, weak, allowed), f"{out}/train")
    rows = spark.read.json(f"{out}/train")
    n_train = require_row_count(rows, *train_size, "train rows")
    if leaked_rows(rows, allowed).limit(1).count():
        raise ValueError("a document of a gold thread is among the train rows")
    write_rows(tag_splits(reviewed, splits), f"{out}/eval")
    stats = {
        "train_rows": n_train,
        "eval_rows": n_gold,
        **exclusion_stats(documents, reviewed, train).first().asDict(),
        "weak_dist": {r["weak_label"]: r["n"] for r in label_distribution(rows, "weak_label").collect()},
        "seconds": round(time.monotonic() - started, 1),
    }
    write_stats(spark, stats, f"{out}/data-stats")
    return stats


def train_and_score(
    train: DataFrame, evaluation: DataFrame, vectors: DataFrame, c: float | None = None,
    extra: DataFrame | None = None, method: str = "lr",
) -> tuple[DataFrame, dict]:
    """Predictions ``method, doc_id, chunk_ord, gold, pred, probs`` and the run's settings.

    ``extra`` rows (``label, vector``) are mixed in without rebalancing. Without ``c`` it is
    chosen by cross-validation on the training rows.
    """
    rows = join_vectors(train, vectors).select(
        F.concat_ws(":", "doc_id", "chunk_ord").alias("key"), F.col("weak_label").alias("label"), "vector",
        F.lit("weak").alias("origin"),
    )
    if extra is not None:
        key = F.concat(F.lit("extra:"), F.sha2(F.array_join("vector", ","), 256))
        rows = rows.unionByName(
            extra.select(key.alias("key"), "label", "vector", F.lit("extra").alias("origin"))
        )
    means: dict[float, float] = {}
    if c is None:
        c, means = linear_model.choose_c(rows, ["key"])
    model = linear_model.fit(rows, c)
    scored = linear_model.predict(model, join_vectors(evaluation, vectors))
    settings = {"method": method, "C": c, "cv_macro_f1": means, "weights": linear_model.export_weights(model)}
    return (
        scored.select(F.lit(method).alias("method"), "doc_id", "chunk_ord", "gold", "pred", "probs"),
        settings,
    )


def compare(spark: SparkSession, results: str, eval_rows: str | None = None, skip: tuple[str, ...] = ()) -> DataFrame:
    """One full summary row per method and subset (``all`` rows, ``test`` rows only)."""
    rows = read_predictions(spark, results, skip)
    labelled = rows.withColumn("subset", F.lit("all"))
    tags = read_split_tags(spark, eval_rows) if eval_rows else None
    if tags is not None:
        test = subset_by_split(rows, tags).withColumn("subset", F.lit("test"))
        labelled = labelled.unionByName(test)
    cost = rows.groupBy("method").agg(F.max("cost_per_1k_usd").alias("cost_per_1k_usd"))
    return full_summary(labelled, ["method", "subset"]).join(cost, "method")


def comparison_table(summary: DataFrame) -> str:
    """Markdown table of the handful of summary rows."""
    columns = ["method", "subset", "n", "accuracy", "accuracy_lo", "accuracy_hi", "macro_f1", "ece", "p50", "p95"]
    lines = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    for row in summary.select(*columns).orderBy("subset", "method").collect():
        cells = [f"{v:.3f}" if isinstance(v, float) else str(v) for v in row]
        lines.append("| " + " | ".join(cells) + " |")
    return "\n".join(lines)
