"""Corpus to weak labels, review sample and split manifests."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession

from sievegate.operators.labelling import label_chunks, label_distribution, review_sample
from sievegate.operators.splits import assign_splits, split_counts
from sievegate.schemas import CORPUS, WEAK_LABELS
from sievegate.sources.files import read_table, write_manifest, write_rows, write_stats, write_table


def run(
    spark: SparkSession, corpus: str, out: str, gold_dir: str | None = None, sample: int = 200,
    splits: bool = False, seed: int = 42,
) -> dict:
    """Write labels and, when asked, ``candidates`` and ``splits`` below ``gold_dir``."""
    started = time.monotonic()
    chunks = read_table(spark, corpus, CORPUS)
    labels = write_table(label_chunks(chunks), out, WEAK_LABELS)
    distribution = {r["label"]: r["n"] for r in label_distribution(labels).collect()}
    stats: dict = {"chunks": sum(distribution.values()), "label_dist": distribution}
    if gold_dir and sample:
        write_rows(
            review_sample(chunks, labels, sample, seed).orderBy("doc_id", "chunk_ord"),
            f"{gold_dir}/candidates",
        )
        found = spark.read.json(f"{gold_dir}/candidates").count()
        if found < sample:
            raise ValueError(f"corpus too small for a sample of {sample}: {found} chunks")
        stats["gold_candidates"] = found
    if gold_dir and splits:
        manifest = assign_splits(chunks)
        write_manifest(manifest, f"{gold_dir}/splits")
        stats["splits"] = {r["split"]: r["n_docs"] for r in split_counts(manifest).collect()}
    stats["seconds"] = round(time.monotonic() - started, 1)
    write_stats(spark, stats, f"{out.rstrip('/')}-stats")
    return stats

