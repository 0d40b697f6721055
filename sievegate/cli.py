"""Command line for the batch jobs: ``python -m sievegate.cli <job> ...`` or spark-submit."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from sievegate.operators.encode import hashed_vectors
from sievegate.plans import bench, classify, index, labels, prep, search
from sievegate.session import build_session
from sievegate.sources import files


def _sweep(spark, a):
    """Hashed vectors of the frozen queries against the stored chunks, every variant."""
    _, chunks = index.read_index(spark, a.index)
    frozen = files.read_frozen_queries(spark, a.queries)
    prompted = frozen.withColumn("text", F.concat(F.lit(bench.QUERY_PROMPT), "text"))
    asked = {
        name: hashed_vectors(rows, "text", a.dim).select("qid", "vector", "relevant_doc")
        for name, rows in (("prompted", prompted), ("plain", frozen))
    }
    scores = bench.sweep_scores(bench.VARIANTS, asked, chunks, a.dim)
    summary = bench.sweep_summary(scores)
    files.write_rows(summary, a.out)
    return [r.asDict() for r in spark.read.json(a.out).collect()]


def _freeze(spark, a):
    documents, chunks = index.read_index(spark, a.index)
    frozen = bench.freeze_queries(documents, chunks, a.per_kind)
    files.write_rows(frozen, a.out)
    stored = files.read_frozen_queries(spark, a.out)
    kinds = {r.kind: r["count"] for r in stored.groupBy("kind").count().collect()}
    return {**kinds, **files.content_digest(stored).first().asDict()}


def _leak(spark, a):
    table = search.audit_index(spark, a.index, a.splits, a.dim, a.k)
    rows = [r.asDict() for r in table.collect()]
    return {"users": rows, "passed": bool(rows) and all(r["passed"] for r in rows)}


def _train(spark, a):
    train = spark.read.json(a.train)
    evaluation = files.read_eval_rows(spark, a.eval).select("doc_id", "chunk_ord", "gold")
    vectors = files.read_vector_blocks(spark, a.vectors, a.dim)
    scored, settings = classify.train_and_score(train, evaluation, vectors, a.c, method=a.method)
    files.write_predictions(scored, a.out, a.method)
    weights = settings.pop("weights")
    if a.weights:
        classify.linear_model.save_weights(spark, weights, a.weights)
    written = files.read_predictions(spark, a.out).filter(F.col("method") == a.method)
    return {**settings, "rows": written.count()}


_NOTES = 100  # files named in the report


def _compare(spark, a):
    summary = classify.compare(spark, a.results, a.eval, tuple(a.skip))
    files.write_rows(summary, a.out)
    print(classify.comparison_table(summary), file=sys.stderr)
    skipped = [r.file for r in files.unreadable_predictions(spark, a.results).orderBy("file").limit(_NOTES).collect()]
    return {"methods": summary.select(F.count_distinct("method")).first()[0], "skipped_files": skipped}


JOBS = {
    "prep": (lambda s, a: prep.run(s, a.raw, a.out, a.limit), ["raw", "out"], {"limit": int}),
    "labels": (
        lambda s, a: labels.run(s, a.corpus, a.out, a.gold_dir, a.sample or 0, bool(a.splits)),
        ["corpus", "out"], {"gold-dir": str, "sample": int, "splits": int},
    ),
    "embed": (lambda s, a: index.run_embed(s, a.corpus, a.out, a.dim, a.blocks), ["corpus", "out", "dim"], {"blocks": int}),
    "index": (
        lambda s, a: index.run_index(s, a.corpus, a.labels, a.vectors, a.out, a.dim),
        ["corpus", "labels", "vectors", "out", "dim"], {},
    ),
    "leak": (_leak, ["index", "splits", "dim", "k"], {}),
    "freeze": (_freeze, ["index", "out", "per-kind"], {}),
    "sweep": (_sweep, ["index", "queries", "out", "dim"], {}),
    "classify-data": (
        lambda s, a: classify.run_data(
            s, a.corpus, a.labels, a.gold, a.splits, a.out,
            (a.min_rows, a.max_rows), a.gold_rows,
        ),
        ["corpus", "labels", "gold", "splits", "out"], {"min-rows": int, "max-rows": int, "gold-rows": int},
    ),
    "classify-lr": (_train, ["train", "eval", "vectors", "out", "dim", "method"], {"c": float, "weights": str}),
    "classify-eval": (_compare, ["results", "out"], {"eval": str, "skip": list}),
}
_NUMBERS = ("dim", "k", "per-kind")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__)
    top.add_argument("--cores", type=int, default=None, help="run locally on this many cores")
    jobs = top.add_subparsers(dest="job", required=True)
    for name, (_, required, optional) in JOBS.items():
        job = jobs.add_parser(name)
        for option in required:
            job.add_argument(f"--{option}", required=True, type=int if option in _NUMBERS else str)
        for option, kind in optional.items():
            if kind is list:
                job.add_argument(f"--{option}", nargs="*", default=[])
            else:
                job.add_argument(f"--{option}", type=kind, default=None)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(f"sievegate-{args.job}", args.cores)
    result = JOBS[args.job][0](spark, args)
    print(json.dumps(result, indent=2, default=str))
    return 1 if isinstance(result, dict) and result.get("passed") is False else 0


if __name__ == "__main__":
    sys.exit(main())
