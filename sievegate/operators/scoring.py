"""Classification scores, calibration and method comparison, grouped by method."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievegate.functions.vectors import SUM_TOLERANCE, label_values, top_label
from sievegate.operators.bootstrap import bootstrap_mean
from sievegate.operators.quantiles import nearest_rank
from sievegate.schemas import LABELS
from sievegate.session import cut_lineage


def _classes() -> Column:
    return F.array(*[F.lit(name) for name in LABELS])


def require_labels(rows: DataFrame, columns: Sequence[str] = ("gold", "pred")) -> DataFrame:
    """Unknown or missing labels fail the job."""
    out = rows
    for name in columns:
        value = F.col(name)
        message = F.concat(F.lit(f"unknown {name} label: "), F.coalesce(value, F.lit("null")))
        out = out.withColumn(
            name, F.when(value.isin(*LABELS), value).otherwise(F.raise_error(message).cast("string"))
        )
    return out


def _rows(weight: str | None) -> Column:
    """How many rows one row stands for."""
    return F.col(weight) if weight else F.lit(1)


def confusion_matrix(
    rows: DataFrame, groups: Sequence[str] = ("method",), weight: str | None = None
) -> DataFrame:
    """``groups, gold, pred, n`` with all nine cells, zero cells included."""
    counts = require_labels(rows).groupBy(*groups, "gold", "pred").agg(F.sum(_rows(weight)).alias("n"))
    cells = [F.struct(F.lit(g).alias("gold"), F.lit(p).alias("pred")) for g in LABELS for p in LABELS]
    frame = counts.select(*groups).distinct() if groups else counts.select(F.lit(1).alias("_one")).distinct()
    grid = frame.withColumn("_c", F.explode(F.array(*cells))).select(*groups, "_c.*")
    return grid.join(counts, [*groups, "gold", "pred"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0))
    )


def class_scores(
    rows: DataFrame, groups: Sequence[str] = ("method",), weight: str | None = None
) -> DataFrame:
    """Precision, recall, F1 and support per class; empty denominators give zero.

    Each row counts once for its gold class and once for its predicted class, so one
    aggregation covers all classes and methods.
    """
    gold, pred = F.col("gold"), F.col("pred")
    none, one = F.lit(0).cast("bigint"), _rows(weight).cast("bigint")
    same = F.when(gold == pred, one).otherwise(none)
    sides = F.array(
        F.struct(gold.alias("class"), one.alias("g"), none.alias("p"), same.alias("t")),
        F.struct(pred.alias("class"), none.alias("g"), one.alias("p"), none.alias("t")),
    )
    blank = F.transform(
        _classes(), lambda c: F.struct(c.alias("class"), none.alias("g"), none.alias("p"), none.alias("t"))
    )
    counted = (
        require_labels(rows)
        .select(*groups, F.explode(F.concat(sides, blank)).alias("_s"))
        .groupBy(*groups, F.col("_s.class").alias("class"))
        .agg(F.sum("_s.g").alias("support"), F.sum("_s.p").alias("predicted"), F.sum("_s.t").alias("hits"))
    )
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    scored = counted.select(*groups, "class", precision.alias("precision"), recall.alias("recall"), "support")
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return scored.select(
        *groups, "class", "precision", "recall", F.coalesce(f1, F.lit(0.0)).alias("f1"), "support"
    )


def macro_f1(scores: DataFrame, groups: Sequence[str] = ("method",)) -> DataFrame:
    """Mean F1 over the three fixed classes, absent ones counting zero."""
    return scores.groupBy(*groups).agg((F.sum("f1") / len(LABELS)).alias("macro_f1"))


def accuracy(
    rows: DataFrame, groups: Sequence[str] = ("method",), weight: str | None = None
) -> DataFrame:
    same = F.when(F.col("gold") == F.col("pred"), _rows(weight)).otherwise(0)
    return (
        require_labels(rows)
        .groupBy(*groups)
        .agg(
            F.coalesce(F.sum(_rows(weight)), F.lit(0)).alias("n"),
            F.coalesce(F.try_divide(F.sum(same), F.sum(_rows(weight))), F.lit(0.0)).alias("accuracy"),
        )
    )


def outcome_counts(
    rows: DataFrame, groups: Sequence[str] = ("method",), n_bins: int = 10
) -> DataFrame:
    """``groups, gold, pred, bin, n, hits, confidence``: predictions merged into few rows.

    ``hits`` counts rows whose most probable label is right, ``confidence`` sums its
    probability. One pass over the predictions feeds every score below.
    """
    if n_bins < 1:
        raise ValueError("at least one bin is needed")
    confidence = F.array_max(label_values(F.col("probs")))
    valid = F.when((confidence >= 0) & (confidence <= 1), confidence).otherwise(
        F.raise_error("confidence missing or outside [0, 1]").cast("double")
    )
    hit = (top_label(F.col("probs")) == F.col("gold")).cast("bigint")
    marked = rows.select(
        *groups, "gold", *(["pred"] if "pred" in rows.columns else []), valid.alias("_conf"), hit.alias("_hit")
    )
    slot = F.least(F.floor(F.col("_conf") * n_bins), F.lit(n_bins - 1)).cast("int")
    keys = [*groups, "gold", *(["pred"] if "pred" in rows.columns else [])]
    return marked.groupBy(*keys, slot.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_hit").alias("hits"), F.sum("_conf").alias("confidence")
    )


def reliability_bins(
    rows: DataFrame, groups: Sequence[str] = ("method",), n_bins: int = 10
) -> DataFrame:
    """``bin, lo, hi, count, accuracy, confidence`` per method; empty bins have nulls."""
    return bins_from_counts(outcome_counts(rows, groups, n_bins), groups, n_bins)


def bins_from_counts(
    counts: DataFrame, groups: Sequence[str] = ("method",), n_bins: int = 10
) -> DataFrame:
    """All bins of every method; each count row also brings one blank row per bin."""
    blank = F.transform(
        F.sequence(F.lit(0), F.lit(n_bins - 1)),
        lambda i: F.struct(
            i.alias("bin"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("hits"),
            F.lit(0.0).alias("confidence"),
        ),
    )
    filled = F.array(F.struct("bin", "n", "hits", "confidence"))
    totals = (
        counts.select(*groups, F.explode(F.concat(filled, blank)).alias("_b"))
        .groupBy(*groups, F.col("_b.bin").alias("bin"))
        .agg(
            F.sum("_b.n").alias("count"), F.sum("_b.hits").alias("_hits"), F.sum("_b.confidence").alias("_conf")
        )
    )
    return totals.select(
        *groups,
        "bin",
        (F.col("bin") / n_bins).alias("lo"),
        ((F.col("bin") + 1) / n_bins).alias("hi"),
        "count",
        F.try_divide("_hits", "count").alias("accuracy"),
        F.try_divide("_conf", "count").alias("confidence"),
    )


def calibration_error(bins: DataFrame, groups: Sequence[str] = ("method",)) -> DataFrame:
    """Expected calibration error from reliability bins."""
    gap = F.col("count") * F.abs(F.col("accuracy") - F.col("confidence"))
    return bins.groupBy(*groups).agg(
        F.coalesce(F.try_divide(F.sum(gap), F.sum("count")), F.lit(0.0)).alias("ece")
    )


def class_weights(rows: DataFrame, label: str = "label") -> DataFrame:
    """``label, n, weight`` with weight ``N / (K * n)``; a class without rows weighs zero."""
    counts = rows.select(F.explode(
        F.concat(
            F.array(F.struct(F.col(label).alias("label"), F.lit(1).alias("one"))),
            F.transform(_classes(), lambda c: F.struct(c.alias("label"), F.lit(0).alias("one"))),
        )
    ).alias("_s")).groupBy("_s.label").agg(F.sum("_s.one").alias("n"))
    # The window runs over one row per class.
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    weight = F.coalesce(F.try_divide(total, F.col("n") * len(LABELS)), F.lit(0.0))
    return counts.select("label", "n", weight.alias("weight"))


def class_intervals(
    rows: DataFrame, groups: Sequence[str] = ("method",), resamples: int = 1000, seed: int = 42,
    weight: str | None = None,
) -> DataFrame:
    """Bootstrap intervals of precision (rows predicted as the class) and recall (gold rows)."""
    hit = (F.col("gold") == F.col("pred")).cast("double").alias("hit")
    sides = F.array(
        F.struct(F.lit("precision").alias("kind"), F.col("pred").alias("class"), hit),
        F.struct(F.lit("recall").alias("kind"), F.col("gold").alias("class"), hit),
    )
    long = rows.select(*groups, *([weight] if weight else []), F.explode(sides).alias("_s"))
    long = long.select(*groups, *([weight] if weight else []), "_s.*")
    return bootstrap_mean(long, [*groups, "class", "kind"], "hit", resamples, seed, weight=weight)


def latency_summary(rows: DataFrame, groups: Sequence[str] = ("method",), value: str = "latency_ms") -> DataFrame:
    """Nearest-rank p50 and p95, mean, and total seconds."""
    ranks = nearest_rank(rows, groups, value, (0.5, 0.95))
    wide = ranks.groupBy(*groups).agg(
        F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("p50"),
        F.max(F.when(F.col("q") == 0.95, F.col("value"))).alias("p95"),
    )
    totals = rows.groupBy(*groups).agg(
        F.avg(value).alias("mean"), F.round(F.sum(value) / 1000, 1).alias("total_s")
    )
    return wide.join(totals, list(groups))


def prediction_problems(rows: DataFrame, groups: Sequence[str] = ("method",)) -> DataFrame:
    """Per method: rows, rows with a missing field, and rows whose probabilities are off."""
    absent = F.lit(False)
    for name in ("doc_id", "chunk_ord", "gold", "pred", "probs", "latency_ms"):
        absent = absent | F.col(name).isNull()
    values = label_values(F.col("probs"))
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    off = F.coalesce(F.abs(total - 1.0) > SUM_TOLERANCE, F.lit(True))
    disagree = F.coalesce(top_label(F.col("probs")) != F.col("pred"), F.lit(False))
    return rows.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(absent).alias("missing_fields"),
        F.count_if(off).alias("bad_probabilities"),
        F.count_if(disagree).alias("pred_not_argmax"),
    )


def scorer_agreement(first: DataFrame, second: DataFrame) -> DataFrame:
    """One row comparing a second scorer, which may fail per row, with the first.

    ``second`` has ``pred`` and ``error``; rows with an error are counted by kind, not compared.
    """
    keys = ["doc_id", "chunk_ord"]
    joined = first.select(*keys, F.col("pred").alias("_a")).join(
        second.select(*keys, F.col("pred").alias("_b"), F.lower("error").alias("_error")), keys
    )
    failed = F.col("_error").isNotNull()
    same = ~failed & (F.col("_a") == F.col("_b"))
    return joined.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(failed).alias("errors"),
        F.count_if(F.contains("_error", F.lit("non-finite"))).alias("nan_rows"),
        F.count_if(
            F.contains("_error", F.lit("empty")) | F.contains("_error", F.lit("sum to zero"))
        ).alias("empty_rows"),
        F.count_if(~failed).alias("compared"),
        F.count_if(same).alias("agreement"),
        F.round(F.try_divide(F.count_if(same), F.count_if(~failed)), 4).alias("agreement_rate"),
    )


def method_summary(rows: DataFrame, groups: Sequence[str] = ("method",)) -> DataFrame:
    """One row per method: accuracy with interval, macro F1, calibration error, latency.

    The predictions are read for the outcome counts and for the latencies; everything else
    works on the counts, which are written out once.
    """
    keys = list(groups)
    counts = cut_lineage(outcome_counts(rows, keys))
    hit = counts.withColumn("_hit", (F.col("gold") == F.col("pred")).cast("double"))
    interval = bootstrap_mean(hit, keys, "_hit", seed=42, weight="n").select(
        *keys, F.col("lo").alias("accuracy_lo"), F.col("hi").alias("accuracy_hi")
    )
    return (
        accuracy(counts, keys, "n")
        .join(interval, keys)
        .join(macro_f1(class_scores(counts, keys, "n"), keys), keys)
        .join(calibration_error(bins_from_counts(counts, keys), keys), keys)
        .join(latency_summary(rows, keys), keys, "left")  # a method may report no latency
    )


def full_summary(rows: DataFrame, groups: Sequence[str] = ("method",), resamples: int = 1000) -> DataFrame:
    """``method_summary`` with everything behind it: one row per method.

    ``classes`` holds precision, recall, F1 and support of every class, with the bounds of the first
    two (null for a class that no row is predicted as, or belongs to), ``confusion`` all nine cells
    and ``bins`` the reliability bins. All of it comes from the counts of outcomes, which are
    written once; the arrays have at most ten entries.
    """
    keys = list(groups)
    counts = cut_lineage(outcome_counts(rows, keys))
    sides = class_intervals(counts, keys, resamples, weight="n").groupBy(*keys, "class").agg(
        *[
            F.max(F.when(F.col("kind") == kind, F.col(side))).alias(f"{kind}_{side}")
            for kind in ("precision", "recall")
            for side in ("lo", "hi")
        ]
    )
    scores = class_scores(counts, keys, "n").join(sides, [*keys, "class"], "left")

    def gathered(part: DataFrame, name: str) -> DataFrame:
        inner = F.struct(*[c for c in part.columns if c not in keys])
        return part.groupBy(*keys).agg(F.array_sort(F.collect_list(inner)).alias(name))

    return (
        method_summary(rows, keys)
        .join(gathered(scores, "classes"), keys)
        .join(gathered(confusion_matrix(counts, keys, "n"), "confusion"), keys)
        .join(gathered(bins_from_counts(counts, keys), "bins"), keys)
    )
