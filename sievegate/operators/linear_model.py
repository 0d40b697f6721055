"""Balanced multinomial logistic regression on vectors, with Spark ML."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievegate.functions.vectors import label_map, linear_scores, top_label
from sievegate.operators.labelling import stratified_folds
from sievegate.operators.scoring import class_scores, class_weights, macro_f1
from sievegate.schemas import LABELS

# Inverse regularisation strengths tried, folds, iteration limit, seed.
C_GRID = (0.01, 0.1, 1.0, 10.0, 100.0)
FOLDS = 5
MAX_ITER = 1000
SEED = 42


# Names the classes on the label column, so a class without rows still gets its weights.
_TARGET = {"ml_attr": {"type": "nominal", "name": "target", "vals": list(LABELS)}}


@dataclass(frozen=True)
class LinearWeights:
    """Coefficients per label, in label order."""

    coefficients: list[list[float]]
    intercepts: list[float]

    def checked(self, dim: int) -> LinearWeights:
        rows = [len(row) for row in self.coefficients]
        if rows != [dim] * len(LABELS) or len(self.intercepts) != len(LABELS):
            raise ValueError(f"weights are not {len(LABELS)} x {dim}")
        return self


def prepare(rows: DataFrame, vector: str = "vector", label: str = "label") -> DataFrame:
    """Adds ``features``, ``target`` (label position) and the balancing ``weight``."""
    per_class = {r["label"]: r["weight"] for r in class_weights(rows, label).collect()}  # 3 rows
    target, weight = F.lit(None).cast("double"), F.lit(None).cast("double")
    for position, name in enumerate(LABELS):
        target = F.when(F.col(label) == name, F.lit(float(position))).otherwise(target)
        weight = F.when(F.col(label) == name, F.lit(per_class[name])).otherwise(weight)
    known = F.col(label).isin(*LABELS)
    bad = F.raise_error(F.concat(F.lit("unexpected label "), F.col(label))).cast("boolean")
    return rows.filter(F.when(known, F.lit(True)).otherwise(bad)).select(
        "*", array_to_vector(F.col(vector).cast("array<double>")).alias("features"),
        target.alias("target", metadata=_TARGET), weight.alias("weight"),
    )


def estimator(c: float, total_weight: float) -> LogisticRegression:
    """Penalty ``1 / (C * sum of weights)`` gives the usual ``C``-scaled objective."""
    return LogisticRegression(
        featuresCol="features", labelCol="target", weightCol="weight", family="multinomial",
        elasticNetParam=0.0, regParam=1.0 / (c * total_weight), standardization=False,
        maxIter=MAX_ITER, tol=1e-6,
    )


def fit(rows: DataFrame, c: float, vector: str = "vector", label: str = "label") -> LogisticRegressionModel:
    """Final model at fixed ``c``; balanced weights sum to the number of rows."""
    prepared = prepare(rows, vector, label).persist()
    try:
        return estimator(c, float(prepared.count())).fit(prepared)
    finally:
        prepared.unpersist()


class MacroF1Evaluator(Evaluator, HasLabelCol, HasPredictionCol):
    """Mean F1 over the three labels; Spark's own ``f1`` weighs classes by support."""

    def _evaluate(self, dataset: DataFrame) -> float:
        names = F.array(*[F.lit(name) for name in LABELS])
        rows = dataset.select(
            F.get(names, F.col("target").cast("int")).alias("gold"),
            F.get(names, F.col("prediction").cast("int")).alias("pred"),
        )
        return float(macro_f1(class_scores(rows, []), []).first()["macro_f1"] or 0.0)


def choose_c(
    rows: DataFrame, keys: list[str], grid: tuple[float, ...] = C_GRID, vector: str = "vector",
    label: str = "label", parallelism: int = 4,
) -> tuple[float, dict[float, float]]:
    """Best ``c`` by stratified cross-validation on macro F1 (first maximum), and all means."""
    prepared = stratified_folds(prepare(rows, vector, label), keys, label, FOLDS, SEED).persist()
    try:
        n = float(prepared.count()) * (FOLDS - 1) / FOLDS
        base = estimator(1.0, n)
        params = ParamGridBuilder().addGrid(base.regParam, [1.0 / (c * n) for c in grid]).build()
        search = CrossValidator(
            estimator=base, estimatorParamMaps=params, evaluator=MacroF1Evaluator(),
            numFolds=FOLDS, foldCol="fold", parallelism=parallelism,
        )
        scores = [float(score) for score in search.fit(prepared).avgMetrics]
    finally:
        prepared.unpersist()
    means = dict(zip(grid, scores, strict=True))
    return max(grid, key=means.__getitem__), means


def predict(model: LogisticRegressionModel, rows: DataFrame, vector: str = "vector") -> DataFrame:
    """Rows with ``probs`` (label map) and ``pred``."""
    ready = rows.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))
    scored = model.transform(ready).withColumn("probs", label_map(vector_to_array("probability")))
    return scored.withColumn("pred", top_label(F.col("probs"))).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def export_weights(model: LogisticRegressionModel) -> LinearWeights:
    matrix = model.coefficientMatrix.toArray()
    return LinearWeights(matrix.tolist(), model.interceptVector.toArray().tolist()).checked(
        matrix.shape[1]
    )


def score_with_weights(weights: LinearWeights, rows: DataFrame, vector: str = "vector") -> DataFrame:
    """The exported model as a plain expression: same ``probs`` and ``pred``, no ML runtime."""
    probs = linear_scores(F.col(vector), weights.coefficients, weights.intercepts)
    scored = rows.withColumn("probs", probs)
    return scored.withColumn("pred", top_label(F.col("probs")))


def save_weights(spark: SparkSession, weights: LinearWeights, path: str) -> None:
    """One JSON row: labels, coefficients, intercepts."""
    text = json.dumps(
        {"labels": list(LABELS), "coef": weights.coefficients, "intercept": weights.intercepts}
    )
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_weights(spark: SparkSession, path: str, dim: int) -> LinearWeights:
    """Stored weights after checking labels and shape."""
    stored = json.loads("".join(r.value for r in spark.read.text(path).limit(2).collect()))
    if tuple(stored["labels"]) != LABELS:
        raise ValueError(f"weights are for labels {stored['labels']}")
    return LinearWeights(stored["coef"], stored["intercept"]).checked(dim)
