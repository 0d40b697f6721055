"""Vector checks, variants, distances and probabilities as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievegate.schemas import LABELS


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` computed once; inside a lambda it would run per element."""
    return F.get(F.transform(F.array(value), body), 0)


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def well_formed(vector: Column, dim: int) -> Column:
    """Right width, and every value present and finite."""
    finite = F.forall(
        as_double(vector),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    return F.coalesce((F.size(vector) == dim) & finite, F.lit(False))


def checked(vector: Column, dim: int) -> Column:
    """The vector itself, or an error when it is malformed."""
    message = F.concat(
        F.lit(f"expected {dim} finite values, got width "),
        F.coalesce(F.size(vector).cast("string"), F.lit("null")),
    )
    return F.when(well_formed(vector, dim), vector).otherwise(
        F.raise_error(message).cast("array<float>")
    )


def truncate(vector: Column, dim: int) -> Column:
    return F.slice(vector, 1, dim)


def l2_norm(vector: Column) -> Column:
    return F.sqrt(_sum(F.transform(as_double(vector), lambda x: x * x)))


def renormalize(vector: Column, zero_is_error: bool = True) -> Column:
    """Unit length in double precision; a zero vector is an error, or null when allowed."""
    failed = F.raise_error("zero-norm vector").cast("double") if zero_is_error else F.lit(None)

    def divided(norm: Column) -> Column:
        safe = F.when(norm > 0, norm).otherwise(failed)
        return _bind(
            safe, lambda n: F.when(n.isNotNull(), F.transform(as_double(vector), lambda x: x / n))
        )

    return F.when(vector.isNotNull(), _bind(l2_norm(vector), divided))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def half_precision(vectors: pd.Series) -> pd.Series:
    """Values rounded to 16-bit floats; Spark has no such type."""
    kept = vectors.dropna()
    if kept.empty:
        return vectors
    lengths = kept.map(len).to_numpy()
    flat = np.concatenate(kept.to_list()).astype(np.float16).astype(np.float64)
    parts = np.split(flat, np.cumsum(lengths)[:-1])
    return pd.Series(parts, index=kept.index, dtype=object).reindex(vectors.index)


def dot(left: Column, right: Column) -> Column:
    return _sum(F.zip_with(as_double(left), as_double(right), lambda a, b: a * b))


def cosine_distance(left: Column, right: Column) -> Column:
    """``1 - cos``; null for a null or zero vector."""
    norms = l2_norm(left) * l2_norm(right)
    return F.when(norms > 0, F.lit(1.0) - dot(left, right) / norms)


def softmax(logits: Column) -> Column:

    def shares(powers: Column) -> Column:
        return _bind(_sum(powers), lambda total: F.transform(powers, lambda x: x / total))

    def shifted(values: Column) -> Column:
        powers = _bind(F.array_max(values), lambda peak: F.transform(values, lambda x: F.exp(x - peak)))
        return _bind(powers, shares)

    return _bind(logits, shifted)


def label_map(values: Column) -> Column:
    """``array<double>`` in label order to ``map<label, double>``."""
    return F.map_from_arrays(F.array(*[F.lit(name) for name in LABELS]), values)


def label_values(probs: Column) -> Column:
    """``map<label, double>`` to ``array<double>`` in label order."""
    return F.array(*[F.element_at(probs, F.lit(name)) for name in LABELS])


def linear_scores(vector: Column, coefficients: list[list[float]], intercepts: list[float]) -> Column:
    """Class probabilities of a fixed linear model, as a label map."""
    dim = len(coefficients[0])
    vector = F.when(F.size(vector) == dim, vector).otherwise(
        F.raise_error(f"expected {dim} values").cast("array<float>")
    )
    logits = F.array(
        *[
            dot(F.array(*[F.lit(float(c)) for c in row]), vector) + F.lit(float(bias))
            for row, bias in zip(coefficients, intercepts, strict=True)
        ]
    )
    return label_map(softmax(logits))


def top_label(probs: Column) -> Column:
    """Most probable label; the earlier label wins a tie."""
    best = F.array_max(label_values(probs))
    return F.element_at(
        F.array(*[F.lit(name) for name in LABELS]),
        F.array_position(label_values(probs), best).cast("int"),
    )


# Fixed value: how far raw probabilities may be from summing to one.
SUM_TOLERANCE = 1e-3


def probability_error(probs: Column) -> Column:
    """Why a probability map cannot be used, or null when it can."""
    values = label_values(probs)
    missing = F.filter(
        F.array(*[F.lit(name) for name in LABELS]),
        lambda name: ~F.map_contains_key(probs, name) | F.element_at(probs, name).isNull(),
    )
    broken = F.exists(values, lambda x: F.isnan(x) | (F.abs(x) == float("inf")))
    negative = F.exists(values, lambda x: x < 0)
    total = _sum(values)
    return (
        F.when(probs.isNull(), F.lit("probabilities missing"))
        .when(F.size(missing) > 0, F.concat(F.lit("missing keys: "), F.array_join(missing, ", ")))
        .when(broken, F.lit("non-finite probability"))
        .when(negative, F.lit("negative probability"))
        .when(total <= 0, F.lit("probabilities sum to zero"))
        .when(F.abs(total - 1.0) > SUM_TOLERANCE, F.lit("probabilities do not sum to one"))
    )


def normalized_probabilities(probs: Column) -> Column:
    """Rescaled map; null where ``probability_error`` has a reason."""
    values = label_values(probs)
    total = _sum(values)
    rescaled = label_map(F.transform(values, lambda x: x / total))
    return F.when(probability_error(probs).isNull(), rescaled)


def probabilities_from_logs(logs: Column) -> Column:
    """Label map from log scores; non-finite scores weigh nothing, no mass means uniform."""
    mass = F.transform(
        label_values(logs),
        lambda x: F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(F.exp(x)),
    )
    total = _sum(mass)
    uniform = F.transform(mass, lambda x: F.lit(1.0 / len(LABELS)))
    return label_map(
        F.when(total > 0, F.transform(mass, lambda x: x / total)).otherwise(uniform)
    )
