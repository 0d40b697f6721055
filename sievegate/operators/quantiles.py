"""Exact percentiles by rank, for groups too large to sort in one task.

A quantile sketch brackets each wanted rank; its error bound guarantees that the answer lies
inside. One further pass counts what lies below the bracket and keeps the values within, a
fixed small share of the rows, and only those are ordered. The sketch decides how little
has to be sorted, never the answer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ACCURACY = 100_000
_MARGIN = 2.0 / _ACCURACY
_SALTS = 32  # a hot group meets its brackets in this many pieces


def _at_ranks(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    quantiles: Sequence[float],
    rank: Callable[[float, Column], Column],
) -> DataFrame:
    """``groups, q, n, value`` with the value at 1-based ``rank(q, n)``."""
    keys = list(groups)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    ends = [e for q in quantiles for e in (max(q - _MARGIN, 0.0), min(q + _MARGIN, 1.0))]
    outline = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", F.array(*map(F.lit, ends)), _ACCURACY).alias("_ends"),
    )

    def bracket(i: int, q: float) -> Column:
        low = F.col("_min") if ends[2 * i] == 0.0 else F.get("_ends", 2 * i)
        high = F.col("_max") if ends[2 * i + 1] == 1.0 else F.get("_ends", 2 * i + 1)
        return F.struct(
            F.lit(q).alias("q"), low.alias("low"), high.alias("high"),
            rank(q, F.col("n")).cast("bigint").alias("rank"),
        )

    brackets = outline.select(
        *keys, "n", F.explode(F.array(*[bracket(i, q) for i, q in enumerate(quantiles)])).alias("_b")
    ).select(*keys, "n", "_b.*", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_v"), F.lit(_SALTS)).cast("int"))
    # Everything below a bracket becomes one null row, which sorts first.
    counted = (
        salted.join(brackets, [*keys, "_salt"])
        .filter(F.col("_v") <= F.col("high"))
        .groupBy(*keys, "q", "n", "rank", F.when(F.col("_v") >= F.col("low"), F.col("_v")).alias("value"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    upto = (
        Window.partitionBy(*keys, "q")
        .orderBy(F.col("value").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = counted.withColumn("_upto", F.sum("_n").over(upto)).filter(
        (F.col("rank") <= F.col("_upto")) & (F.col("rank") > F.col("_upto") - F.col("_n"))
    )
    missed = F.raise_error("wanted rank outside its bracket").cast(rows.schema["_v"].dataType)
    return found.select(*keys, "q", "n", F.coalesce("value", missed).alias("value"))


def nearest_rank(
    df: DataFrame, groups: Sequence[str], value: str, quantiles: Sequence[float]
) -> DataFrame:
    """The ``ceil(q * n)``-th smallest value (at least the first)."""
    return _at_ranks(
        df, groups, value, quantiles,
        lambda q, n: F.greatest(F.least(F.ceil(F.lit(q) * n), n), F.lit(1).cast("bigint")),
    )


def floor_index(
    df: DataFrame, groups: Sequence[str], value: str, quantiles: Sequence[float]
) -> DataFrame:
    """The value at 0-based index ``int(q * n)``, the second rule in use for latencies."""
    return _at_ranks(
        df, groups, value, quantiles, lambda q, n: F.least(F.floor(F.lit(q) * n) + 1, n)
    )
