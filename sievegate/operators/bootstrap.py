"""Percentile bootstrap of a mean for any number of rows.

Resampling rows with Poisson(1) weights is the bootstrap that splits across partitions.
Equal values are merged first: the weight of a value seen c times is Poisson(c), the sum of
its rows' weights. A 0/1 metric over a billion rows is therefore two histogram rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESAMPLES = 1000
LEVEL = 0.95
_TOGETHER = 2048  # values that are drawn for at once
_TABLED = 32  # counts up to which weights come from a table of the distribution


def _uniform(seeds: np.ndarray, resamples: int) -> np.ndarray:
    """Numbers in (0, 1), a row for each seed: the mixed sum of seed and counter (splitmix64)."""
    steps = np.arange(1, resamples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = seeds.astype(np.int64).view(np.uint64)[:, None] + steps
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def _distribution(n: int) -> np.ndarray:
    """The cumulative Poisson distribution with mean n, as far as it is below one."""
    total, term, out, i = 0.0, float(np.exp(-n)), [], 0
    while i <= n or term > 1e-18:
        total += term
        out.append(total)
        i += 1
        term *= n / i
    return np.array(out)


def weights_of(counts: np.ndarray, seeds: np.ndarray, resamples: int) -> np.ndarray:
    """Poisson weights, a row for each value: its count is the mean, its seed fixes the draws."""
    out = np.empty((len(counts), resamples))
    for n in np.unique(counts[counts <= _TABLED]):
        rows = np.flatnonzero(counts == n)
        out[rows] = np.searchsorted(_distribution(int(n)), _uniform(seeds[rows], resamples))
    for row in np.flatnonzero(counts > _TABLED):
        generator = np.random.Generator(np.random.Philox(int(seeds[row]) & (2**64 - 1)))
        out[row] = generator.poisson(counts[row], resamples)
    return out


def bootstrap_mean(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    resamples: int = RESAMPLES,
    seed: int = 6,
    level: float = LEVEL,
    weight: str | None = None,
) -> DataFrame:
    """``groups, mean, n, lo, hi``; the same input and seed give the same interval.

    The draws of a value depend on seed, group and value only, not on the data layout.
    ``weight`` names a count column when the rows are already merged.
    """
    histogram = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*groups, F.col(value).cast("double").alias("_v"))
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
        .withColumn("_seed", F.xxhash64(F.lit(seed), *groups, "_v"))
    )
    fields = [histogram.schema[g] for g in groups]
    layout = T.StructType(
        [*fields, T.StructField("_sums", T.ArrayType(T.DoubleType())),
         T.StructField("_weights", T.ArrayType(T.DoubleType()))]
    )

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Partial sums per group and partition, one slot per resample."""
        sums: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            parts = pdf.groupby(list(groups), sort=False, dropna=False) if groups else [((), pdf)]
            for key, part in parts:
                found = sums.setdefault(key, np.zeros((2, resamples)))
                for first in range(0, len(part), _TOGETHER):
                    some = part.iloc[first : first + _TOGETHER]
                    weights = weights_of(some["_n"].to_numpy(), some["_seed"].to_numpy(), resamples)
                    found += np.stack([some["_v"].to_numpy(), np.ones(len(some))]) @ weights
            if len(sums) >= 4096:
                yield _rows(sums)
                sums = {}
        if sums:
            yield _rows(sums)

    def _rows(sums: dict[tuple, np.ndarray]) -> pd.DataFrame:
        frame = pd.DataFrame(list(sums), columns=list(groups))
        frame["_sums"] = [list(s[0]) for s in sums.values()]
        frame["_weights"] = [list(s[1]) for s in sums.values()]
        return frame

    slots = (
        histogram.mapInPandas(draw, layout)
        .select(*groups, F.posexplode(F.arrays_zip("_sums", "_weights")).alias("_b", "_z"))
        .groupBy(*groups, "_b")
        .agg(F.sum("_z._sums").alias("_s"), F.sum("_z._weights").alias("_w"))
        .filter(F.col("_w") > 0)
    )
    ordered = F.array_sort(F.collect_list(F.col("_s") / F.col("_w")))
    tail = (1.0 - level) / 2.0
    bounds = slots.groupBy(*groups).agg(ordered.alias("_means"))
    count = F.size("_means")
    bounds = bounds.select(
        *groups,
        F.get("_means", F.floor(F.lit(tail) * count).cast("int")).alias("lo"),
        F.get(
            "_means", F.least(F.floor(F.lit(1.0 - tail) * count).cast("int"), count - 1)
        ).alias("hi"),
    )
    means = histogram.groupBy(*groups).agg(
        (F.sum(F.col("_v") * F.col("_n")) / F.sum("_n")).alias("mean"),
        F.sum("_n").alias("n"),
    )
    both = means.unionByName(bounds, allowMissingColumns=True)
    return both.groupBy(*groups).agg(*[F.max(c).alias(c) for c in ("mean", "n", "lo", "hi")])
