"""Top-k, first-row and global numbering without funnelling a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SALTS = 256


def hash_order(seed: int, *keys: Column) -> Column:
    """Reproducible pseudo-random order: hex digest of seed and key, layout independent."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[key.cast("string") for key in keys]))


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The k first rows per group with their 1-based rank.

    For ordinary k Spark plans a group limit before the shuffle, so a hot group sends k
    rows per task. Above that planner threshold a salted first pass does the same job.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if k >= threshold:
        spread = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(_SALTS)))
        local = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            spread.withColumn("_local", F.row_number().over(local))
            .filter(F.col("_local") <= k)
            .drop("_salt", "_local")
        )
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The smallest row per group; combines on the map side, so hot groups are cheap."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*order, *rest)).alias("_first")
    out = df.groupBy(*keys).agg(packed).select(*keys, "_first.*")
    return out.select(*df.columns)


def number_rows(
    df: DataFrame,
    order: Sequence[Column],
    bucket: Column,
    partition_by: Sequence[str] = (),
    name: str = "row_index",
) -> DataFrame:
    """0-based position in a global (or per-partition) order, computed in parallel.

    ``bucket`` must be a non-null, order-preserving function of ``order`` with a bounded
    number of values, such as a fixed-length prefix of a digest. Rows are numbered inside
    their bucket; only the bucket counts are accumulated in one place.
    """
    keyed = df.withColumn("_bucket", bucket)
    groups = [*partition_by, "_bucket"]
    before = (
        Window.partitionBy(*(partition_by or [F.lit(0)]))
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        keyed.groupBy(*groups)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .drop("_size")
    )
    inside = Window.partitionBy(*groups).orderBy(*order)
    return (
        keyed.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(offsets, groups)
        .withColumn(name, F.col("_offset") + F.col("_inside"))
        .drop("_bucket", "_inside", "_offset")
    )
