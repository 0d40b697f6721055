"""Tables in the shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievegate.session import scratch_path

# Paths written in the scopes that are open, innermost last.
_SCOPES: list[list[str]] = []


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written once as Parquet below ``spark.checkpoint.dir`` and read back.

    Later reads prune columns and never run ``df`` again, so values that depend on the order
    of rows or on partition numbers are fixed from here on. ``keep`` lets it outlive its scope.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    if _SCOPES and not keep:
        _SCOPES[-1].append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop(*tables: DataFrame) -> None:
    """Removes tables that ``stored`` wrote, once nothing that is still to run reads them."""
    for table in tables:
        _remove(table.sparkSession, table.stored_at)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes every table stored inside the block at its end, also after an error."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
        for path in made:
            _remove(spark, path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Python workers of the plans that run inside the block get at most 4 MB at a time."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(4 << 20))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def words_of(text: Column) -> Column:
    r"""Runs of characters other than space and \x09-\x0D; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Rows that one task numbers or sums, on average.
SLICE_ROWS = 2_000


def slice_bits(rows: int) -> int:
    """Leading bits of a uniform key that cut ``rows`` rows into slices of some thousands."""
    return max(0, (rows // SLICE_ROWS).bit_length())


def sums_before(df: DataFrame, group: str, piece: str, order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over all earlier rows of the row's group.

    A group is ordered by ``piece``, an order-preserving slice number, then by ``order``. Slices are
    summed, their sums summed up along each group, and rows summed up inside their slice only, so a
    group of any size spreads over tasks. ``group`` and ``piece`` must not be null.
    """
    earlier = Window.partitionBy(group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    slices = df.groupBy(group, piece).agg(F.sum(value).alias("_sum"))
    slices = slices.select(group, piece, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inner = Window.partitionBy(group, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_inner", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return rows.join(slices, [group, piece]).withColumn(name, F.col("_base") + F.col("_inner")).drop("_base", "_inner")
