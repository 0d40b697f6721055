"""Tables kept in buckets of their key, of which a merge rewrites only those it touches.

Layout below the table's folder: ``data/<token>/bucket=<n>`` holds what one merge wrote, and
``manifests/version=<v>`` names the folder of every bucket. Writing the manifest, a single
file, is the commit: readers see the old version or the new one, and nothing is ever overwritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievegate.schemas import check_schema
from sievegate.session import cut_lineage, drop_path

_MANIFEST = "bucket int, token string, since long, n_buckets int, version long"


def bucket_of(key: Column, n_buckets: int) -> Column:
    """Bucket of a key, by the head of its digest, so that other engines can follow."""
    head = F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, 8), 16, 10).cast("long")
    return (head % n_buckets).cast("int")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``bucket, token, since, n_buckets, version`` of the newest version; empty before the first.

    ``since`` is the version that wrote the bucket.
    """
    try:
        entries = spark.read.schema(_MANIFEST).json(f"{path}/manifests")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)
    last = entries.agg(F.max("version")).first()[0]
    return entries.filter(F.col("version") == F.lit(last).cast("long"))


def _rows(spark: SparkSession, path: str, schema: T.StructType, entries: list) -> DataFrame:
    folders = [f"{path}/data/{e['token']}/bucket={e['bucket']}" for e in entries]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_buckets(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest version of the table; empty before the first merge."""
    return _rows(spark, path, schema, read_manifest(spark, path).collect())


def merge_buckets(
    spark: SparkSession, path: str, incoming: DataFrame, key: str, schema: T.StructType,
    merge: Callable[[DataFrame, DataFrame], DataFrame], n_buckets: int = 64,
) -> dict:
    """``merge(stored, incoming)`` over the buckets that ``incoming`` touches; returns counts.

    Buckets without an incoming key are neither read nor written: the new manifest names their
    old files. ``n_buckets`` is fixed by the first merge. What is fetched is bounded by the number
    of buckets. A null key is an error. Nothing incoming leaves the version as it is. Of two
    merges at once the later to commit fails and may be repeated.
    """
    entries = read_manifest(spark, path).collect()
    if entries:
        n_buckets = entries[0]["n_buckets"]
    version = entries[0]["version"] + 1 if entries else 0
    missing = F.raise_error(F.lit(f"{key} is null")).cast("int")
    place = F.coalesce(bucket_of(F.col(key), n_buckets), missing)
    staged = cut_lineage(incoming.withColumn("_bucket", place))
    touched = {r["_bucket"] for r in staged.select("_bucket").distinct().collect()}
    counts = {"version": version, "touched": len(touched), "kept": sum(e["bucket"] not in touched for e in entries)}
    if not touched:
        return {**counts, "version": version - 1}
    old = _rows(spark, path, schema, [e for e in entries if e["bucket"] in touched])
    merged = check_schema(merge(old, staged.drop("_bucket")), schema)
    token = f"v{version}-{uuid.uuid4().hex}"
    bucketed = merged.withColumn("bucket", bucket_of(F.col(key), n_buckets))
    bucketed.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/data/{token}")
    written = spark.read.parquet(f"{path}/data/{token}").select("bucket").distinct().collect()
    new = [(e["bucket"], e["token"], e["since"], n_buckets) for e in entries if e["bucket"] not in touched]
    new += [(r["bucket"], token, version, n_buckets) for r in written]
    manifest = spark.createDataFrame(new, "bucket int, token string, since long, n_buckets int")
    manifest.coalesce(1).write.mode("errorifexists").json(f"{path}/manifests/version={version}")
    return counts


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove the folders that none of the ``keep`` newest versions names; returns how many."""
    entries = spark.read.schema(_MANIFEST).json(f"{path}/manifests").select("version", "token").distinct().collect()
    recent = sorted({e["version"] for e in entries})[-keep:]
    used = {e["token"] for e in entries if e["version"] in recent}
    stale = {e["token"] for e in entries} - used
    for old in sorted({e["version"] for e in entries} - set(recent)):
        drop_path(spark, f"{path}/manifests/version={old}")
    for token in sorted(stale):
        drop_path(spark, f"{path}/data/{token}")
    return len(stale)
