"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str, cores: int | None = None, **conf: str) -> SparkSession:
    """Session for a job; ``cores`` asks for local mode, otherwise spark-submit decides."""
    ship_code()
    builder = SparkSession.builder.appName(app_name)
    if cores is not None:
        builder = builder.master(f"local[{cores}]").config(
            "spark.sql.shuffle.partitions", str(cores)
        )
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("WARN")
    return session


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only in local mode, where one machine does all the work, a temporary folder stands in.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if not folder and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not folder:
        folder = context.getCheckpointDir() or tempfile.mkdtemp(prefix="run-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a table that this session wrote and no longer needs."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder so later stages never recompute it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_code() -> None:
    """Send this package's functions with the tasks, so executors need no installation."""
    cloudpickle.register_pickle_by_value(sys.modules["sievegate"])
