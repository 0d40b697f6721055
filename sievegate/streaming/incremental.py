"""Incremental preparation of new message files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sievegate.functions.text import dedupe_key
from sievegate.operators.labelling import label_chunks
from sievegate.plans.prep import chunk_messages, clean_messages

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
#: Rows and bytes that a Python worker of the stream gets at once: whole texts, several copies of each.
_SMALL_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}
_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def message_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """New Parquet files below ``folder`` as they arrive."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .parquet(folder)
    )


def first_arrivals(cleaned: DataFrame) -> DataFrame:
    """Unique messages, with their ``digest``, whose text no earlier batch has brought.

    The state is one flag for each digest, kept by key on the executors' disks, so a batch costs
    what it brings, however long the history. Of copies in one batch the smallest row stays,
    ``doc_id`` first. Copies collapse in every Arrow batch before the shuffle, and the rows
    of a group pass one Arrow batch at a time, so a text that fills a third of a batch is no burden.
    """
    order = ["doc_id", *[c for c in cleaned.columns if c != "doc_id"]]
    keyed = cleaned.withColumn("digest", F.sha2(dedupe_key(F.col("cleaned")), 256))

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                by = [(name, "ascending") for name in ["digest", *order]]
                ordered = batch.take(pc.sort_indices(batch, sort_keys=by, null_placement="at_start"))
                digests = ordered.column("digest")
                new = pc.not_equal(digests[1:], digests[:-1])
                yield ordered.filter(pa.concat_arrays([pa.array([True]), new]))

    def smallest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            return
        best = None
        for frame in frames:
            rows = frame if best is None else pd.concat([best, frame])
            if len(rows) > 1:
                places = [tuple((v is not None, v) for v in row) for row in rows[order].itertuples(index=False, name=None)]
                at = min(range(len(places)), key=places.__getitem__)
                rows = rows.iloc[at : at + 1]
            best = rows
        state.update((True,))
        yield best

    return keyed.mapInArrow(collapse, keyed.schema).groupBy("digest").applyInPandasWithState(
        smallest, keyed.schema, "seen boolean", "append", GroupStateTimeout.NoTimeout
    )


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Each micro-batch owns one folder and replaces it when it is retried."""
    (
        df.withColumn("batch", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(path)
    )


def start_prep(
    messages: DataFrame, out: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Clean, chunk and label everything that has arrived, then stop.

    ``prepare`` maps stream rows to ``email_body, subject_line, split``. Unique messages,
    corpus and label rows go to ``out/messages``, ``out/corpus`` and ``out/labels``, one folder
    per batch. A text that an earlier batch brought, up to case and white space, is skipped:
    files delivered again add nothing, and of all copies the first to arrive stays. What has
    been seen is part of ``checkpoint``; its number of partitions is that of the first run.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        write_batch(batch, f"{out}/messages", batch_id)

        def written(name: str, columns: T.StructType) -> DataFrame:
            layout = T.StructType([*columns.fields, T.StructField("batch", T.LongType())])
            return spark.read.schema(layout).parquet(f"{out}/{name}").filter(F.col("batch") == batch_id)

        chunks = chunk_messages(written("messages", batch.schema))
        write_batch(chunks, f"{out}/corpus", batch_id)
        write_batch(label_chunks(written("corpus", chunks.schema)), f"{out}/labels", batch_id)

    spark = messages.sparkSession
    fresh = first_arrivals(clean_messages(prepare(messages) if prepare else messages))
    settings = {_STATE_STORE: _ON_DISK, **_SMALL_BATCHES}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():  # A query takes a copy of the settings when it starts.
        spark.conf.set(name, value)
    try:
        return (
            fresh.writeStream.foreachBatch(process)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
