"""Readers and writers with declared schemas."""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievegate import schemas
from sievegate.functions.rules import label_from_tags
from sievegate.functions.text import strip
from sievegate.functions.vectors import checked
from sievegate.schemas import LABELS, check_schema
from sievegate.session import drop_path

# Names of the raw splits and how image rows are filed.
RAW_SPLITS = ("train", "validation", "test")
IMAGE_SOURCE = "funsd"
IMAGE_TITLE = "FUNSD form "

KEY = ["doc_id", "chunk_ord"]


# --- raw e-mail -------------------------------------------------------------------------


def read_raw_splits(spark: SparkSession, folder: str) -> DataFrame:
    """All ``<split>-*.parquet`` files, or folders of files, in one scan, tagged with their split."""
    pattern = f"{folder.rstrip('/')}/{{{','.join(RAW_SPLITS)}}}-*.parquet"
    try:
        raw = spark.read.parquet(pattern)
    except AnalysisException as error:
        raise FileNotFoundError(f"no <split>-*.parquet below {folder}") from error
    name = F.regexp_extract("_metadata.file_path", rf"/({'|'.join(RAW_SPLITS)})-[^/]*\.parquet(?:/[^/]*)?$", 1)
    return raw.withColumn("split", name)


# --- Parquet tables ---------------------------------------------------------------------


def write_table(
    df: DataFrame, path: str, schema: T.StructType, partition_by: tuple[str, ...] = (),
    sort_by: tuple[str, ...] = (), n_files: int | None = None,
) -> DataFrame:
    """Overwrite ``path`` with checked columns and return the stored table.

    ``sort_by`` range-partitions on its first column (into at most ``n_files`` files) and sorts
    inside the files. Finding the ranges needs a look at all rows, so they are written unsorted
    first: whatever made them is evaluated once. The range of keys in every file is kept in
    ``<path>-ranges`` for ``read_keys``. Partition columns come back last.
    """
    check_schema(df, schema)
    spark, place = df.sparkSession, path.rstrip("/")
    if sort_by:
        df.write.mode("overwrite").parquet(f"{place}-unsorted")
        width = (n_files,) if n_files else ()
        ranged = spark.read.parquet(f"{place}-unsorted").repartitionByRange(*width, F.col(sort_by[0]))
        df = ranged.sortWithinPartitions(*sort_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if sort_by:
        drop_path(spark, f"{place}-unsorted")
        if not partition_by:
            _file_ranges(spark.read.parquet(path), sort_by[0]).write.mode("overwrite").parquet(f"{place}-ranges")
    return read_table(spark, path, schema)


def _file_ranges(stored: DataFrame, key: str) -> DataFrame:
    """``file, low, high`` of every file; only the key column is read."""
    return stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high")
    )


def files_with_keys(spark: SparkSession, path: str, keys: DataFrame) -> tuple[list[str], int]:
    """Names of the files of a sorted table that can hold any of ``keys`` (one column), and how many there are.

    The ranges are one row per file and do not overlap, so a key has one file at most, found by
    bisection. Keys are not fetched, only the numbers of the files they fall into. Null keys have none.
    """
    ranges = spark.read.parquet(f"{path.rstrip('/')}-ranges").filter(F.col("low").isNotNull()).orderBy("low").collect()
    lows, highs = [r["low"] for r in ranges], [r["high"] for r in ranges]

    @F.pandas_udf("int")
    def file_of(values: pd.Series) -> pd.Series:
        found = [bisect_right(lows, value) - 1 for value in values]
        return pd.Series([i if i >= 0 and value <= highs[i] else -1 for i, value in zip(found, values, strict=True)], dtype="int32")

    key = F.col(keys.columns[0])
    hit = keys.filter(key.isNotNull()).select(file_of(key).alias("i")).filter("i >= 0").distinct().collect()
    return sorted(ranges[r["i"]]["file"] for r in hit), len(ranges)


def read_keys(spark: SparkSession, path: str, schema: T.StructType, keys: DataFrame) -> DataFrame:
    """Rows of a sorted table whose key is among ``keys`` (one column, named as in the table)."""
    names, _ = files_with_keys(spark, path, keys)
    if not names:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{name}" for name in names])
    return stored.join(keys, keys.columns, "left_semi")


def order_report(
    spark: SparkSession, path: str, keys: tuple[str, ...], form: str = "parquet", by: tuple[str, ...] = ()
) -> DataFrame:
    """Rows, rows that precede the row before them in their file, files that share a range with another.

    One row, or one for each value of ``by``. A file is read in its own order: by the part of it a
    task read and the row's position there.
    """
    rows = spark.read.format(form).load(path).select(
        *by, F.struct(*keys).alias("_key"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_part"), F.monotonically_increasing_id().alias("_at"),
    )
    before = F.lag("_key").over(Window.partitionBy(*by, "_file").orderBy("_part", "_at"))
    per_file = rows.withColumn("_late", F.coalesce(before > F.col("_key"), F.lit(False))).groupBy(*by, "_file").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_late").alias("late"), F.min("_key").alias("low"), F.max("_key").alias("high")
    )
    # One row per file is left here.
    last = F.lag("high").over(Window.partitionBy(*(by or [F.lit(0)])).orderBy("low"))
    return per_file.withColumn("_shared", F.coalesce(last >= F.col("low"), F.lit(False))).groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("late"), F.lit(0)).alias("out_of_order"),
        F.count_if("_shared").alias("overlapping_files"),
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table with its columns in declared order, checked."""
    stored = spark.read.parquet(path)
    missing = [c for c in schema.fieldNames() if c not in stored.columns]
    if missing:
        raise schemas.SchemaDrift(f"{path} lacks {missing}")
    return check_schema(stored.select(*schema.fieldNames()), schema)


def read_encoder_rows(spark: SparkSession, path: str) -> DataFrame:
    """Only the corpus columns an encoder needs."""
    return spark.read.parquet(path).select("doc_id", "chunk_ord", "title", "text")


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """``id, bytes`` of image forms; only the nested bytes field is read."""
    return spark.read.parquet(path).select(F.col("id").cast("string").alias("id"), F.col("image.bytes").alias("bytes"))


def image_rows(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Document and chunk rows of image forms, given their ``id``."""
    key = F.concat(F.lit(f"{IMAGE_SOURCE}:"), F.col("id"))
    documents = ids.select(
        key.alias("id"),
        F.lit(IMAGE_SOURCE).alias("source"),
        F.concat(F.lit(IMAGE_TITLE), F.col("id")).alias("title"),
        F.lit("image").alias("modality"),
        key.alias("thread_id"),
        F.lit("internal").alias("label"),
    )
    chunks = ids.select(
        F.concat(key, F.lit(":0")).alias("id"),
        key.alias("doc_id"),
        F.lit(0).alias("ord"),
        F.lit("").alias("text"),
    )
    return documents, chunks


# --- vectors ----------------------------------------------------------------------------


def write_vector_blocks(rows: DataFrame, path: str, dim: int) -> None:
    """``doc_id, chunk_ord, vector, block`` to one folder per block, every vector checked.

    Only the blocks present in ``rows`` are replaced, so a repeated or resumed run is safe.
    """
    valid = rows.withColumn("vector", checked(F.col("vector"), dim))
    (
        valid.select(*KEY, "vector", "block")
        .repartition("block")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("block")
        .parquet(path)
    )


def read_vector_blocks(spark: SparkSession, path: str, dim: int, form: str = "parquet") -> DataFrame:
    """Stored vectors, checked again on the way in; ``form`` may be ``json``."""
    stored = spark.read.schema(schemas.VECTORS).format(form).load(path)
    return stored.withColumn("vector", checked(F.col("vector"), dim))


# --- JSON lines -------------------------------------------------------------------------


def _known_label(value: Column, where: str) -> Column:
    message = F.concat(F.lit(f"bad {where} label: "), F.coalesce(value, F.lit("null")))
    return F.when(value.isin(*LABELS), value).otherwise(F.raise_error(message).cast("string"))


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.GOLD).json(path)


def read_eval_rows(spark: SparkSession, path: str, prefer: str = "gold_label") -> DataFrame:
    """``doc_id, chunk_ord, title, text, gold, split``; both spellings of the gold field."""
    stored = spark.read.schema(schemas.EVAL_ROWS).json(path)
    other = "gold" if prefer == "gold_label" else "gold_label"
    gold = _known_label(F.coalesce(prefer, other), "gold")
    return stored.select(
        *KEY, F.coalesce("title", F.lit("")).alias("title"), "text", gold.alias("gold"), "split"
    )


def read_split_tags(spark: SparkSession, path: str) -> DataFrame | None:
    """``doc_id, chunk_ord, split``, or None when there is no such file."""
    try:
        return spark.read.schema(schemas.EVAL_ROWS).json(path).select(*KEY, "split")
    except AnalysisException:
        return None


def write_rows(rows: DataFrame, path: str) -> None:
    """One JSON object per row."""
    rows.write.mode("overwrite").json(path)


def read_frozen_queries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FROZEN_QUERIES).json(path)


def content_digest(rows: DataFrame, digits: int = 16) -> DataFrame:
    """One row: digest over all rows whatever their order, for auditing a frozen set.

    Row digests are summed in 14 slices of 16 bits, so nothing is gathered in one place and
    repeated rows still count.
    """
    row = F.sha2(F.to_json(F.struct(*rows.columns)), 256)
    slices = [
        F.sum(F.conv(F.substring(row, 1 + 4 * i, 4), 16, 10).cast("long")).alias(f"s{i}")
        for i in range(14)
    ]
    total = rows.agg(F.count(F.lit(1)).alias("n"), *slices)
    joined = F.concat_ws(":", F.col("n").cast("string"), *[F.col(f"s{i}").cast("string") for i in range(14)])
    return total.select("n", F.substring(F.sha2(joined, 256), 1, digits).alias("digest"))


# --- prediction files -------------------------------------------------------------------


_LINE_RUN = r"run=([^/]+)/[^/]*$"


def write_predictions(rows: DataFrame, path: str, run: str) -> None:
    """Predictions of one run, one JSON object per line, in a folder of its own below ``path``.

    Lines can be split over tasks; ``method`` is part of every line.
    """
    rows.write.mode("overwrite").json(f"{path}/run={run}")


def _wrapped_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Files that hold one object of ``config`` and ``rows``."""
    found = (
        spark.read.option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True)
        .schema(schemas.PREDICTIONS).json(path, pathGlobFilter="*.json")
        .select("config", "rows", F.col("_metadata.file_path").alias("_path"))
        .filter(F.col("rows").isNotNull() & (F.regexp_extract("_path", _LINE_RUN, 1) == ""))
    )
    stem = F.regexp_extract("_path", r"([^/]*)\.json$", 1)
    cost = F.coalesce("config.cost_per_1k_usd", "config.cost_usd_per_1k", F.lit(0.0))
    return found.select(
        F.coalesce("config.method", stem).alias("method"), stem.alias("run"), "_path",
        cost.alias("cost_per_1k_usd"), F.explode("rows").alias("_r"),
    ).select("method", "run", "_path", "cost_per_1k_usd", "_r.*")


def _line_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Runs written by ``write_predictions``."""
    layout = schemas.PREDICTIONS["rows"].dataType.elementType
    layout = T.StructType([*layout.fields, T.StructField("method", T.StringType()), T.StructField("cost_per_1k_usd", T.DoubleType())])
    found = (
        spark.read.option("mode", "PERMISSIVE").option("recursiveFileLookup", True)
        .schema(layout).json(path, pathGlobFilter="*.json").withColumn("_path", F.col("_metadata.file_path"))
        .withColumn("run", F.regexp_extract("_path", _LINE_RUN, 1))
        .filter((F.col("run") != "") & F.col("doc_id").isNotNull())
    )
    columns = [f.name for f in schemas.PREDICTIONS["rows"].dataType.elementType.fields]
    return found.select(
        F.coalesce("method", "run").alias("method"), "run", "_path",
        F.coalesce("cost_per_1k_usd", F.lit(0.0)).alias("cost_per_1k_usd"), *columns,
    )


def read_predictions(spark: SparkSession, path: str, skip_methods: tuple[str, ...] = ()) -> DataFrame:
    """One row per prediction from a folder of runs and of wrapped result files.

    The method is what the rows or the file say, else the run's or file's name. Of two runs for
    one method the last by name counts. ``unreadable_predictions`` lists files that give no rows.
    """
    named = _wrapped_predictions(spark, path).unionByName(_line_predictions(spark, path))
    if skip_methods:
        named = named.filter(~F.col("method").isin(*skip_methods))
    latest = named.groupBy("method").agg(F.max("run").alias("run"))
    return named.join(latest, ["method", "run"]).drop("run", "_path")


def unreadable_predictions(spark: SparkSession, path: str) -> DataFrame:
    """``file`` of every result file without a readable prediction."""
    every = spark.read.option("recursiveFileLookup", True).text(path, pathGlobFilter="*.json")
    every = every.select(F.col("_metadata.file_path").alias("_path")).distinct()
    good = _wrapped_predictions(spark, path).select("_path").union(_line_predictions(spark, path).select("_path"))
    missing = every.join(good.distinct(), "_path", "left_anti")
    return missing.select(F.regexp_extract("_path", "([^/]+)$", 1).alias("file"))


# --- split manifests --------------------------------------------------------------------


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Sorted document ids, one per line, one folder per split."""
    (
        manifest.select(F.col("doc_id").alias("value"), "split")
        .repartitionByRange("split", "value")
        .sortWithinPartitions("split", "value")
        .write.mode("overwrite")
        .partitionBy("split")
        .text(path)
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, split`` from a manifest folder, or from ``<split>.txt`` files."""
    lines = spark.read.text(path, recursiveFileLookup=True).select(
        strip(F.col("value")).alias("doc_id"), F.col("_metadata.file_path").alias("_file")
    )
    split = F.regexp_extract("_file", r"(?:split=([^/]+)/[^/]*|([^/]+)\.txt)$", 1)
    plain = F.regexp_extract("_file", r"([^/]+)\.txt$", 1)
    return lines.filter(F.col("doc_id") != "").select(
        "doc_id", F.when(split != "", split).otherwise(plain).alias("split")
    )


# --- tagged texts and articles ----------------------------------------------------------


def read_tagged_texts(spark: SparkSession, path: str) -> DataFrame:
    """``text, tags, label`` from a CSV with filled templates and BIO tag lists."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
    text = F.translate(F.col("`Filled Template`"), "\u0000", "")
    tags = F.regexp_extract_all(F.translate("Tokens", "\u0000", ""), F.lit("'([^']*)'"), F.lit(1))
    return (
        rows.select(text.alias("text"), tags.alias("tags"))
        .filter(F.col("text") != "")
        .withColumn("label", label_from_tags(F.col("tags")))
    )


def sample_articles(
    articles: DataFrame, order: str, n: int, min_chars: int = 500, max_chars: int = 2000
) -> DataFrame:
    """The first ``n`` articles with enough text, cut to their opening characters."""
    body = strip(F.col("text"))
    return (
        articles.withColumn("text", body)
        .filter(F.length("text") >= min_chars)
        .orderBy(order)
        .limit(n)
        .withColumn("text", F.substring("text", 1, max_chars))
    )


# --- run statistics ---------------------------------------------------------------------


def write_stats(spark: SparkSession, stats: dict, path: str) -> None:
    """One small JSON row next to an output."""
    spark.createDataFrame([stats]).coalesce(1).write.mode("overwrite").json(path)
