"""Leak-free training and evaluation rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


KEY = ["doc_id", "chunk_ord"]


def document_sizes(corpus: DataFrame) -> DataFrame:
    """``doc_id, thread_id, n_chunks``."""
    return corpus.groupBy("doc_id", "thread_id").agg(F.count(F.lit(1)).alias("n_chunks"))


def require_known(ids: DataFrame, documents: DataFrame, what: str) -> None:
    """Raise when an id has no document; shows a few of them."""
    missing = ids.select("doc_id").distinct().join(documents, "doc_id", "left_anti")
    shown = [row.doc_id for row in missing.limit(3).collect()]
    if shown:
        raise ValueError(f"{what} not in the corpus, for example {shown}")


def gold_threads(documents: DataFrame, gold: DataFrame) -> DataFrame:
    """Distinct threads that hold a gold document."""
    return documents.join(gold.select("doc_id"), "doc_id", "left_semi").select("thread_id").distinct()


def allowed_documents(documents: DataFrame, gold: DataFrame, train: DataFrame) -> DataFrame:
    """Train documents none of whose thread mates is a gold document."""
    excluded = gold_threads(documents, gold)
    clean = documents.join(excluded, "thread_id", "left_anti")
    outside = train.select("doc_id").distinct()
    inside = clean.select("doc_id").distinct()
    known = outside.join(documents.select("doc_id"), "doc_id", "left_anti")
    return outside.join(inside, "doc_id", "left_semi").unionByName(known)


def exclusion_stats(documents: DataFrame, gold: DataFrame, train: DataFrame) -> DataFrame:
    """What is cut at document grain and at thread grain, and the largest gold thread."""
    in_gold = gold.select("doc_id").distinct().withColumn("is_gold", F.lit(True))
    in_train = train.select("doc_id").distinct().withColumn("is_train", F.lit(True))
    flagged = documents.join(in_gold, "doc_id", "left").join(in_train, "doc_id", "left")
    is_gold = F.coalesce("is_gold", F.lit(False))
    is_train = F.coalesce("is_train", F.lit(False))
    threads = flagged.groupBy("thread_id").agg(
        F.count_if(is_gold).alias("gold"),
        F.count(F.lit(1)).alias("docs"),
        F.count_if(is_gold & is_train).alias("doc_cut"),
        F.coalesce(F.sum(F.when(is_gold & is_train, F.col("n_chunks"))), F.lit(0)).alias("doc_chunks"),
        F.count_if(is_train).alias("thread_cut"),
        F.coalesce(F.sum(F.when(is_train, F.col("n_chunks"))), F.lit(0)).alias("thread_chunks"),
    )
    totals = {
        "doc_cut_docs": "doc_cut",
        "doc_cut_chunks": "doc_chunks",
        "thread_cut_docs": "thread_cut",
        "thread_cut_chunks": "thread_chunks",
    }
    return threads.filter(F.col("gold") > 0).agg(
        F.count(F.lit(1)).alias("gold_threads"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in totals.items()],
        F.coalesce(F.max("docs"), F.lit(0)).alias("max_gold_thread_docs"),
    )


def train_rows(corpus: DataFrame, labels: DataFrame, allowed: DataFrame) -> DataFrame:
    """Weakly labelled chunks of allowed documents."""
    weak = labels.select(*KEY, F.col("label").alias("weak_label"))
    return (
        corpus.join(allowed.select("doc_id"), "doc_id", "left_semi")
        .join(weak, KEY)
        .select(*KEY, "title", "text", "weak_label")
    )


def leaked_rows(rows: DataFrame, allowed: DataFrame) -> DataFrame:
    """Rows whose document is not allowed; must be empty."""
    return rows.join(allowed.select("doc_id"), "doc_id", "left_anti")


def tag_splits(rows: DataFrame, manifest: DataFrame, order: tuple[str, ...] = ("train", "dev", "test")) -> DataFrame:
    """Adds the owning split; the last split in ``order`` wins, no split at all is an error."""
    position = F.array_position(F.array(*map(F.lit, order)), F.col("split"))
    owner = (
        manifest.groupBy("doc_id")
        .agg(F.max(position).cast("int").alias("_at"))
        .select("doc_id", F.element_at(F.array(*map(F.lit, order)), F.col("_at")).alias("_owner"))
    )
    lost = F.raise_error(F.concat(F.lit("in no split: "), F.col("doc_id"))).cast("string")
    tagged = rows.drop("split").join(owner, "doc_id", "left")
    return tagged.withColumn("split", F.coalesce("_owner", lost)).drop("_owner")


def subset_by_split(rows: DataFrame, tags: DataFrame, split: str = "test") -> DataFrame:
    """Rows whose (document, chunk) is tagged with ``split``."""
    return rows.join(tags.filter(F.col("split") == split).select(*KEY), KEY, "left_semi")


def join_vectors(rows: DataFrame, vectors: DataFrame) -> DataFrame:
    """Rows with their vector; a row without one is an error, not a silent drop."""
    lost = F.raise_error(
        F.concat(F.lit("no vector for "), F.concat_ws(":", *KEY))
    ).cast("array<float>")
    joined = rows.join(vectors.select(*KEY, "vector"), KEY, "left")
    return joined.withColumn("vector", F.coalesce("vector", lost))


def key_differences(left: DataFrame, right: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``only_left, only_right, shared`` key counts; equal key sets have two zeros."""
    keys = keys or KEY
    sides = (
        left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .unionByName(right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
        .groupBy(*keys)
        .agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    )
    return sides.agg(
        F.count_if(F.col("_r") == 0).alias("only_left"),
        F.count_if(F.col("_l") == 0).alias("only_right"),
        F.count_if((F.col("_l") == 1) & (F.col("_r") == 1)).alias("shared"),
    )


def review_coverage(candidates: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Candidates against reviewed rows: coverage, strays, and changes without a note."""
    left = candidates.select(*KEY, "weak_label")
    right = verdicts.select(*KEY, "gold_label", "note", F.lit(True).alias("_reviewed"))
    joined = left.withColumn("_asked", F.lit(True)).join(right, KEY, "full_outer")
    changed = F.col("weak_label") != F.col("gold_label")
    return joined.agg(
        F.count_if("_asked").alias("candidates"),
        F.count_if(F.col("_asked") & F.col("_reviewed")).alias("reviewed"),
        F.count_if(F.col("_asked") & F.col("_reviewed").isNull()).alias("missing"),
        F.count_if(F.col("_asked").isNull()).alias("strays"),
        F.count_if(changed).alias("changed"),
        F.count_if(changed & (F.trim(F.coalesce("note", F.lit(""))) == "")).alias(
            "changed_without_note"
        ),
    )


def require_row_count(rows: DataFrame, low: int | None, high: int | None, what: str) -> int:
    """Number of rows, which has to lie in ``[low, high]`` as far as bounds are given."""
    found = rows.count()
    if (low is not None and found < low) or (high is not None and found > high):
        raise ValueError(f"{what}: {found} rows, expected {low} to {high}")
    return found
