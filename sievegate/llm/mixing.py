"""Mixing of sources to target weights by word counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievegate.llm.shared import drop, slice_bits, stored, sums_before, words_of

#: Weights that sources take in turn, in their order.
WEIGHTS = (1, 2, 3)
#: No source and no document counts more often than this.
MOST_EPOCHS = 3
_KEY_DIGITS = 8


def source_targets(sizes: DataFrame, most: int = MOST_EPOCHS) -> DataFrame:
    """``target`` for every source, given ``source_rank``, ``source_size`` and ``weight``.

    All words are shared by weight. A source whose share exceeds ``most`` times its size stops
    there and the rest is shared again: in order of size per weight, sources stop until the share
    per unit of weight no longer exceeds the next one's limit. One row per source comes in.
    """
    before = Window.orderBy(F.col("source_size") / F.col("weight"), "source_rank")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    limit = most * F.col("source_size")
    every = Window.partitionBy(F.lit(1))
    shared = sizes.select(
        "*",
        F.sum("source_size").over(every).alias("_words"),
        F.sum("weight").over(every).alias("_weight"),
        F.coalesce(F.sum(limit).over(before), F.lit(0)).alias("_stopped"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("_gone"),
    )
    unit = (F.col("_words") - F.col("_stopped")) / (F.col("_weight") - F.col("_gone"))
    open_unit = F.when(limit > unit * F.col("weight"), unit)
    levelled = shared.withColumn("_unit", F.max(open_unit).over(every))
    # the first source that stays below its limit has the largest share of those that do
    return levelled.select(
        *sizes.columns,
        F.least(limit.cast("double"), F.coalesce(F.col("_unit"), F.lit(0.0)) * F.col("weight")).alias("target"),
    )


def mix_sources(
    docs: DataFrame, seed: int = 0, id_column: str = "doc_id", text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """How many words the mix takes of every document.

    Documents get a key from a hash of ``seed`` and their id and are range-sorted by it within
    each source; prefix sums of their words tell where the source's exact budget (its target,
    rounded) ends. Full epochs take every document, the last one stops at the budget inside a
    document. Reruns agree, whatever the partitioning.

    Sources are ordered by code point, null last, and weigh 1, 2, 3 in turn. A null text has no
    words; a source without words has the target 0; rows with the same id and size follow each
    other in any order, which no result shows; a null id hashes like the empty string. An empty
    table gives no rows. Other columns are ignored.
    """
    narrow = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        F.size(words_of(F.col(text_column))).cast("long").alias("size"),
    )
    return mix_sizes(stored(narrow, "sizes"), seed).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "source_rank"
    )


def _targets(narrow: DataFrame) -> tuple[DataFrame, int]:
    """A row per source: rank, size, target, full epochs and the words of the last one; and bits that slice rows."""
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    ranks = Window.orderBy(F.col("source").asc_nulls_last())
    sizes = sizes.withColumn("source_rank", F.row_number().over(ranks))
    turn = (F.col("source_rank") - 1) % len(WEIGHTS)
    sizes = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (turn + 1).cast("int")))
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    shared = source_targets(sizes).withColumn("epochs", epochs)
    targets = stored(shared.withColumn("rest", budget - F.col("epochs") * F.col("source_size")), "targets")
    return targets, slice_bits(targets.agg(F.max("_rows")).first()[0] or 0)


def mix_sizes(narrow: DataFrame, seed: int = 0) -> DataFrame:
    """The same for a stored table of ``doc_id``, ``source`` and ``size``; its columns stay."""
    targets, bits = _targets(narrow)
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")))
    head = F.conv(F.substring(key, 1, _KEY_DIGITS), 16, 10).cast("long")
    keyed = narrow.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    keyed = keyed.withColumn("key", key).withColumn("piece", F.shiftright(head, 4 * _KEY_DIGITS - bits))
    placed = sums_before(keyed, "source_rank", "piece", ["key", "doc_id", "size"], "size", "before")
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    taken = (F.col("epochs") * F.col("size") + last).cast("long").alias("taken")
    return placed.select(*narrow.columns, "source_size", "source_rank", "target", taken)


def _cut_after(text: Column, words: Column) -> Column:
    """``text`` up to the end of its word number ``words``."""
    rest = F.element_at(F.split(text, r"[^\x20\x09-\x0D]+", words + 1), -1)
    return F.substr(text, F.lit(1), F.length(text) - F.length(rest))


def mixed_documents(
    docs: DataFrame, columns: tuple[str, ...], seed: int = 0, id_column: str = "doc_id",
    text_column: str = "text", source_column: str = "source", length_column: str = "n_chars",
) -> DataFrame:
    """The mix itself: every document as often as the mix takes it, whole or cut after a word.

    In the order of keys a source's last epoch ends inside one document, so one row for each source
    (full epochs, and where and after how many words the last one ends) decides all: texts are read,
    compared with the row of their source and written, without a shuffle.

    ``columns`` come back; the text of a cut copy ends with its last taken word and its length
    column is counted anew. Documents of which nothing is taken, those without words among them,
    are left out. Null texts and sources, null ids and empty tables are as in ``mix_sources``. Rows
    equal in id and text share what their source takes of them in the last epoch in equal parts,
    rounded down. Other columns are ignored.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(f"`{id_column}`").cast("long").cast("string")))
    text = F.col(f"`{text_column}`").cast("string")
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), text.alias("words"),
        F.col(f"`{source_column}`").cast("string").alias("source"),
        F.size(words_of(text)).cast("long").alias("size"),
        F.struct(key.alias("key"), F.xxhash64(text).alias("digest")).alias("place"),
    )
    narrow = stored(keyed.select("source", "size", "place"), "sizes")
    ends = stored(last_epochs(narrow), "ends")
    drop(narrow)
    met = keyed.filter("size > 0").join(ends, F.col("source").eqNullSafe(F.col("_source")))
    part = F.when(F.col("place") < F.col("end"), F.col("size")).when(F.col("place") == F.col("end"), F.col("part"))
    whole, part = F.col("epochs") + F.when(part == F.col("size"), 1).otherwise(0), F.coalesce(part, F.lit(0))
    cut = F.when((part > 0) & (part < F.col("size")), F.array(_cut_after(F.col("words"), part.cast("int"))))
    copies = F.concat(F.array_repeat("words", whole.cast("int")), F.coalesce(cut, F.array().cast("array<string>")))
    taken = met.select("row", F.explode(copies).alias("copy"))
    types = dict(docs.dtypes)
    fresh = {text_column: F.col("copy"), length_column: F.length("copy")}
    return taken.select(*[fresh.get(c, F.col(f"row.`{c}`")).cast(types[c]).alias(c) for c in columns])


def last_epochs(narrow: DataFrame) -> DataFrame:
    """One row per source: ``_source``, full ``epochs``, and the ``end`` of the last one.

    ``narrow`` has ``source``, ``size`` and ``place``, the order of rows. The last epoch takes all
    places before ``end`` and ``part`` words of each row there.
    """
    targets, bits = _targets(narrow)
    head = F.conv(F.substring("place.key", 1, _KEY_DIGITS), 16, 10).cast("long")
    rows = narrow.groupBy("source", "place", "size").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("sum", F.col("size") * F.col("copies"))
    rows = rows.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    rows = rows.withColumn("piece", F.shiftright(head, 4 * _KEY_DIGITS - bits))
    placed = sums_before(rows, "source_rank", "piece", ["place", "size"], "sum", "before")
    open_ = (F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("sum"))
    part = F.floor((F.col("rest") - F.col("before")) / F.col("copies"))
    ends = placed.filter(open_).select("source_rank", F.col("place").alias("end"), part.alias("part"))
    every = targets.select("source_rank", F.col("source").alias("_source"), "epochs")
    return every.join(ends, "source_rank", "left").drop("source_rank")
