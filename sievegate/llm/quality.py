"""Quality rules kept as a ledger of failure bits and measurements."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievegate.llm.shared import words_of

#: Words of a window whose repeats count.
WINDOW = 5
# Characters that count as symbols.
SYMBOLS = "#*$%&|<>"


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once per row, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column) -> Column:
    """Number of words that lie in a window of five words found twice or more in ``words``.

    Windows are hashed to 64 bits and sorted with their places; places whose neighbour has the same
    hash are repeats. Sorted again, each repeat adds the words up to the next one, five at most.
    """

    def from_hashes(hashes: Column) -> Column:
        # a window's hash chains the hashes of its words
        windows = F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)),
            lambda i: F.struct(
                F.xxhash64(*[F.get(hashes, i + (k - 1)) for k in range(WINDOW)]).alias("h"), i.alias("i")
            ),
        )
        return let(windows, from_windows)

    def from_windows(windows: Column) -> Column:
        distinct = F.size(F.array_distinct(F.transform(windows, lambda w: w["h"])))
        return F.when(distinct == F.size(windows), F.lit(0)).otherwise(let(F.sort_array(windows), from_sorted))

    def from_sorted(ordered: Column) -> Column:
        def same(x: Column, place: Column) -> Column:
            return F.coalesce(F.get(ordered, place)["h"] == x["h"], F.lit(False))

        hits = F.filter(ordered, lambda x, n: same(x, n + 1) | ((n > 0) & same(x, F.greatest(n - 1, F.lit(0)))))
        return let(F.sort_array(F.transform(hits, lambda x: x["i"])), covered)

    def covered(starts: Column) -> Column:
        steps = F.transform(
            starts, lambda x, n: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, n + 1) - x, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < WINDOW + 1, F.lit(0)).otherwise(let(hashes, from_hashes)).cast("long")


#: Columns that measuring adds.
MEASURED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "failed")


def measurements(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with the measured values that rules look at."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in MEASURED])
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = docs.select(row.alias("_row"), text.alias("_text"), words_of(F.col(text_column)).alias("_words"), lines.alias("_lines"))
    return first.select(
        "_row.*",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
    )


@dataclass(frozen=True)
class Rule:
    """Fails where ``fails`` is true; the place in the list of rules is its bit."""

    name: str
    fails: Column


def rules() -> list[Rule]:
    """Every rule, in the order of their bits; new rules go to the end."""
    n, chars, symbols = F.col("n_words"), F.col("word_chars"), F.col("n_symbols")
    return [
        Rule("too_few_words", n < 10),
        Rule("repeated_windows", 100 * F.col("n_repeat_words") > 20 * n),
        Rule("short_words", chars < 2 * n),
        Rule("long_words", chars > 20 * n),
        Rule("symbols", 100 * symbols > 25 * n),
        Rule("repeated_lines", 100 * F.col("n_dup_lines") > 50 * F.col("n_lines")),
    ]


#: Rules that reject a document, by version. The first two are the base rules of every version.
POLICIES = {
    1: ("too_few_words", "repeated_windows"),
    2: ("too_few_words", "repeated_windows", "short_words", "long_words", "symbols", "repeated_lines"),
}
CURRENT = 2


def mask_of(names: tuple[str, ...]) -> int:
    places = {rule.name: bit for bit, rule in enumerate(rules())}
    return sum(1 << places[name] for name in names)


def ledger(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with measurements and ``failed``, one bit per rule, each evaluated once.

    A null or empty text has no words and fails ``too_few_words`` alone. Rows are judged one by one,
    so repeated rows get equal entries; other columns pass through, those with the name of a
    measurement or ``failed`` are replaced. An empty table gives no rows. Nothing is shuffled.
    """
    bits = [F.when(rule.fails, F.lit(1 << bit)).otherwise(F.lit(0)) for bit, rule in enumerate(rules())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measurements(docs, text_column).withColumn("failed", failed)


def passes(policy: int = CURRENT) -> Column:
    """Whether a ledger entry passes a version of the policy."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0


def ablation(entries: DataFrame, policy: int = CURRENT) -> DataFrame:
    """For each rule of a policy: documents that fail it, and those kept if it were dropped.

    Entries are counted by their bits first, so only a row for each combination of bits is left.
    """
    mask = mask_of(POLICIES[policy])
    combined = entries.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("failed")).count()
    names = [rule.name for rule in rules()]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << names.index(n)).alias("bit")) for n in POLICIES[policy]]))
    one = combined.select("failed", "count", each.alias("r")).select("failed", "count", "r.rule", "r.bit")
    failing = F.when(F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("count")).otherwise(0)
    only = F.when(F.col("failed") == F.col("bit"), F.col("count")).otherwise(0)
    return one.groupBy("rule").agg(
        F.sum(failing).alias("n_failed"), F.sum(only).alias("n_kept_without"),
        F.expr("bit_or(failed)").alias("failed_with"),
    )


def judged(docs: DataFrame, policy: int = CURRENT) -> DataFrame:
    """The ledger of ``doc_id`` and ``text`` with the base rules' and the policy's verdict.

    Nulls, empty texts, repeated rows and empty tables are as in ``ledger``; a null id stays null.
    """
    entries = ledger(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    base = F.col("failed").bitwiseAND(F.lit(mask_of(POLICIES[1]))) != 0
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), passes(policy).alias("kept"), "failed", "n_lines",
    )
