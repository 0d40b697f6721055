"""Secret scans: fixed patterns, and character Markov models of random strings and identifiers."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievegate.llm.quality import let
from sievegate.llm.shared import stored

# Patterns of the base kinds, in their order, and the least length of what counts.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HEAD = r"""^[^:=]*[:=]\x20*["']?"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{32,}"
ASSIGN_VALUE, ACCESS_LENGTH = 8, 16

#: Characters the models know; candidates consist of them.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Least length of a candidate, and the mean log-likelihood ratio per step from which it counts.
CANDIDATE_LENGTH, THRESHOLD = 20, 0.7
CANDIDATE = f"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{CANDIDATE_LENGTH},}}"
#: Labelled documents whose words train the model of ordinary identifiers, and random strings
#: that train the other. Both bounds hold at any input size.
SAMPLE_DOCUMENTS, SAMPLE_STRINGS = 2_000, 20_000

#: Code points of the parts that a text is put together from.
_PART = 1_000
_SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


def running(values: Column, combine) -> Column:
    """For every place of an array, the combination of all values up to it.

    Every step combines with what lies 1, 2, 4, ... places before, so an array of n values takes
    about n * log(n) steps and no array grows on the way.
    """
    last = F.floor(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")
    shifts = F.transform(F.sequence(F.lit(0), last), lambda k: F.pow(F.lit(2.0), k).cast("int"))

    def step(state: Column, shift: Column) -> Column:
        return F.transform(state, lambda x, i: combine(x, F.when(i >= shift, F.get(state, i - shift))))

    return F.aggregate(shifts, values, step)


def running_sum(values: Column) -> Column:
    return running(values, lambda x, before: x + F.coalesce(before, F.lit(0)))


def _spans(text: Column, pattern: str, rank: int, kind: str, keeps=None, guard: Column | None = None) -> Column:
    """Spans of all matches of ``pattern``, by code point; ``keeps`` judges the matched text.

    The text between matches and the matches themselves, in turn, give every place by the running
    sum of their lengths.
    """

    def located(found: Column, between: Column) -> Column:
        sizes = F.transform(found, lambda m: F.length(m))
        steps = F.zip_with(F.slice(between, F.lit(1), F.size(found)), sizes, lambda gap, size: F.length(gap) + size)
        return let(running_sum(steps), lambda ends: placed(found, ends))

    def placed(found: Column, ends: Column) -> Column:
        pairs = F.arrays_zip(found.alias("match"), ends.alias("end"))
        if keeps is not None:
            pairs = F.filter(pairs, lambda x: keeps(x["match"]))
        return F.transform(
            pairs,
            lambda x: F.struct(
                (x["end"] - F.length(x["match"])).alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                x["end"].alias("end"),
            ),
        )

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    spans = let(F.struct(found.alias("f"), F.split(text, pattern).alias("b")), lambda x: located(x["f"], x["b"]))
    here = text.rlike(pattern) if guard is None else guard
    return F.when(here, spans.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns: assign, access and hex, leftmost and without overlap by kind."""
    value = lambda m: F.length(F.regexp_replace(m, ASSIGN_HEAD, "")) >= ASSIGN_VALUE
    return F.concat(
        _spans(text, ASSIGN, 0, "assign", value),
        _spans(text, ACCESS, 1, "access", lambda m: F.length(m) >= ACCESS_LENGTH, text.contains("AKIA")),
        _spans(text, HEX, 2, "hex"),
    )


@dataclass(frozen=True)
class Models:
    """Log-likelihood ratio, random over ordinary, of each step from one character to the next."""

    ratios: tuple[float, ...]

    def score(self, token: Column) -> Column:
        """Mean ratio over the steps of a token made of known characters."""
        table, size = F.lit(list(self.ratios)), len(ALPHABET)
        codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
        # a step's code and the one before it, then their entry in the table
        def total(known: Column) -> Column:
            steps = F.sequence(F.lit(1), F.size(known) - 1)
            return F.aggregate(
                steps, F.lit(0.0),
                lambda t, i: t + F.element_at(table, (F.get(known, i - 1) - 1) * size + F.get(known, i)),
            )

        return let(F.filter(codes, lambda c: c > 0), total) / (F.length(token) - 1)


def fit_models(samples: DataFrame) -> Models:
    """Models from rows of ``token`` and ``random`` (boolean): counts of steps, one added to each.

    Only the counts come to the driver, at most two for each pair of characters.
    """
    size = len(ALPHABET)
    steps = F.transform(
        F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substring(F.col("token"), i, F.lit(2))
    )
    pairs = samples.filter(F.length("token") > 1).select("random", F.explode(steps).alias("pair"))
    counts = [[1] * (size * size), [1] * (size * size)]
    for row in pairs.groupBy("random", "pair").count().collect():
        a, b = ALPHABET.find(row["pair"][0]), ALPHABET.find(row["pair"][1])
        if a >= 0 and b >= 0:
            counts[row["random"]][a * size + b] += row["count"]
    sums = [[sum(c[a * size : (a + 1) * size]) for a in range(size)] for c in counts]
    logs = [[math.log(c / s[i // size]) for i, c in enumerate(cs)] for cs, s in zip(counts, sums, strict=True)]
    return Models(tuple(r - o for o, r in zip(*logs, strict=True)))


def random_strings(spark, n: int = SAMPLE_STRINGS) -> DataFrame:
    """Strings as secrets have them, from a hash: hexadecimal, base 64, letters and digits."""
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 256)
    other = F.sha2(F.concat(F.lit("more"), F.col("id").cast("string")), 256)
    base64 = F.base64(F.unhex(digest))
    plain = F.regexp_replace(F.concat(base64, F.base64(F.unhex(other))), "[+/=]", "")
    kind = F.col("id") % 4
    token = F.when(kind == 0, digest).when(kind == 1, base64).when(kind == 2, plain).otherwise(F.upper(plain))
    return spark.range(n).select(token.alias("token"), F.lit(True).alias("random"))


def ordinary_identifiers(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """Words of at most ``most`` documents labelled as good, and identifiers made of them."""
    chosen = labels.filter("quality = 1").select(F.col("doc_id").alias("_id")).distinct()
    chosen = stored(chosen.orderBy(F.xxhash64("_id"), "_id").limit(most), "labelled")
    texts = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id"), "left_semi")
    clean = F.regexp_replace("text", r"(?<![A-Za-z0-9])\S*[0-9]\S*", " ")
    pairs = F.regexp_extract_all(clean, F.lit("[A-Za-z]{3,}[^A-Za-z]+[A-Za-z]{3,}"), F.lit(0))
    parts = texts.select(F.explode(pairs).alias("pair"))
    first, second = F.regexp_extract("pair", "^[A-Za-z]+", 0), F.regexp_extract("pair", "[A-Za-z]+$", 0)
    forms = [
        F.concat(first, second), F.concat_ws("_", first, second), F.concat(F.lower(first), F.initcap(second)),
        F.upper(F.concat_ws("_", first, second)), F.concat(F.lower(first), F.lit("-"), F.lower(second), F.lit("1")),
        F.concat_ws("/", first, second),
    ]
    return parts.select(F.explode(F.array(*forms)).alias("token"), F.lit(False).alias("random"))


def labelled_models(docs: DataFrame, labels: DataFrame) -> Models:
    """Models of random strings and of identifiers from documents labelled as good.

    Labels without a document, and null or empty texts, give no samples; without any sample of a
    class its steps are all equally likely.
    """
    return fit_models(random_strings(docs.sparkSession).union(ordinary_identifiers(docs, labels)))


def _apart(base: Column, more: Column) -> Column:
    """Those of ``more`` that touch no span of ``base``; both are sorted, and spans of ``more`` do not overlap.

    Both are merged in the order of starts. A span is touched if a base span before it ends
    behind its start, or the next base span starts before its end.
    """

    def judged(every: Column) -> Column:
        ends = F.transform(every, lambda s: F.when(s["rank"] < 3, s["end"]))
        starts = F.transform(F.reverse(every), lambda s: F.when(s["rank"] < 3, s["start"]))
        furthest = running(ends, lambda x, before: F.greatest(x, before))
        nearest = F.reverse(running(starts, lambda x, before: F.least(x, before)))
        marked = F.arrays_zip(every.alias("span"), furthest.alias("end"), nearest.alias("start"))
        alone = F.filter(
            marked,
            lambda x: (x["span"]["rank"] == 3)
            & (F.coalesce(x["end"], F.lit(0)) <= x["span"]["start"])
            & (F.coalesce(x["start"], x["span"]["end"]) >= x["span"]["end"]),
        )
        return F.transform(alone, lambda x: x["span"])

    merged = let(F.array_sort(F.concat(base, more)), judged)
    return F.when((F.size(base) > 0) & (F.size(more) > 0), merged).otherwise(more)


def find_secrets(docs: DataFrame, models: Models, text_column: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``, sorted arrays of (start, rank, kind, end).

    To the spans of the fixed patterns come those of candidates, maximal runs of 20 or more known
    characters, whose mean log-likelihood ratio of the two models reaches the threshold and that
    touch no base span (kind markov). Places count code points, ends are exclusive. A text with n
    matches takes about n * log(n) steps.

    A null or empty text has no spans. Rows are judged one by one, so repeated rows get equal
    results; other columns pass through, those called base or spans are replaced. An empty table
    gives no rows. Nothing is shuffled.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("base", "spans")]
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    likely = lambda m: models.score(m) >= THRESHOLD
    first = docs.select(F.struct(*kept).alias("__row"), text.alias("__text"))
    first = first.withColumn("base", F.array_sort(base_spans(F.col("__text"))))
    first = first.withColumn("__more", _spans(F.col("__text"), CANDIDATE, 3, "markov", likely))
    spans = F.array_sort(F.concat("base", _apart(F.col("base"), F.col("__more"))))
    return first.select("__row.*", "base", spans.alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with every span, or union of overlapping spans, replaced by ``mark``; ``spans`` are sorted.

    The text is cut into parts of equal length once, and what stays is put together from them.
    """

    def between(parts: Column, begin: Column, end: Column) -> Column:
        """The text from ``begin`` to ``end``."""
        first, last = F.floor(begin / _PART), F.floor(end / _PART)
        head = lambda n: F.coalesce(F.get(parts, n), F.lit(""))
        middle = F.array_join(F.slice(parts, (first + 2).cast("int"), F.greatest(last - first - 1, F.lit(0)).cast("int")), "")
        several = F.concat(
            F.substr(head(first), (begin % _PART + 1).cast("int")), middle,
            F.substr(head(last), F.lit(1), (end % _PART).cast("int")),
        )
        one = F.substr(head(first), (begin % _PART + 1).cast("int"), (end - begin).cast("int"))
        return F.when(first == last, one).otherwise(several)

    def whole(x: Column) -> Column:
        spans, furthest, parts = x["s"], x["e"], x["p"]
        heads = F.filter(
            F.transform(spans, lambda s, i: F.when((i == 0) | (s["start"] >= F.get(furthest, i - 1)), i)),
            lambda i: i.isNotNull(),
        )
        kept = F.transform(
            heads,
            lambda i: F.concat(
                between(parts, F.when(i == 0, F.lit(0)).otherwise(F.get(furthest, i - 1)), F.get(spans, i)["start"]),
                F.lit(mark),
            ),
        )
        return F.concat(F.array_join(kept, ""), between(parts, F.element_at(furthest, -1), x["n"]))

    ends = running(F.transform(spans, lambda s: s["end"]), lambda a, before: F.greatest(a, before))
    parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PART}}}"), F.lit(0))
    state = F.struct(spans.alias("s"), ends.alias("e"), parts.alias("p"), F.length(text).alias("n"))
    return F.when(F.size(spans) > 0, let(state, whole)).otherwise(text)


def scan(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document with the numbers of base spans by kind and all spans.

    Nulls, empty texts, repeated rows and empty tables are as in ``find_secrets``; a null id stays null.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = find_secrets(narrow, labelled_models(narrow, labels))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )
