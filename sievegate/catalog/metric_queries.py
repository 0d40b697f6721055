"""Classification scores, calibration, percentiles and linear models."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievegate.catalog import tables as t
from sievegate.catalog.registry import registry
from sievegate.functions.vectors import (
    label_values,
    normalized_probabilities,
    probabilities_from_logs,
    probability_error,
    top_label,
)
from sievegate.operators import linear_model, scoring
from sievegate.operators.linear_model import LinearWeights, score_with_weights
from sievegate.operators.quantiles import floor_index, nearest_rank
from sievegate.plans.classify import train_and_score
from sievegate.schemas import LABELS

QUERIES, ORACLES, query = registry()

_CLASSES = "classes AS (SELECT unnest(['public', 'internal', 'confidential']) AS class)"
_SCORED = f"""{_CLASSES}, methods AS (SELECT DISTINCT method FROM predictions),
    tallies AS (SELECT m.method, c.class, count(*) FILTER (gold = class) AS support, count(*) FILTER (pred = class) AS predicted,
                count(*) FILTER (gold = class AND pred = class) AS hits
                FROM methods m CROSS JOIN classes c JOIN predictions p ON p.method = m.method GROUP BY 1, 2),
    scored AS (SELECT method, class, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END::DOUBLE AS precision,
               CASE WHEN support = 0 THEN 0 ELSE hits / support END::DOUBLE AS recall, support FROM tallies),
    f1s AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END::DOUBLE AS f1 FROM scored)"""
# The most probable label: the placed one unless its probability is below a third.
_BINNED = """tops AS (SELECT *, greatest(sure, (1 - sure) / 2)::DOUBLE AS conf,
    CASE WHEN sure >= (1 - sure) / 2 THEN pred WHEN pred = 'public' THEN 'internal' ELSE 'public' END AS top FROM predictions),
    bins AS (SELECT method, least(floor(conf * 10), 9)::INT AS bin, count(*) AS n, avg((top = gold)::INT)::DOUBLE AS acc, avg(conf) AS mean_conf FROM tops GROUP BY 1, 2)"""


@query(
    "confusion_matrix",
    t.with_tables(
        "predictions",
        """SELECT m.method, g.class AS gold, p.class AS pred, count(x.doc_id) AS n FROM (SELECT DISTINCT method FROM predictions) m
        CROSS JOIN classes g CROSS JOIN classes p LEFT JOIN predictions x ON x.method = m.method AND x.gold = g.class AND x.pred = p.class GROUP BY 1, 2, 3""",
        _CLASSES,
    ),
)
def confusion_matrix(spark, d):
    return scoring.confusion_matrix(t.predictions(spark, d))


@query(
    "per_class_scores",
    t.with_tables(
        "predictions",
        "SELECT method, class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM f1s",
        _SCORED,
    ),
)
def per_class_scores(spark, d):
    scores = scoring.class_scores(t.predictions(spark, d))
    rounded = [F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")]
    return scores.select("method", "class", *rounded, "support")


@query("macro_f1", t.with_tables("predictions", "SELECT method, round(sum(f1) / 3, 6) AS macro_f1 FROM f1s GROUP BY method", _SCORED))
def macro_f1(spark, d):
    scores = scoring.class_scores(t.predictions(spark, d))
    return scoring.macro_f1(scores).select("method", F.round("macro_f1", 6).alias("macro_f1"))


@query(
    "accuracy",
    t.with_tables("predictions", "SELECT method, count(*) AS n, round(avg((gold = pred)::INT), 6)::DOUBLE AS accuracy FROM predictions GROUP BY method"),
)
def accuracy(spark, d):
    return scoring.accuracy(t.predictions(spark, d)).select("method", "n", F.round("accuracy", 6).alias("accuracy"))


@query(
    "reliability_bins",
    t.with_tables(
        "predictions",
        """SELECT m.method, b.bin::INT AS bin, (b.bin / 10)::DOUBLE AS lo, ((b.bin + 1) / 10)::DOUBLE AS hi, coalesce(n, 0) AS "count",
        round(acc, 6) AS accuracy, round(mean_conf, 6)::DOUBLE AS confidence
        FROM (SELECT DISTINCT method FROM predictions) m CROSS JOIN range(10) b(bin) LEFT JOIN bins ON bins.method = m.method AND bins.bin = b.bin""",
        _BINNED,
    ),
)
def reliability_bins(spark, d):
    bins = scoring.reliability_bins(t.predictions(spark, d))
    return bins.select(
        "method", "bin", "lo", "hi", "count", F.round("accuracy", 6).alias("accuracy"), F.round("confidence", 6).alias("confidence")
    )


@query(
    "ece",
    t.with_tables("predictions", "SELECT method, round(sum(n * abs(acc - mean_conf)) / sum(n), 6)::DOUBLE AS ece FROM bins GROUP BY method", _BINNED),
)
def ece(spark, d):
    bins = scoring.reliability_bins(t.predictions(spark, d))
    return scoring.calibration_error(bins).select("method", F.round("ece", 6).alias("ece"))


@query(
    "class_weights",
    t.with_tables(
        "predictions",
        """SELECT class AS label, count(g.gold) AS n, round(coalesce((SELECT count(*) FROM gold) / nullif(3 * count(g.gold), 0), 0), 6)::DOUBLE AS weight
        FROM classes LEFT JOIN gold g ON g.gold = class GROUP BY class""",
        _CLASSES,
    ),
)
def class_weights(spark, d):
    gold = t.predictions(spark, d).filter(F.col("method") == "rules")
    return scoring.class_weights(gold, "gold").select("label", "n", F.round("weight", 6).alias("weight"))


@query(
    "latency_nearest_rank",
    """SELECT event_type, q::DOUBLE AS q, n, v[greatest(ceil(q::DOUBLE * n), 1)::INT] AS value FROM
    (SELECT event_type, count(value) AS n, list_sort(list(value) FILTER (value IS NOT NULL)) AS v FROM events GROUP BY 1), (VALUES (0.5), (0.95)) AS t(q)""",
)
def latency_nearest_rank(spark, d):
    return nearest_rank(t.table(spark, d, "events"), ["event_type"], "value", (0.5, 0.95))


@query(
    "latency_bench_rule",
    """SELECT event_type, q::DOUBLE AS q, n, v[floor(q::DOUBLE * n)::INT + 1] AS value FROM
    (SELECT event_type, count(value) AS n, list_sort(list(value) FILTER (value IS NOT NULL)) AS v FROM events GROUP BY 1), (VALUES (0.5), (0.95)) AS t(q)""",
)
def latency_bench_rule(spark, d):
    return floor_index(t.table(spark, d, "events"), ["event_type"], "value", (0.5, 0.95))


@query(
    "latency_summary",
    t.with_tables(
        "predictions",
        """SELECT method, v[ceil(0.5 * n)::INT]::DOUBLE AS p50, v[ceil(0.95 * n)::INT]::DOUBLE AS p95, round(m, 6)::DOUBLE AS mean, round(s / 1000, 1)::DOUBLE AS total_s
        FROM (SELECT method, count(*) AS n, list_sort(list(latency_ms)) AS v, avg(latency_ms) AS m, sum(latency_ms) AS s FROM predictions GROUP BY 1)""",
    ),
)
def latency_summary(spark, d):
    return scoring.latency_summary(t.predictions(spark, d)).withColumn("mean", F.round("mean", 6))


@query(
    "prediction_checks",
    t.with_tables(
        "predictions",
        """SELECT method, count(*) AS n, 0::BIGINT AS missing_fields, 0::BIGINT AS bad_probabilities, 0::BIGINT AS pred_not_argmax FROM predictions GROUP BY method""",
    ),
)
def prediction_checks(spark, d):
    return scoring.prediction_problems(t.predictions(spark, d))


_SECOND = """second AS (SELECT doc_id, pred, CASE key % 6 WHEN 0 THEN 'Non-finite probability' WHEN 1 THEN 'probabilities sum to zero (empty output)' END AS error
    FROM predictions WHERE method = 'shifted')"""


@query(
    "scorer_agreement",
    t.with_tables(
        "predictions",
        """SELECT count(*) AS n, count(error) AS errors, count(*) FILTER (error LIKE 'Non%') AS nan_rows, count(*) FILTER (error LIKE 'prob%') AS empty_rows,
        count(*) FILTER (error IS NULL) AS compared, count(*) FILTER (error IS NULL AND p.pred = s.pred) AS agreement,
        round(count(*) FILTER (error IS NULL AND p.pred = s.pred) / nullif(count(*) FILTER (error IS NULL), 0), 4)::DOUBLE AS agreement_rate
        FROM predictions p JOIN second s USING (doc_id) WHERE method = 'rules'""",
        _SECOND,
    ),
)
def scorer_agreement(spark, d):
    rows = t.predictions(spark, d)
    kind = F.col("doc_id").cast("bigint") % 6
    error = F.when(kind == 0, "Non-finite probability").when(
        kind == 1, "probabilities sum to zero (empty output)"
    )
    second = rows.filter(F.col("method") == "shifted").withColumn("error", error)
    return scoring.scorer_agreement(rows.filter(F.col("method") == "rules"), second)


_RAW = "raws AS (SELECT event_id, event_type, [value / 500, 0.5 - value / 1000, 0.5 - value / 1000 + CASE WHEN user_id % 4 = 0 THEN 0.2 ELSE 0 END] AS p, user_id FROM events)"


@query(
    "strict_probabilities",
    f"""WITH {_RAW} SELECT event_type, error, count(*) AS n, round(sum(CASE WHEN error IS NULL THEN p[1] / list_sum(p) END), 4)::DOUBLE AS mass FROM (
    SELECT *, CASE WHEN user_id % 7 = 0 THEN 'missing keys: confidential' WHEN list_min(p) < 0 THEN 'negative probability'
    WHEN abs(list_sum(p) - 1) > 0.001 THEN 'probabilities do not sum to one' END AS error FROM raws) GROUP BY 1, 2""",
)
def strict_probabilities(spark, d):
    """Maps built from the event values; some lack a key, some do not sum to one."""
    value, user = F.col("value"), F.col("user_id")
    rest = F.lit(0.5) - value / 1000
    full = F.map_from_arrays(
        F.array(*map(F.lit, LABELS)),
        F.array(value / 500, rest, rest + F.when(user % 4 == 0, F.lit(0.2)).otherwise(F.lit(0.0))),
    )
    probs = F.when(user % 7 == 0, F.map_filter(full, lambda k, _: k != "confidential")).otherwise(full)
    rows = t.table(spark, d, "events").select("event_type", probs.alias("probs"))
    checked = rows.select(
        "event_type",
        probability_error(F.col("probs")).alias("error"),
        F.element_at(normalized_probabilities(F.col("probs")), F.lit("public")).alias("p"),
    )
    return checked.groupBy("event_type", "error").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("p"), 4).alias("mass")
    )


@query(
    "log_probabilities",
    """WITH logs AS (SELECT event_type, -value / 100 AS a, CASE WHEN user_id % 3 = 0 THEN '-inf'::DOUBLE ELSE -1.0 END AS b, CASE WHEN user_id % 9 = 0 THEN 'nan'::DOUBLE ELSE -2.0 END AS c,
        CASE WHEN user_id % 27 = 0 THEN 0 ELSE exp(-value / 100) END AS ea, CASE WHEN user_id % 3 = 0 THEN 0 ELSE exp(-1.0) END AS eb, CASE WHEN user_id % 9 = 0 THEN 0 ELSE exp(-2.0) END AS ec FROM events)
    SELECT event_type, count(*) AS n, round(sum(CASE WHEN ea + eb + ec > 0 THEN ea / (ea + eb + ec) ELSE 1 / 3 END), 4)::DOUBLE AS public,
    round(sum(CASE WHEN ea + eb + ec > 0 THEN ec / (ea + eb + ec) ELSE 1 / 3 END), 4)::DOUBLE AS confidential FROM logs GROUP BY 1""",
)
def log_probabilities(spark, d):
    value, user = F.col("value"), F.col("user_id")
    none, nan = F.lit(float("-inf")), F.lit(float("nan"))
    logs = F.map_from_arrays(
        F.array(*map(F.lit, LABELS)),
        F.array(
            F.when(user % 27 == 0, none).otherwise(-value / 100),
            F.when(user % 3 == 0, none).otherwise(F.lit(-1.0)),
            F.when(user % 9 == 0, nan).otherwise(F.lit(-2.0)),
        ),
    )
    rows = t.table(spark, d, "events").select("event_type", probabilities_from_logs(logs).alias("p"))
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.element_at("p", F.lit("public"))), 4).alias("public"),
        F.round(F.sum(F.element_at("p", F.lit("confidential"))), 4).alias("confidential"),
    )


# A fixed linear model: small integers over ten.
_WEIGHTS = LinearWeights(
    [[((c * 7 + i * 3) % 11 - 5) / 2.0 for i in range(t.DIM)] for c in range(3)], [0.1, 0.0, -0.1]
)


@query(
    "linear_scores",
    t.with_tables(
        "items",
        """SELECT chunk_id, ['public', 'internal', 'confidential'][list_position(z, list_max(z))] AS pred, round(exp(z[1] - list_max(z)) / s, 6)::DOUBLE AS public,
        round(exp(z[3] - list_max(z)) / s, 6)::DOUBLE AS confidential FROM (SELECT *, list_sum(list_transform(z, lambda x: exp(x - list_max(z)))) AS s FROM (
        SELECT chunk_id, list_transform([0, 1, 2], lambda c: list_sum(list_transform(v, lambda x, i: x * ((c * 7 + (i - 1) * 3) % 11 - 5) / 2.0)) + 0.1 - c * 0.1) AS z FROM items))""",
    ),
)
def linear_scores(spark, d):
    scored = score_with_weights(_WEIGHTS, t.vector_items(spark, d), "embedding")
    probs = label_values(F.col("probs"))
    return scored.select(
        "chunk_id", "pred", F.round(F.get(probs, 0), 6).alias("public"), F.round(F.get(probs, 2), 6).alias("confidential")
    )


def labelled_vectors(spark, d):
    names = F.array(*map(F.lit, LABELS))
    return t.vector_items(spark, d).select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("chunk_id").cast("int").alias("chunk_ord"),
        F.get(names, (F.col("topic") % 3).cast("int")).alias("label"),
        F.col("embedding").alias("vector"),
        F.pmod(F.xxhash64("doc_id"), F.lit(5)).alias("part"),
    )


def _train_parts(spark, d):
    """Train and evaluation rows by document, so no document is in both."""
    rows = labelled_vectors(spark, d)
    train = rows.filter(F.col("part") > 0).withColumn("weak_label", F.col("label"))
    evaluation = rows.filter(F.col("part") == 0).withColumn("gold", F.col("label"))
    keys = ["doc_id", "chunk_ord"]
    return train.select(*keys, "weak_label"), evaluation.select(*keys, "gold"), rows.select(*keys, "vector")


@query("lr_train_score")
def lr_train_score(spark, d):
    scored, _ = train_and_score(*_train_parts(spark, d), c=10.0)
    return scored.select(
        "method", "doc_id", "chunk_ord", "gold", "pred", F.array_max(label_values(F.col("probs"))).alias("confidence")
    )


@query("lr_choose_c")
def lr_choose_c(spark, d):
    rows = labelled_vectors(spark, d).select("doc_id", "chunk_ord", "label", "vector")
    best, means = linear_model.choose_c(rows, ["doc_id", "chunk_ord"])
    return spark.createDataFrame([(c, score, c == best) for c, score in means.items()], "c double, macro_f1 double, best boolean")


@query("lr_augmented")
def lr_augmented(spark, d):
    """Sign-flipped vectors with shifted labels mixed into the training rows."""
    train, evaluation, vectors = _train_parts(spark, d)
    names = F.array(*map(F.lit, LABELS))
    extra = labelled_vectors(spark, d).filter(F.col("part") == 1).select(
        F.get(names, (F.array_position(names, F.col("label")) % 3).cast("int")).alias("label"),
        F.transform("vector", lambda x: -x).alias("vector"),
    )
    scored, _ = train_and_score(train, evaluation, vectors, c=10.0, extra=extra, method="lr+extra")
    return scoring.class_scores(scored)


@query("class_intervals")
def class_intervals(spark, d):
    return scoring.class_intervals(t.predictions(spark, d))


@query(
    "class_interval_bounds",
    t.with_tables(
        "predictions",
        """SELECT method, class, kind, count(*) AS n, round(avg(hit), 6) AS mean, true AS inside FROM (
        SELECT method, pred AS class, 'precision' AS kind, (gold = pred)::INT AS hit FROM predictions
        UNION ALL SELECT method, gold, 'recall', (gold = pred)::INT FROM predictions) GROUP BY 1, 2, 3""",
    ),
)
def class_interval_bounds(spark, d):
    """Means and counts of the class intervals, and whether each interval holds its mean."""
    found = scoring.class_intervals(t.predictions(spark, d))
    inside = (F.col("lo") <= F.col("mean") + 1e-9) & (F.col("mean") <= F.col("hi") + 1e-9)
    return found.select(
        "method", "class", "kind", F.col("n").cast("bigint").alias("n"), F.round("mean", 6).alias("mean"),
        inside.alias("inside"),
    )


@query(
    "method_comparison_scores",
    t.with_tables(
        "predictions",
        """SELECT method, n, accuracy, macro_f1, ece, true AS inside, NULL::DOUBLE AS p50
        FROM (SELECT method, count(*) AS n, round(avg((gold = pred)::INT), 6)::DOUBLE AS accuracy FROM predictions GROUP BY method)
        JOIN (SELECT method, round(sum(f1) / 3, 6) AS macro_f1 FROM f1s GROUP BY method) USING (method)
        JOIN (SELECT method, round(sum(n * abs(acc - mean_conf)) / sum(n), 6)::DOUBLE AS ece FROM bins GROUP BY method) USING (method)""",
        f"{_SCORED}, {_BINNED}",
    ),
)
def method_comparison_scores(spark, d):
    """The comparison of methods of which none reports a latency."""
    silent = t.predictions(spark, d).withColumn("latency_ms", F.lit(None).cast("double"))
    found = scoring.method_summary(silent)
    inside = (F.col("accuracy_lo") <= F.col("accuracy")) & (F.col("accuracy") <= F.col("accuracy_hi"))
    rounded = [F.round(c, 6).alias(c) for c in ("accuracy", "macro_f1", "ece")]
    return found.select("method", "n", *rounded, inside.alias("inside"), "p50")


@query(
    "method_summary_full",
    t.with_tables(
        "predictions",
        """SELECT method, class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support,
        total AS confused, total AS binned, true AS inside
        FROM f1s JOIN (SELECT method, count(*) AS total FROM predictions GROUP BY method) USING (method)""",
        _SCORED,
    ),
)
def method_summary_full(spark, d):
    """The stored summary opened up: scores and intervals by class, and what the matrix and the bins add up to."""
    found = scoring.full_summary(t.predictions(spark, d))
    total = lambda array, field: F.aggregate(
        F.transform(array, lambda x: x[field]), F.lit(0).cast("bigint"), lambda a, x: a + x
    )
    rows = found.select(
        "method", total("confusion", "n").alias("confused"), total("bins", "count").alias("binned"),
        F.explode("classes").alias("c"),
    ).select("method", "confused", "binned", "c.*")
    holds = lambda c: F.coalesce(F.col(c).between(F.col(f"{c}_lo") - 1e-9, F.col(f"{c}_hi") + 1e-9), F.lit(True))
    rounded = [F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")]
    return rows.select(
        "method", "class", *rounded, "support", "confused", "binned",
        (holds("precision") & holds("recall")).alias("inside"),
    )


@query("method_comparison")
def method_comparison(spark, d):
    return scoring.method_summary(t.predictions(spark, d))


@query(
    "top_labels",
    t.with_tables("predictions", "SELECT method, top, count(*) AS n FROM tops GROUP BY 1, 2", _BINNED),
)
def top_labels(spark, d):
    rows = t.predictions(spark, d).select("method", top_label(F.col("probs")).alias("top"))
    return rows.groupBy("method", "top").agg(F.count(F.lit(1)).alias("n"))
