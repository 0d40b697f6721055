import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievegate.functions import vectors as v
from sievegate.operators import scoring
from sievegate.operators.bootstrap import bootstrap_mean
from sievegate.operators.quantiles import floor_index, nearest_rank
from sievegate.operators.ranking import number_rows, top_k_per_group
from sievegate.operators.ranking_metrics import mean_scores, query_scores

PUB, INT, CON = "public", "internal", "confidential"


def test_retrieval_cases(spark):
    cases = [
        ("ab", "b", 1.0, 0.5, None), ("ab", "c", 0.0, 0.0, 0.0), ("ab", "", 0.0, 0.0, 0.0), ("abc", "a", 1.0, 1.0, 1.0),
        ("abc", "c", 1.0, 1 / 3, None), ("ab", "ab", 1.0, 1.0, 1.0), ("xa", "a", 1.0, 0.5, 1 / math.log2(3)), ("", "", 0.0, 0.0, 0.0),
        ("", "a", 0.0, 0.0, 0.0),
    ]
    hits = [(str(i), rank, doc in c[1]) for i, c in enumerate(cases) for rank, doc in enumerate(c[0], 1)]
    queries = [(str(i), len(c[1])) for i, c in enumerate(cases)]
    scores = query_scores(
        spark.createDataFrame(hits, "qid string, rank int, relevant boolean"),
        spark.createDataFrame(queries, "qid string, n_relevant int"),
    )
    got = {int(r.qid): r for r in scores.collect()}
    for i, (_, _, recall, mrr, ndcg) in enumerate(cases):
        assert got[i].recall == pytest.approx(recall) and got[i].mrr == pytest.approx(mrr), cases[i]
        assert ndcg is None or got[i].ndcg == pytest.approx(ndcg), cases[i]
    assert mean_scores(scores).first().queries == len(cases)


def test_bootstrap(spark):
    rows = [("a", float(i % 2)) for i in range(100)] + [("b", 0.25)] * 7
    frame = spark.createDataFrame(rows, "g string, x double")
    first = {r.g: r for r in bootstrap_mean(frame, ["g"], "x", 400).collect()}
    again = {r.g: r for r in bootstrap_mean(frame.repartition(5), ["g"], "x", 400).collect()}
    assert first == again
    a = first["a"]
    assert a.lo < 0.5 < a.hi and a.mean == 0.5 and a.n == 100
    spread = 1.96 * 0.5 / 10
    assert a.lo == pytest.approx(0.5 - spread, abs=0.03) and a.hi == pytest.approx(0.5 + spread, abs=0.03)
    assert first["b"].lo == first["b"].hi == pytest.approx(0.25)
    whole = bootstrap_mean(frame, [], "x", 100).collect()
    assert len(whole) == 1 and whole[0].n == 107


def test_quantile_rules_match_sorting(spark):
    rng = random.Random(1)
    groups = {
        "ties": [5.0] * 300 + [rng.random() for _ in range(100)],
        "wide": [rng.gauss(0, 1000) for _ in range(2000)],
        "one": [3.0],
        "pair": [1.0, 2.0],
    }
    frame = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs] + [("one", None)], "g string, x double")
    qs = (0.0, 0.25, 0.5, 0.95, 1.0)
    near = {(r.g, r.q): r.value for r in nearest_rank(frame, ["g"], "x", qs).collect()}
    floor = {(r.g, r.q): r.value for r in floor_index(frame, ["g"], "x", qs).collect()}
    for g, xs in groups.items():
        s, n = sorted(xs), len(xs)
        for q in qs:
            assert near[g, q] == s[max(math.ceil(q * n), 1) - 1], (g, q)
            assert floor[g, q] == s[min(int(q * n), n - 1)], (g, q)


def rows_of(spark):
    gold, pred = [PUB, PUB, INT, CON], [PUB, INT, INT, CON]
    rows = [("m", str(i), 0, g, p, {c: 0.8 if c == p else 0.1 for c in (PUB, INT, CON)}, float(i + 1)) for i, (g, p) in enumerate(zip(gold, pred))]
    shape = "method string, doc_id string, chunk_ord int, gold string, pred string, probs map<string,double>, latency_ms double"
    return spark.createDataFrame(rows, shape)


def test_class_scores(spark):
    rows = rows_of(spark)
    got = {r["class"]: r for r in scoring.class_scores(rows).collect()}
    assert (got[PUB].precision, got[PUB].recall, got[PUB].f1) == (1.0, 0.5, pytest.approx(2 / 3))
    assert (got[INT].precision, got[INT].recall, got[INT].f1) == (0.5, 1.0, pytest.approx(2 / 3))
    assert got[CON].f1 == 1.0 and got[CON].support == 1
    assert scoring.macro_f1(scoring.class_scores(rows)).first().macro_f1 == pytest.approx(7 / 9)
    assert scoring.accuracy(rows).first().accuracy == 0.75
    cells = {(r.gold, r.pred): r.n for r in scoring.confusion_matrix(rows).collect()}
    assert len(cells) == 9 and cells[PUB, INT] == 1 and cells[CON, PUB] == 0
    with pytest.raises(Exception, match="unknown pred label"):
        scoring.class_scores(rows.withColumn("pred", F.lit("other"))).collect()


@pytest.mark.parametrize(
    ("matrix", "expected"), [([[50, 7, 7], [31, 53, 35], [0, 2, 15]], 0.560)]
)
def test_published_confusion_matrix(spark, matrix, expected):
    names = (PUB, INT, CON)
    rows = [("m", names[g], names[p]) for g in range(3) for p in range(3) for _ in range(matrix[g][p])]
    frame = spark.createDataFrame(rows, "method string, gold string, pred string")
    assert scoring.macro_f1(scoring.class_scores(frame)).first().macro_f1 == pytest.approx(expected, abs=5e-4)


def test_calibration(spark):
    def ece(right, confidence):
        gold = PUB if right else INT
        probs = {PUB: confidence, INT: (1 - confidence) / 2, CON: (1 - confidence) / 2}
        frame = spark.createDataFrame([("m", gold, probs)] * 5, "method string, gold string, probs map<string,double>")
        bins = scoring.reliability_bins(frame)
        assert bins.count() == 10 and bins.filter("count = 0 and accuracy is null").count() == 9
        return scoring.calibration_error(bins).first().ece

    assert ece(True, 1.0) == 0.0
    assert ece(True, 0.6) == pytest.approx(0.4)
    assert ece(False, 0.9) > 0.5
    with pytest.raises(Exception, match="outside"):
        ece(True, 1.2)
    with pytest.raises(ValueError):
        scoring.reliability_bins(rows_of(spark), n_bins=0)


def test_summary_and_checks(spark):
    rows = rows_of(spark)
    summary = scoring.method_summary(rows).first()
    assert (summary.n, summary.p50, summary.p95, summary["mean"]) == (4, 2.0, 4.0, 2.5)
    assert summary.accuracy_lo <= 0.75 <= summary.accuracy_hi
    broken = rows.withColumn("probs", F.map_from_arrays(F.array(F.lit(PUB)), F.array(F.lit(0.4))))
    checked = scoring.prediction_problems(rows.unionByName(broken)).first()
    assert (checked.n, checked.bad_probabilities, checked.missing_fields) == (8, 4, 0)
    weights = {r.label: r.weight for r in scoring.class_weights(rows.filter(F.col("gold") != CON), "gold").collect()}
    assert weights == {PUB: 0.5, INT: 1.0, CON: 0.0}
    intervals = {(r["class"], r.kind): r for r in scoring.class_intervals(rows, resamples=200).collect()}
    assert intervals[CON, "precision"].lo == intervals[CON, "precision"].hi == 1.0


def test_scorer_agreement_without_comparisons(spark):
    rows = rows_of(spark)
    failed = rows.withColumn("error", F.lit("Non-finite value"))
    got = scoring.scorer_agreement(rows, failed).first()
    assert (got.n, got.errors, got.nan_rows, got.compared, got.agreement_rate) == (4, 4, 4, 0, None)


def test_probability_rules(spark):
    def check(probs):
        frame = spark.createDataFrame([(probs,)], "p map<string,double>")
        row = frame.select(v.probability_error(F.col("p")).alias("e"), v.normalized_probabilities(F.col("p")).alias("n")).first()
        return row.e, row.n

    assert check({PUB: 0.5, INT: 0.25, CON: 0.25}) == (None, {PUB: 0.5, INT: 0.25, CON: 0.25})
    error, scaled = check({PUB: 0.5004, INT: 0.25, CON: 0.25})
    assert error is None and sum(scaled.values()) == pytest.approx(1.0)
    assert check({PUB: 1.0})[0] == "missing keys: internal, confidential"
    assert check({PUB: float("nan"), INT: 0.5, CON: 0.5})[0] == "non-finite probability"
    assert check({PUB: -0.1, INT: 0.6, CON: 0.5})[0] == "negative probability"
    assert check({PUB: 0.0, INT: 0.0, CON: 0.0})[0] == "probabilities sum to zero"
    assert check({PUB: 0.9, INT: 0.9, CON: 0.0})[0] == "probabilities do not sum to one"
    logs = spark.createDataFrame([({PUB: float("-inf"), INT: float("nan"), CON: float("-inf")},)], "p map<string,double>")
    assert set(logs.select(v.probabilities_from_logs(F.col("p")).alias("o")).first().o.values()) == {1 / 3}


def test_top_k_beyond_the_planner_limit(spark):
    frame = spark.range(5000).select(F.floor(F.col("id") / 100000).alias("g"), F.col("id"))
    got = top_k_per_group(frame, ["g"], [F.col("id")], 1500)
    assert [r.id for r in got.orderBy("rank").collect()] == list(range(1500))
    plan = top_k_per_group(frame, ["g"], [F.col("id")], 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_number_rows_is_global(spark):
    frame = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("h"), (F.col("id") % 2).alias("p"))
    numbered = number_rows(frame, [F.col("h")], F.substring("h", 1, 2)).collect()
    assert [r.row_index for r in sorted(numbered, key=lambda r: r.h)] == list(range(1000))
    parts = number_rows(frame, [F.col("h")], F.substring("h", 1, 1), ["p"]).filter("p = 1").collect()
    assert [r.row_index for r in sorted(parts, key=lambda r: r.h)] == list(range(500))


def test_weights_follow_the_poisson_distribution():
    from sievegate.operators.bootstrap import weights_of

    counts = np.array([1, 3, 32, 33, 1000] * 40)
    weights = weights_of(counts, np.arange(len(counts)) * 7919, 500)
    for n in (1, 3, 32, 33, 1000):
        drawn = weights[counts == n].ravel()
        assert abs(drawn.mean() - n) < 5 * (n / len(drawn)) ** 0.5 and abs(drawn.var() / n - 1) < 0.06
    ones = weights[counts == 1].ravel()
    assert abs((ones == 0).mean() - np.exp(-1)) < 0.01 and abs((ones == 2).mean() - np.exp(-1) / 2) < 0.01


def test_a_hundred_thousand_different_values(spark):
    frame = spark.range(100_000).selectExpr("id / 100000.0D AS x")
    started = time.monotonic()
    (row,) = bootstrap_mean(frame, [], "x").collect()
    assert time.monotonic() - started < 30
    half = 1.96 * (1 / 12 / 100_000) ** 0.5
    assert row.n == 100_000 and abs(row.lo - (0.5 - half)) < 0.2 * half and abs(row.hi - (0.5 + half)) < 0.2 * half
