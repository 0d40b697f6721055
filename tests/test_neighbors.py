import numpy as np
import pytest
from pyspark.sql import functions as F

from sievegate.functions import vectors as v
from sievegate.operators import approximate, neighbors
from sievegate.operators.approximate import approximate_items, recall_against
from sievegate.operators.encode import as_variant, encoder_column, hashed_vectors, split_malformed
from sievegate.operators.neighbors import document_ranking, nearest_items

DIM = 8


def cloud(spark, n, seed, names, copies=0):
    """Random vectors; the last ``copies`` rows repeat the first vector."""
    rng = np.random.default_rng(seed)
    matrix = rng.standard_normal((n, DIM)).astype(np.float32)
    if copies:
        matrix[-copies:] = matrix[0]
    rows = [(f"i{i:04d}", i % 3, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return matrix, spark.createDataFrame(rows, f"{names[0]} string, part int, {names[1]} array<float>")


def brute(queries, items, k, keep=None):
    q = queries.astype(float) / np.linalg.norm(queries.astype(float), axis=1, keepdims=True)
    m = items.astype(float) / np.linalg.norm(items.astype(float), axis=1, keepdims=True)
    units = np.rint((1 - q @ m.T) * 1e9).astype(int)
    out = {}
    for row in range(len(q)):
        order = sorted((units[row, j], f"i{j:04d}") for j in range(len(m)) if keep is None or keep(j))
        out[f"i{row:04d}"] = [name for _, name in order[:k]]
    return out


def ranked(hits, *extra):
    out = {}
    for r in hits.orderBy("qid", *extra, "rank").collect():
        out.setdefault((r.qid, *[r[e] for e in extra]) if extra else r.qid, []).append(r.chunk_id)
    return out


@pytest.mark.parametrize("ways", [{}, {"broadcast_bytes": 0, "tile_queries": 7, "tile_items": 50}])
def test_exact_join_with_ties_spread_over_partitions(spark, ways):
    """A third of the items are copies of one vector; ids decide among them."""
    q, queries = cloud(spark, 20, 1, ("qid", "vector"))
    m, items = cloud(spark, 300, 1, ("chunk_id", "embedding"), copies=100)
    got = nearest_items(queries, items.repartition(7), 12, DIM, **ways)
    assert ranked(got) == brute(q, m, 12)


@pytest.mark.parametrize("ways", [{}, {"broadcast_bytes": 0, "tile_queries": 7, "tile_items": 50}])
def test_exact_join_per_group(spark, ways):
    q, queries = cloud(spark, 10, 2, ("qid", "vector"))
    m, items = cloud(spark, 90, 3, ("chunk_id", "embedding"))
    got = ranked(nearest_items(queries, items.repartition(5), 4, DIM, group="part", **ways), "part")
    for part in range(3):
        expected = brute(q, m, 4, lambda j, p=part: j % 3 == p)
        assert {key[0]: names for key, names in got.items() if key[1] == part} == expected


def test_blocks_and_shares_send_little_and_make_enough_tasks():
    """Rows of about 1 GB of documents: 40 blocks sent every wide item 40 times."""
    blocks, shares = neighbors._cuts(80_600, 1_790_000, 256, 50, 48)
    assert blocks <= 8 and blocks * shares >= 48
    blocks, shares = neighbors._cuts(615_000, 615_000, 64, 50, 48)
    assert shares == 1 and 615_000 / blocks <= neighbors._BLOCK_QUERIES
    for n, m, dim, k, tasks in [(1, 1, 8, 3, 16), (0, 0, 8, 3, 16), (9_000, 50, 64, 10, 48), (10**6, 10**7, 256, 150, 48)]:
        blocks, shares = neighbors._cuts(n, m, dim, k, tasks)
        assert n / blocks * dim * 8 <= neighbors._BLOCK_BYTES and m / shares <= neighbors._SHARE_ITEMS


@pytest.mark.parametrize("group", [None, "part"])
def test_exact_join_of_blocks_and_shares(spark, monkeypatch, group):
    monkeypatch.setattr(neighbors, "_LEAST_BLOCK", 10)
    monkeypatch.setattr(neighbors, "_LEAST_SHARE", 60)
    monkeypatch.setattr(neighbors, "_WINNER_BYTES", 1)
    assert min(neighbors._cuts(40, 300, DIM, 6, 16)) > 1
    q, queries = cloud(spark, 40, 21, ("qid", "vector"))
    m, items = cloud(spark, 300, 22, ("chunk_id", "embedding"), copies=50)
    got = nearest_items(queries, items.repartition(5), 6, DIM, group=group, broadcast_bytes=0)
    if group is None:
        assert ranked(got) == brute(q, m, 6)
        return
    found = ranked(got, "part")
    for part in range(3):
        mine = {key[0]: names for key, names in found.items() if key[1] == part}
        assert mine == brute(q, m, 6, lambda j, p=part: j % 3 == p)


def shuffled(frame):
    """Bytes that the exchanges of a finished frame have written."""
    rows = frame.collect()
    total, todo = 0, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleBytesWritten").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total, rows


def test_items_are_sent_once_for_all_blocks(spark, monkeypatch):
    """With a copy of the items for every block, what is stored grew with queries times items."""
    q, queries = cloud(spark, 40, 31, ("qid", "vector"))
    m, items = cloud(spark, 3_000, 32, ("chunk_id", "embedding"))
    sent = {}
    for least in (20, 3):
        monkeypatch.setattr(neighbors, "_LEAST_BLOCK", least)
        assert neighbors._cuts(40, 3_000, DIM, 2, 16)[0] == 40 // least
        hits = nearest_items(queries, items.repartition(5), 2, DIM, broadcast_bytes=0)
        sent[least], rows = shuffled(hits)
        assert ranked(spark.createDataFrame(rows)) == brute(q, m, 2)
    assert sent[3] < 1.5 * sent[20]


def test_blocks_that_read_stored_items_need_few_shares():
    """Rows of about 1 and 6 GB of documents: k winners of a query are sent for every share."""
    assert neighbors._stream_cuts(80_600, 1_790_000, 256, 50, 48) == (40, 1)
    assert neighbors._stream_cuts(484_000, 10_700_000, 256, 50, 48) == (60, 1)
    assert neighbors._stream_cuts(5_000, 1_790_000, 256, 50, 48) == (2, 17)
    blocks, _ = neighbors._stream_cuts(10**7, 10**6, 256, 150, 48)
    assert 10**7 / blocks * 256 * 8 <= neighbors._BLOCK_BYTES


def test_a_task_hands_on_k_rows_per_query_once(spark, monkeypatch):
    from sievegate.operators import neighbors

    monkeypatch.setattr(neighbors, "_MATRIX_CELLS", 20)
    q, _ = cloud(spark, 6, 4, ("qid", "vector"))
    best = neighbors._Nearest(*neighbors._unit_queries(np.array([f"i{i:04d}" for i in range(6)], dtype=object), q.astype(float)), 5)
    import pandas as pd

    m, _ = cloud(spark, 40, 5, ("chunk_id", "embedding"))
    for start in range(0, 40, 8):
        names = pd.DataFrame({"chunk_id": [f"i{j:04d}" for j in range(start, start + 8)]})
        best.add(m[start : start + 8].astype(float), names, "chunk_id")
        assert len(best.payload) <= 6 * 5
    merged = pd.concat(best.winners()).sort_values(["_query", "_units", "chunk_id"])
    assert len(merged) == 6 * 5
    got = {key: list(part["chunk_id"]) for key, part in merged.groupby("_query")}
    assert got == brute(q, m, 5)


def test_missing_and_malformed_vectors(spark):
    _, queries = cloud(spark, 3, 6, ("qid", "vector"))
    rows = [("a", [1.0] * DIM), ("b", None), ("c", [0.0] * DIM)]
    items = spark.createDataFrame(rows, "chunk_id string, embedding array<float>")
    assert {r.chunk_id for r in nearest_items(queries, items, 5, DIM).collect()} == {"a"}
    for bad in ([1.0] * (DIM - 1), [float("nan")] * DIM):
        broken = spark.createDataFrame([("x", bad)], "chunk_id string, embedding array<float>")
        with pytest.raises(Exception, match="wide|non-finite"):
            nearest_items(queries, broken, 5, DIM).collect()
        asking = spark.createDataFrame([("ok", [1.0] * DIM), ("x", bad)], "qid string, vector array<float>")
        for limit in (1 << 20, 1):  # broadcast and tiles
            with pytest.raises(Exception, match="wide|non-finite"):
                nearest_items(asking, items, 5, DIM, broadcast_bytes=limit).collect()


def test_ranking_ignores_positive_scale(spark):
    _, queries = cloud(spark, 10, 7, ("qid", "vector"))
    _, items = cloud(spark, 80, 8, ("chunk_id", "embedding"))
    scaled = items.withColumn("embedding", F.transform("embedding", lambda x: x * 4.0).cast("array<float>"))
    assert ranked(nearest_items(queries, items, 5, DIM)) == ranked(nearest_items(queries, scaled, 5, DIM))


def test_document_ranking_keeps_first_occurrence(spark):
    rows = [("q", "d1", 1), ("q", "d2", 2), ("q", "d1", 3), ("q", "d3", 4), ("q", "d4", 60)]
    hits = spark.createDataFrame(rows, "qid string, doc_id string, rank int")
    got = document_ranking(hits, depth=50, k=2).orderBy("rank").collect()
    assert [(r.doc_id, r["rank"]) for r in got] == [("d1", 1), ("d2", 2)]


def test_certified_search_is_exact(spark):
    """Copies of one vector fill a third of the items: their cell is cut into tiles."""
    q, queries = cloud(spark, 30, 9, ("qid", "vector"))
    m, items = cloud(spark, 300, 9, ("chunk_id", "embedding"), copies=100)
    found = approximate_items(queries, items, 5, DIM, miss=0, tile_queries=10, tile_items=40)
    assert ranked(found) == brute(q, m, 5) and all(r.certified for r in found.collect())


def test_fewer_items_than_wanted_and_odd_vectors(spark):
    q, queries = cloud(spark, 5, 10, ("qid", "vector"))
    m, items = cloud(spark, 12, 11, ("chunk_id", "embedding"))
    odd = spark.createDataFrame([("none", 0, None), ("zero", 0, [0.0] * DIM)], items.schema)
    asked = queries.unionByName(spark.createDataFrame([("none", 0, None), ("zero", 0, [0.0] * DIM)], queries.schema))
    found = approximate_items(asked, items.unionByName(odd), 20, DIM)
    assert ranked(found) == brute(q, m, 20)
    assert approximate_items(asked, items.limit(0), 3, DIM).count() == 0
    assert approximate_items(asked.limit(0), items, 3, DIM).count() == 0
    with pytest.raises(Exception, match="non-finite"):
        bad = spark.createDataFrame([("bad", 0, [float("nan")] * DIM)], items.schema)
        approximate_items(queries, items.unionByName(bad), 3, DIM).count()


def test_cells_are_searched_without_a_vector_for_each_query_and_cell(spark):
    """What is shuffled grows with queries and items: probes are bare cells, blocks and shares few at any size."""
    q, queries = cloud(spark, 60, 15, ("qid", "vector"))
    m, items = cloud(spark, 200, 16, ("chunk_id", "embedding"))
    index = approximate.build_index(items, DIM, cells=9)
    state = queries.select(F.col("qid").alias("_query"), F.col("vector").alias("_vector"), F.lit(0).alias("_seen"),
                           F.lit(None).cast("double").alias("_reach"), F.lit(9).alias("_next"))
    probes = approximate._probes(state, index.cells)
    assert probes.columns == ["_cell"] and probes.count() == 60 * int((index.cells.sizes > 0).sum())
    sizes = [approximate._grid(n, 64, 48, approximate.TILE_QUERIES) for n in (10_000, 100_000, 600_000)]
    assert all(blocks + shares <= 16 and blocks * shares >= 48 for blocks, shares in sizes)
    found = approximate.search_index(queries, index, 7, miss=0, tile_queries=11, tile_items=6)
    assert ranked(found) == brute(q, m, 7)


def clustered(spark, n, seed, names):
    rng = np.random.default_rng(seed)
    middles = np.random.default_rng(1).standard_normal((40, DIM))
    matrix = middles[rng.integers(0, 40, n)] + 0.1 * rng.standard_normal((n, DIM))
    rows = [(f"i{i:05d}", [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{names[0]} string, {names[1]} array<float>")


def test_pairs_compared_grow_less_than_the_square(spark, monkeypatch):
    """Four times the queries and items: less than sixteen times the pairs, and nine of ten found."""
    compared = []
    look = approximate._look

    def counting(probes, index, *rest):
        per_cell = probes.groupBy("_cell").count().collect()
        compared[-1] += sum(r["count"] * int(index.cells.sizes[r["_cell"]]) for r in per_cell)
        return look(probes, index, *rest)

    monkeypatch.setattr(approximate, "_look", counting)
    for n in (500, 2_000):
        queries, items = clustered(spark, n, 2, ("qid", "vector")), clustered(spark, n, 3, ("chunk_id", "embedding"))
        compared.append(0)
        found = approximate_items(queries, items, 5, DIM, least=2, share=0.02)
        recall = recall_against(found, nearest_items(queries, items, 5, DIM)).agg(F.avg("recall")).first()[0]
        assert recall > 0.9 and compared[-1] < 0.25 * n * n
    assert compared[1] < 10 * compared[0]


def test_two_hundred_groups_hold_one_state_at_a_time(spark, monkeypatch):
    q, queries = cloud(spark, 20, 5, ("qid", "vector"))
    m, items = cloud(spark, 600, 6, ("chunk_id", "embedding"))
    grouped = items.withColumn("g", F.expr("cast(substring(chunk_id, 2) as int) % 200")).repartition(2)
    for settings in ({}, {"broadcast_bytes": 0, "tile_queries": 7, "tile_items": 250}):
        hits = nearest_items(queries, grouped, 2, DIM, group="g", **settings)
        got = ranked(hits, "g")
        assert len(got) == 20 * 200
        for g in (0, 77, 199):
            want = brute(q, m, 2, keep=lambda j: j % 200 == g)  # noqa: B023
            assert all(got[qid, g] == names for qid, names in want.items())


def values(spark, vector, expression):
    frame = spark.createDataFrame([(vector,)], "v array<float>")
    return frame.select(expression(F.col("v")).alias("o")).first().o


def test_vector_functions(spark):
    assert values(spark, [3.0, 4.0], v.renormalize) == pytest.approx([0.6, 0.8])
    assert values(spark, None, v.renormalize) is None
    with pytest.raises(Exception, match="zero-norm"):
        values(spark, [0.0, 0.0], v.renormalize)
    assert values(spark, [1.0, 2.0, 3.0], lambda c: v.truncate(c, 2)) == [1.0, 2.0]
    assert values(spark, [0.1, 65519.0], v.half_precision) == [float(np.float16(0.1)), 65504.0]
    assert values(spark, [0.0, 0.0], lambda c: v.cosine_distance(c, c)) is None
    assert values(spark, [1.0, 2.0], v.softmax) == pytest.approx([1 / (1 + np.e), np.e / (1 + np.e)])
    for bad in ([1.0], [float("nan"), 1.0], [float("inf"), 1.0], [None, 1.0], None):
        assert values(spark, bad, lambda c: v.well_formed(c, 2)) is False
    with pytest.raises(Exception, match="expected 2 finite values"):
        values(spark, [1.0], lambda c: v.checked(c, 2))


def test_variants(spark):
    frame = spark.createDataFrame([([3.0, 4.0, 12.0, 0.0],)], "v array<float>")
    assert as_variant(frame, "v", 4, 2).first().v == pytest.approx([0.6, 0.8])
    assert as_variant(frame, "v", 4, 2, renorm=False).first().v == [3.0, 4.0]
    assert as_variant(frame, "v", 4, 4).first().v == [3.0, 4.0, 12.0, 0.0]
    half = as_variant(frame, "v", 4, 2, half=True).first().v
    assert half == pytest.approx([0.6, 0.8])
    good, bad = split_malformed(frame.unionByName(spark.createDataFrame([([1.0],)], "v array<float>")), "v", 4)
    assert (good.count(), bad.count()) == (1, 1)


def test_encoders(spark):
    texts = spark.createDataFrame([("a b b",), ("b a b",), ("",)], "t string")
    hashed = [r.vector for r in hashed_vectors(texts, "t", 16).collect()]
    assert hashed[0] == hashed[1] and np.linalg.norm(hashed[0]) == pytest.approx(1.0)

    def lengths():
        return lambda batch: np.array([[len(t) + 3.0, 4.0] for t in batch])

    got = texts.select(encoder_column(F.col("t"), lengths, 2).alias("o")).collect()
    assert got[2].o == pytest.approx([0.6, 0.8])
    with pytest.raises(Exception, match="encoder returned"):
        texts.select(encoder_column(F.col("t"), lengths, 3)).collect()
