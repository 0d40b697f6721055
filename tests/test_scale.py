"""What leaves a task, reaches the driver or stands in memory stays bounded."""

import numpy as np

from sievegate.functions.acl import USERS, users_frame
from sievegate.operators import audit, neighbors, permission
from sievegate.operators.neighbors import nearest_items


def vectors(spark, n, names, dim=8):
    rng = np.random.default_rng(n)
    rows = [(i, i // 4, [float(x) for x in row]) for i, row in enumerate(rng.standard_normal((n, dim)).astype(np.float32))]
    return spark.createDataFrame(rows, f"{names[0]} long, doc_id long, {names[1]} array<float>")


def broadcast_parts(plan):
    """The subtrees of a printed plan that are broadcast."""
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            stop = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            yield "\n".join(lines[i:stop])


def test_hits_are_never_broadcast(spark, tmp_path):
    """A file of few bytes leads to many hits, which the planner cannot know."""

    def from_file(df, name):
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    queries = from_file(vectors(spark, 60, ("qid", "vector")), "queries")
    items = from_file(vectors(spark, 60, ("chunk_id", "embedding")), "items")
    documents = spark.createDataFrame(
        [(i, "public" if i % 2 else "internal", ["Everyone"]) for i in range(15)],
        "doc_id long, label string, allowed_roles array<string>",
    )
    documents = from_file(documents, "documents")
    requests = audit.all_requests(queries, USERS)
    hits = permission.permitted_hits(
        requests, queries, permission.with_signature(items, documents), documents, users_frame(spark), 20, 8
    )
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and not any("MapInArrow" in part for part in broadcast_parts(plan))
    assert hits.count() == 60 * len(USERS) * 20


def test_small_tiles_hand_on_k_rows_a_query(spark, monkeypatch):
    handed = []
    merge = neighbors.merge_winners

    def counting(local, *rest):
        handed.append(local.count())
        return merge(local, *rest)

    monkeypatch.setattr(neighbors, "merge_winners", counting)
    queries, items = vectors(spark, 200, ("qid", "vector")), vectors(spark, 300, ("chunk_id", "embedding"))
    ways = [{}, {"broadcast_bytes": 0, "tile_queries": 9, "tile_items": 10}]
    whole, tiled = ([tuple(r) for r in nearest_items(queries, items.repartition(3), 5, 8, **w).orderBy("qid", "rank").collect()] for w in ways)
    assert whole == tiled and handed[1] == 200 * 5


def test_winners_leave_in_frames_of_bounded_size(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(neighbors, "_EMIT_ROWS", 100)
    matrix = np.random.default_rng(1).standard_normal((90, 8))
    best = neighbors._Nearest(*neighbors._unit_queries(np.arange(90), matrix), 7)
    best.add(matrix, pd.DataFrame({"chunk_id": np.arange(90)}), "chunk_id")
    frames = list(best.winners())
    assert max(map(len, frames)) <= 100 and sum(map(len, frames)) == 90 * 7


def test_single_precision_never_decides(monkeypatch):
    """Distances that differ by less than single precision tells, against the plain way."""
    import pandas as pd

    rng = np.random.default_rng(5)
    base = rng.standard_normal((1, 16))
    items = base + 1e-5 * rng.standard_normal((4000, 16))
    queries = base + 1e-5 * rng.standard_normal((30, 16))
    best = neighbors._Nearest(*neighbors._unit_queries(np.arange(30), queries), 6, (10, 700))
    for start in range(0, 4000, 1000):
        names = pd.DataFrame({"chunk_id": np.arange(start, start + 1000)})
        best.add(items[start : start + 1000], names, "chunk_id")
    q = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    m = items / np.linalg.norm(items, axis=1, keepdims=True)
    units = np.rint((1 - q @ m.T) * 1e9).astype(int)
    got = pd.concat(best.winners()).sort_values(["_query", "_units", "chunk_id"])
    assert np.abs(got["_units"].to_numpy().reshape(30, 6) - np.sort(units, axis=1)[:, :6]).max() <= 1


def test_texts_become_strings_a_few_at_a_time():
    import pyarrow as pa

    from sievegate.functions.chunks import small_slices

    texts = pa.array(["a" * 30, None, "é" * 20, "", "c" * 300, "d"])
    parts = list(small_slices(texts, 80))
    assert pa.concat_arrays(parts).equals(texts)
    assert all(len(p) == 1 or sum(len((t or "").encode()) for t in p.to_pylist()) <= 80 for p in parts)
    assert list(small_slices(pa.array([], pa.string()))) == []


def test_stream_batches_are_small(spark, tmp_path):
    """Settings reach the query that starts and are as before afterwards."""
    from sievegate.streaming import incremental

    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    schema = "email_body string, subject_line string, split string"
    spark.createDataFrame([("text", "s", "train")], schema).write.parquet(f"{tmp_path}/in")
    arrived = incremental.message_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
    before, write = spark.conf.get(name), incremental.write_batch

    def spying(df, path, batch_id):
        seen.append(df.sparkSession.conf.get(name))
        write(df, path, batch_id)

    incremental.write_batch = spying
    try:
        incremental.start_prep(arrived, f"{tmp_path}/out", f"{tmp_path}/progress").awaitTermination()
    finally:
        incremental.write_batch = write
    assert set(seen) == {str(4 << 20)} and spark.conf.get(name) == before
    assert spark.read.parquet(f"{tmp_path}/out/corpus").count() == 1
