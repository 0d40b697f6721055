"""The jobs chained over stored tables, as a user runs them."""

import json

from sievegate import cli
from sievegate.catalog import tables


def run(capsys, *args):
    code = cli.main([str(a) for a in args])
    out = capsys.readouterr().out
    return code, json.loads(out)


def test_all_jobs_in_a_row(spark, tmp_path, capsys):
    folder = {n: tmp_path / n for n in ("raw", "corpus", "labels", "gold", "vectors", "index", "queries", "sweep", "data", "pred", "cmp")}
    folder["raw"].mkdir()
    messages = tables.raw_messages(spark, "/root/testdata/sf0.001")
    for split in ("train", "validation", "test"):
        part = messages.filter(f"split = '{split}'").drop("split").toPandas()
        part.to_parquet(folder["raw"] / f"{split}-00000-of-00001.parquet")
    _, stats = run(capsys, "prep", "--raw", folder["raw"], "--out", folder["corpus"])
    assert stats["raw_rows"] == 200 and stats["chunk_rows"] > 200
    _, marks = run(capsys, "labels", "--corpus", folder["corpus"], "--out", folder["labels"], "--gold-dir", folder["gold"], "--sample", 30, "--splits", 1)
    assert marks["chunks"] == stats["chunk_rows"] and marks["gold_candidates"] == 30
    _, vectors = run(capsys, "embed", "--corpus", folder["corpus"], "--out", folder["vectors"], "--dim", 48)
    assert vectors["rows"] == stats["chunk_rows"]
    index = ("index", "--corpus", folder["corpus"], "--labels", folder["labels"], "--vectors", folder["vectors"], "--out", folder["index"], "--dim", 48)
    assert run(capsys, *index)[1]["version"] == 0
    _, again = run(capsys, *index)
    assert again["version"] == 1 and again["chunks"] == stats["chunk_rows"] and again["documents"] == stats["after_normalized"]
    code, audit = run(capsys, "leak", "--index", folder["index"], "--splits", folder["gold"] / "splits", "--dim", 48, "--k", 3)
    assert code == 0 and audit["passed"] and all(u["violations"] == 0 for u in audit["users"])
    _, frozen = run(capsys, "freeze", "--index", folder["index"], "--out", folder["queries"], "--per-kind", 5)
    assert frozen["subject"] == 5 and frozen["chunk"] == 5
    _, sweep = run(capsys, "sweep", "--index", folder["index"], "--queries", folder["queries"], "--out", folder["sweep"], "--dim", 48)
    assert len(sweep) == 8 and all(r["queries"] == 10 for r in sweep)

    gold = tmp_path / "gold.jsonl"
    rows = [r.asDict(recursive=True) for r in spark.read.json(str(folder["gold"] / "candidates")).collect()]
    gold.write_text("".join(json.dumps({**r, "gold_label": r["weak_label"], "note": ""}) + "\n" for r in rows))
    _, data = run(capsys, "classify-data", "--corpus", folder["corpus"], "--labels", folder["labels"], "--gold", gold,
                  "--splits", folder["gold"] / "splits", "--out", folder["data"], "--min-rows", 1, "--gold-rows", 30)
    assert data["eval_rows"] == 30 and data["train_rows"] > 0 and data["gold_threads"] > 0
    _, fitted = run(capsys, "classify-lr", "--train", folder["data"] / "train", "--eval", folder["data"] / "eval", "--vectors", folder["vectors"],
                    "--out", folder["pred"], "--dim", 48, "--method", "lr", "--c", 1.0, "--weights", tmp_path / "weights")
    assert fitted["rows"] == 30
    (folder["pred"] / "broken.json").write_text("{ not json")
    (folder["pred"] / "other.json").write_text(json.dumps({"rows": [
        {"doc_id": "d", "chunk_ord": 0, "gold": "public", "pred": "public", "probs": {"public": 1.0}, "latency_ms": 2.0}]}))
    _, compared = run(capsys, "classify-eval", "--results", folder["pred"], "--out", folder["cmp"], "--eval", folder["data"] / "eval")
    assert compared["methods"] == 2 and compared["skipped_files"] == ["broken.json"]
    summary = {(r.method, r.subset): r for r in spark.read.json(str(folder["cmp"])).collect()}
    assert summary["lr", "all"].n == 30 and summary["lr", "all"].p50 is None and summary["other", "all"].p50 == 2.0
