import hashlib
from itertools import chain, combinations

import pytest
from pyspark.sql import functions as F

from sievegate.functions import acl
from sievegate.operators import audit, permission
from sievegate.operators.upsert import grant_roles, role_set_counts
from sievegate.plans.search import run_leak_audit, search

E, H, N = "Everyone", "HR", "Finance"
TRUTH = [
    ("public", [E], [E], True), ("public", [E], [H, E], True), ("public", [H], [N, E], False),
    ("public", [], [E], False), ("internal", [E, H], [E], True), ("internal", [E, H], [N, E], True),
    ("internal", [H], [N, E], False), ("confidential", [H], [H, E], True), ("confidential", [H], [E], False),
    ("confidential", [E], [H, E], False), ("confidential", [E], [E], False), ("confidential", [N], [H, E], False),
    ("confidential", [H, E], [E], False), ("confidential", [H, N], [N, E], True), ("public", None, [E], False),
    ("public", [None], [E], False),
]
SHAPE = "label string, allowed array<string>, roles array<string>"


def both(frame):
    args = (F.col("label"), F.col("allowed"), F.col("roles"))
    return frame.select("*", acl.may_read(*args).alias("a"), acl.is_visible(*args).alias("b"))


def test_truth_table(spark):
    frame = spark.createDataFrame(TRUTH, SHAPE + ", visible boolean")
    for row in both(frame).collect():
        assert row.a == row.b == row.visible, row


def test_definitions_agree_on_every_subset(spark):
    roles = [E, H, N, "Admin"]
    subsets = [list(s) for s in chain.from_iterable(combinations(roles, n) for n in range(5))]
    rows = [(label, a, r) for label in ("public", "internal", "confidential") for a in subsets for r in subsets]
    frame = both(spark.createDataFrame(rows, SHAPE))
    assert frame.filter(F.col("a") != F.col("b")).count() == 0
    documents = spark.createDataFrame(
        [(i, label, a) for i, (label, a) in enumerate((x, y) for x in ("public", "internal", "confidential") for y in subsets)],
        "doc_id int, label string, allowed_roles array<string>",
    )
    users = spark.createDataFrame([(str(i), r) for i, r in enumerate(subsets)], "user string, roles array<string>")
    through_signatures = {(r.user, r.doc_id) for r in permission.visible_documents(documents, users).collect()}
    direct = documents.crossJoin(users).filter(acl.may_read(F.col("label"), F.col("allowed_roles"), F.col("roles")))
    assert through_signatures == {(r.user, r.doc_id) for r in direct.collect()}


def test_seeded_grants(spark):
    rows = [("d1", "public", "text"), ("d2", "internal", "text"), ("d3", "confidential", "text"), ("d4", "confidential", "image")]
    documents = spark.createDataFrame(rows, "doc_id string, label string, modality string")
    got = {r.doc_id: r.allowed_roles for r in grant_roles(documents, acl.team_by_blake).collect()}

    def team(key):
        return H if hashlib.blake2b(key.encode(), digest_size=1).digest()[0] % 2 else N

    assert got == {"d1": [E], "d2": [E, team("d2")], "d3": [team("d3")], "d4": [E]}
    counts = {r.role_set: r.n_docs for r in role_set_counts(grant_roles(documents, acl.team_by_sha)).collect()}
    assert sum(counts.values()) == 4 and counts[E] == 2
    odd = spark.createDataFrame([("d", "secret", "text")], "doc_id string, label string, modality string")
    with pytest.raises(Exception, match="unknown label"):
        grant_roles(odd, acl.team_by_sha).collect()


def store(spark):
    documents = spark.createDataFrame(
        [("doc-pub", "Pub", "text", "public", [E]), ("doc-hr", "Hr", "text", "internal", [H]),
         ("doc-con", "Con", "text", "confidential", [H]), ("doc-none", "None", "text", "public", [])],
        "doc_id string, title string, modality string, label string, allowed_roles array<string>",
    )
    chunks = spark.createDataFrame(
        [("c-pub-0", "doc-pub", "a" * 300, [1.0, 0.1]), ("c-hr-0", "doc-hr", "hr", [1.0, 0.2]),
         ("c-con-0", "doc-con", "con", [1.0, 0.3]), ("c-none-0", "doc-none", "n", [1.0, 0.0]),
         ("c-null-0", "doc-pub", "null", None), ("c-zero-0", "doc-pub", "zero", [0.0, 0.0])],
        "chunk_id string, doc_id string, text string, embedding array<float>",
    )
    users = acl.users_frame(spark, {"hr": (H, E), "all": (E,)})
    queries = spark.createDataFrame([("q", [1.0, 0.0])], "qid string, vector array<float>")
    requests = spark.createDataFrame([("hr", "q"), ("all", "q")], "user string, qid string")
    return requests, queries, chunks, documents, users


def test_search_returns_only_permitted_hits_in_order(spark):
    requests, queries, chunks, documents, users = store(spark)
    rows = search(requests, queries, chunks, documents, users, 10, 2).orderBy("user", "rank").collect()
    assert [(r.user, r.doc_id) for r in rows] == [
        ("all", "doc-pub"), ("hr", "doc-pub"), ("hr", "doc-hr"), ("hr", "doc-con"),
    ]
    assert len(rows[0].snippet) == 200 and rows[0].score == pytest.approx(1 - rows[0].distance)
    context = permission.answer_context(search(requests, queries, chunks, documents, users, 10, 2))
    hr = {r.user: r for r in context.collect()}["hr"]
    assert [c.doc_id for c in hr.citations] == ["doc-pub", "doc-hr", "doc-con"] and hr.passages[1:] == ["hr", "con"]


def test_recheck_fails_on_forbidden_and_missing_documents(spark):
    _, _, _, documents, users = store(spark)
    hits = spark.createDataFrame(
        [("all", "q", "c", "doc-con"), ("all", "q", "c", "gone"), ("all", "q", "c", "doc-pub")],
        "user string, qid string, chunk_id string, doc_id string",
    )
    checked = permission.recheck(hits, documents, users)
    assert {r.doc_id: r.visible for r in checked.collect()} == {"doc-con": False, "gone": False, "doc-pub": True}
    with pytest.raises(Exception, match="access re-check failed"):
        permission.enforce(checked).collect()


def test_fetch_hides_why_nothing_was_found(spark):
    _, _, _, documents, users = store(spark)
    asked = spark.createDataFrame([("all", "doc-con"), ("all", "gone"), ("hr", "doc-con"), ("nobody", "doc-pub")], "user string, doc_id string")
    got = {(r.user, r.doc_id): (r.found, r.title) for r in permission.fetch_documents(asked, documents, users).collect()}
    assert got[("all", "doc-con")] == got[("all", "gone")] == got[("nobody", "doc-pub")] == (False, None)
    assert got[("hr", "doc-con")] == (True, "Con")
    assert [r.user for r in permission.unknown_users(asked, users).collect()] == ["nobody"]


def test_audit_needs_every_request_filled(spark):
    requests, queries, chunks, documents, users = store(spark)
    table = {r.user: r for r in run_leak_audit(queries, chunks, documents, 1, 2, {"hr": (H, E), "all": (E,)}).collect()}
    assert all(r.passed and r.violations == 0 and r.hits_checked == 1 for r in table.values())
    short = {r.user: r for r in run_leak_audit(queries, chunks, documents, 2, 2, {"hr": (H, E), "all": (E,)}).collect()}
    assert short["hr"].passed and not short["all"].passed and short["all"].shortfalls == 1
    empty = audit.leak_audit(requests, spark.createDataFrame([], "user string, qid string, doc_id string"), documents, users, 1)
    assert not any(r.passed for r in empty.collect())
    planted = spark.createDataFrame([("all", "q", "doc-con"), ("hr", "q", "doc-hr")], "user string, qid string, doc_id string")
    flagged = {r.user: r.violations for r in audit.leak_audit(requests, planted, documents, users, 1).collect()}
    assert flagged == {"all": 1, "hr": 0}
