"""Grants, visibility, permission-filtered search and leak audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievegate.catalog import tables as t
from sievegate.catalog.registry import registry
from sievegate.functions.acl import (
    USERS,
    is_visible,
    may_read,
    role_set_key,
    signature,
    team_by_blake,
    team_by_sha,
    users_frame,
)
from sievegate.operators import audit, permission
from sievegate.operators.labelling import document_labels, index_profile, label_chunks
from sievegate.operators.upsert import grant_roles, role_set_counts
from sievegate.plans.search import answer_prompts, search

QUERIES, ORACLES, query = registry()

K = 10
_DOC_LABELS = """doc_labels AS (SELECT doc_id, 'text' AS modality, CASE max(CASE label WHEN 'public' THEN 0 WHEN 'internal' THEN 1 ELSE 2 END)
    WHEN 0 THEN 'public' WHEN 1 THEN 'internal' ELSE 'confidential' END AS label FROM corpus_labels GROUP BY doc_id)"""
_GRANTED = f"{_DOC_LABELS}, granted AS (SELECT *, {t.sql_roles(t.sql_team('doc_id'))} AS allowed_roles FROM doc_labels)"
_HITS = f"""ranked AS (SELECT u."user", p.qid, p.chunk_id, p.doc_id, p.units,
    row_number() OVER (PARTITION BY u."user", p.qid ORDER BY p.units, p.chunk_id) AS rank
    FROM pairs p JOIN vdocs USING (doc_id), users u WHERE {t.SQL_MAY_READ})"""


def granted_documents(spark, d):
    """Rule labels per document of the corpus, with seeded grants."""
    labels = document_labels(label_chunks(t.corpus(spark, d)))
    return grant_roles(labels.withColumn("modality", F.lit("text")), team_by_sha)


def all_hits(spark, d, k: int = K):
    queries = t.vector_queries(spark, d)
    documents = t.vector_documents(spark, d)
    requests = audit.all_requests(queries, USERS)
    items = permission.with_signature(t.vector_items(spark, d), documents)
    users = users_frame(spark)
    hits = permission.permitted_hits(requests, queries, items, documents, users, k, t.DIM)
    return requests, hits, documents, users


@query(
    "visible_docs_per_user",
    t.with_tables(
        "corpus_labels users",
        f"""SELECT "user", label, count(*) AS n_docs, count(*) FILTER ({t.SQL_MAY_READ}) AS n_visible
        FROM granted, users GROUP BY "user", label""",
        _GRANTED,
    ),
)
def visible_docs_per_user(spark, d):
    """Raw texts to what each user may see: documents shrink to signature counts first."""
    acl = signature(F.col("label"), F.col("allowed_roles"))
    counted = (
        granted_documents(spark, d)
        .groupBy(acl.alias("acl"), "label", F.array_sort("allowed_roles").alias("allowed_roles"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    names = F.array(*[F.lit(name) for name in USERS])
    asked = counted.select("*", F.explode(names).alias("user")).join(users_frame(spark), "user")
    visible = may_read(F.col("label"), F.col("allowed_roles"), F.col("roles"))
    return asked.groupBy("user", "label").agg(
        F.sum("n").alias("n_docs"), F.sum(F.when(visible, F.col("n")).otherwise(0)).alias("n_visible")
    )


@query(
    "acl_assignment",
    t.with_tables("corpus_labels", "SELECT doc_id, label, array_to_string(list_sort(allowed_roles), '+') AS role_set FROM granted", _GRANTED),
)
def acl_assignment(spark, d):
    return granted_documents(spark, d).select(
        "doc_id", "label", role_set_key(F.col("allowed_roles")).alias("role_set")
    )


@query(
    "role_set_counts",
    t.with_tables("vdocs", "SELECT array_to_string(list_sort(allowed_roles), '+') AS role_set, count(*) AS n_docs FROM vdocs GROUP BY 1"),
)
def role_sets(spark, d):
    return role_set_counts(t.vector_documents(spark, d))


@query("blake2b_team")
def blake2b_team(spark, d):
    documents = t.text_documents(spark, d)
    return documents.groupBy(team_by_blake(F.col("doc_id")).alias("team")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "acl_predicate_agreement",
    t.with_tables(
        "corpus_labels users",
        f"""SELECT "user", count(*) AS n, count(*) FILTER ({t.SQL_MAY_READ}) AS n_visible, 0::BIGINT AS n_disagree FROM granted, users GROUP BY 1""",
        _GRANTED,
    ),
)
def acl_predicate_agreement(spark, d):
    """Both definitions of visibility on every (document, user)."""
    roles = F.array(
        *[
            F.struct(F.lit(u).alias("user"), F.array(*[F.lit(r) for r in rs]).alias("roles"))
            for u, rs in USERS.items()
        ]
    )
    pairs = granted_documents(spark, d).select("label", "allowed_roles", F.explode(roles).alias("u"))
    args = (F.col("label"), F.col("allowed_roles"), F.col("u.roles"))
    return pairs.groupBy("u.user").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(may_read(*args)).alias("n_visible"),
        F.count_if(may_read(*args) != is_visible(*args)).alias("n_disagree"),
    )


@query(
    "visible_documents",
    t.with_tables("vdocs users", f'SELECT "user", doc_id FROM vdocs, users WHERE {t.SQL_MAY_READ}'),
)
def visible_documents(spark, d):
    return permission.visible_documents(t.vector_documents(spark, d), users_frame(spark))


_FETCH = """requests AS (SELECT DISTINCT ['alice', 'bob', 'carol', 'admin', 'Alice'][(user_id % 5 + 1)::INT] AS "user", event_id % 700 AS doc_id FROM events)"""


def fetch_requests(spark, d):
    """Readers and document numbers taken from the events; some of either do not exist."""
    names = F.array(*[F.lit(n) for n in ("alice", "bob", "carol", "admin", "Alice")])
    return t.table(spark, d, "events").select(
        F.get(names, (F.col("user_id") % 5).cast("int")).alias("user"), (F.col("event_id") % 700).alias("doc_id")
    ).distinct()


@query(
    "document_fetch",
    t.with_tables(
        "vdocs users",
        f"""SELECT "user", doc_id, found, CASE WHEN found THEN title END AS title, CASE WHEN found THEN label END AS label FROM (
        SELECT r."user", r.doc_id, title, label, coalesce({t.SQL_MAY_READ}, false) AS found
        FROM requests r LEFT JOIN vdocs USING (doc_id) LEFT JOIN users ON users."user" = r."user")""",
        _FETCH,
    ),
)
def document_fetch(spark, d):
    fetched = permission.fetch_documents(
        fetch_requests(spark, d), t.vector_documents(spark, d), users_frame(spark)
    )
    return fetched.select("user", "doc_id", "found", "title", "label")


@query(
    "unknown_users",
    t.with_tables("users", 'SELECT "user", count(*) AS n FROM requests WHERE "user" NOT IN (SELECT "user" FROM users) GROUP BY 1', _FETCH),
)
def unknown_users(spark, d):
    unknown = permission.unknown_users(fetch_requests(spark, d), users_frame(spark))
    return unknown.groupBy("user").agg(F.count(F.lit(1)).alias("n"))


@query(
    "planted_violations",
    t.with_tables(
        "vdocs users",
        f"""SELECT "user", visible, count(*) AS n FROM (SELECT r."user", coalesce({t.SQL_MAY_READ}, false) AS visible
        FROM requests r LEFT JOIN vdocs v USING (doc_id) LEFT JOIN users u ON u."user" = r."user") GROUP BY 1, 2""",
        _FETCH,
    ),
)
def planted_violations(spark, d):
    """The re-check over hits that no filter has seen: forbidden and missing documents, unknown users."""
    checked = permission.recheck(fetch_requests(spark, d), t.vector_documents(spark, d), users_frame(spark))
    return checked.groupBy("user", "visible").agg(F.count(F.lit(1)).alias("n"))


@query(
    "loose_user_lookup",
    t.with_tables(
        "users",
        """SELECT "user", count(*) AS n FROM (SELECT DISTINCT u."user", r.doc_id FROM requests r
        JOIN users u ON lower(trim('  ' || upper(r."user") || ' ')) = lower(trim(u."user"))) GROUP BY 1""",
        _FETCH,
    ),
)
def loose_user_lookup(spark, d):
    typed = F.concat(F.lit("  "), F.upper("user"), F.lit(" "))
    requests = fetch_requests(spark, d).withColumn("user", typed)
    found = permission.named_users(requests, users_frame(spark)).distinct()
    return found.groupBy("user").agg(F.count(F.lit(1)).alias("n"))


@query(
    "knn_permission",
    t.with_tables(
        "pairs vdocs users",
        'SELECT "user", qid, chunk_id, doc_id, round(units / 1000000000.0, 6)::DOUBLE AS distance, rank FROM ranked WHERE rank <= 10',
        _HITS,
    ),
)
def knn_permission(spark, d):
    _, hits, _, _ = all_hits(spark, d)
    return hits.select(
        "user", "qid", "chunk_id", "doc_id", F.round("distance", 6).alias("distance"), F.col("rank").cast("bigint").alias("rank")
    )


@query(
    "acl_recheck",
    t.with_tables("pairs vdocs users", 'SELECT "user", count(*) AS n_hits, 0::BIGINT AS n_forbidden FROM ranked WHERE rank <= 10 GROUP BY 1', _HITS),
)
def acl_recheck(spark, d):
    _, hits, documents, users = all_hits(spark, d)
    checked = permission.recheck(hits, documents, users)
    return checked.groupBy("user").agg(
        F.count(F.lit(1)).alias("n_hits"), F.count_if(~F.col("visible")).alias("n_forbidden")
    )


@query(
    "leak_audit",
    t.with_tables(
        "pairs vdocs users",
        """SELECT "user", count(*) AS queries, sum(n)::BIGINT AS hits_checked, count(*) * 10 AS expected_hits,
        count(*) FILTER (n < 10) AS shortfalls, 0::BIGINT AS violations, sum(n) = count(*) * 10 AS passed FROM (
        SELECT u."user", q.chunk_id AS qid, count(r.rank) AS n FROM users u CROSS JOIN items q
        LEFT JOIN ranked r ON r."user" = u."user" AND r.qid = q.chunk_id AND r.rank <= 10 GROUP BY 1, 2) GROUP BY 1""",
        _HITS,
    ),
)
def leak_audit(spark, d):
    requests, hits, documents, users = all_hits(spark, d)
    return audit.leak_audit(requests, hits, documents, users, K)


@query(
    "shortfalls",
    t.with_tables(
        "pairs vdocs users",
        'SELECT "user", qid, count(*) AS n_hits FROM ranked WHERE rank <= 150 GROUP BY 1, 2 HAVING count(*) < 150',
        _HITS,
    ),
)
def shortfalls(spark, d):
    """At a depth of 150 some users run out of documents they may see."""
    requests, hits, _, _ = all_hits(spark, d, 150)
    return audit.shortfalls(requests, hits, 150)


def text_chunks(spark, d):
    """Vector chunks with the text of the document of the same number, if there is one."""
    texts = t.table(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    joined = t.vector_items(spark, d).join(texts, "chunk_id", "left")
    return joined.withColumn("text", F.coalesce("text", F.lit("")))


def found_rows(spark, d):
    queries = t.vector_queries(spark, d)
    requests = audit.all_requests(queries, USERS)
    return search(
        requests, queries, text_chunks(spark, d), t.vector_documents(spark, d), users_frame(spark), 5, t.DIM
    )


_SHOWN = f"""{_HITS}, shown AS (SELECT r."user", r.qid, r.rank, r.chunk_id, r.doc_id, v.title, v.modality, v.label, r.units,
    substr(coalesce(x.text, ''), 1, 200) AS snippet, substr(coalesce(x.text, ''), 1, 1500) AS passage FROM ranked r JOIN vdocs v USING (doc_id) LEFT JOIN documents x ON x.doc_id = r.chunk_id WHERE rank <= 5)"""


@query(
    "search_hits",
    t.with_tables(
        "pairs vdocs users",
        """SELECT "user", qid, rank, chunk_id, doc_id, title, modality, label, md5(snippet) AS snippet, round(1 - units / 1000000000.0, 6)::DOUBLE AS score FROM shown""",
        _SHOWN,
    ),
)
def search_hits(spark, d):
    return found_rows(spark, d).select(
        "user", "qid", F.col("rank").cast("bigint").alias("rank"), "chunk_id", "doc_id", "title", "modality", "label",
        F.md5("snippet").alias("snippet"), F.round("score", 6).alias("score"),
    )


@query(
    "context_assembly",
    t.with_tables(
        "pairs vdocs users",
        """SELECT "user", qid, md5('Answer the question using ONLY the passages below. Cite every claim as [n]. If the passages do not answer it, say so.'
        || chr(10) || chr(10) || 'Question: question ' || qid || chr(10) || chr(10) || 'Passages:' || chr(10)
        || string_agg('[' || rank || '] ' || passage, chr(10) ORDER BY rank) || chr(10) || chr(10) || 'Answer:') AS prompt, count(*) AS n_citations
        FROM shown GROUP BY 1, 2""",
        _SHOWN,
    ),
)
def context_assembly(spark, d):
    questions = t.vector_queries(spark, d).select(
        "qid", F.concat(F.lit("question "), F.col("qid").cast("string")).alias("text")
    )
    prompts = answer_prompts(found_rows(spark, d), questions)
    return prompts.select(
        "user", "qid", F.md5("prompt").alias("prompt"), F.size("citations").cast("bigint").alias("n_citations")
    )


@query(
    "citations",
    t.with_tables("pairs vdocs users", 'SELECT "user", qid, rank - 1 AS pos, doc_id, chunk_id, title FROM shown', _SHOWN),
)
def citations(spark, d):
    context = permission.answer_context(found_rows(spark, d))
    listed = context.select("user", "qid", F.posexplode("citations").alias("pos", "c"))
    return listed.select("user", "qid", F.col("pos").cast("bigint").alias("pos"), "c.doc_id", "c.chunk_id", "c.title")


@query(
    "stray_citations",
    t.with_tables(
        "pairs vdocs users",
        """SELECT "user", count(*) AS n FROM (SELECT DISTINCT "user", qid, doc_id FROM ranked WHERE rank <= 10) c
        WHERE NOT EXISTS (SELECT 1 FROM ranked r WHERE r."user" = c."user" AND r.qid = c.qid AND r.doc_id = c.doc_id AND r.rank <= 3) GROUP BY 1""",
        _HITS,
    ),
)
def stray_citations(spark, d):
    """All ten hits cited although only the first three were returned."""
    _, hits, _, _ = all_hits(spark, d)
    cited = hits.select("user", "qid", "doc_id").distinct()
    stray = audit.stray_citations(cited, hits.filter(F.col("rank") <= 3))
    return stray.groupBy("user").agg(F.count(F.lit(1)).alias("n"))


@query(
    "response_audit",
    t.with_tables(
        "pairs vdocs users",
        """SELECT (SELECT count(*) FROM items) * 4 AS responses, 4 * (SELECT count(*) FROM items WHERE chunk_id % 2 = 0 AND chunk_id % 10 = 4) AS mode_leaks,
        4 * (SELECT count(*) FROM items WHERE chunk_id % 2 = 1 AND chunk_id % 10 = 1) AS empty_answers,
        4 * (SELECT count(*) FROM items WHERE chunk_id % 2 = 1 AND chunk_id % 10 = 3) AS citation_drifts,
        (SELECT count(*) FROM ranked WHERE rank <= 10) AS checked, 0::BIGINT AS forbidden_hits,
        4 * (SELECT count(*) FROM items WHERE chunk_id % 10 IN (3, 4)) AS violations""",
        _HITS,
    ),
)
def response_audit(spark, d):
    """Responses over all hits with planted faults: answers in fast mode, strays, blanks."""
    requests, hits, documents, users = all_hits(spark, d)
    listed = hits.groupBy("user", "qid").agg(F.collect_list("doc_id").alias("hits"))
    kind = F.col("qid") % 10
    none = F.array().cast("array<bigint>")
    responses = (
        requests.join(listed, ["user", "qid"], "left")
        .withColumn("hits", F.coalesce("hits", none))
        .select(
            "user",
            "qid",
            F.when(F.col("qid") % 2 == 0, "fast").otherwise("answer").alias("mode"),
            F.when(kind == 4, "leaked").when(kind == 1, "").when(F.col("qid") % 2 == 1, "fine").alias("answer"),
            "hits",
            F.when(kind == 3, F.array(F.lit(-1).cast("bigint"))).otherwise(F.slice("hits", 1, 3)).alias("citations"),
        )
    )
    return audit.response_audit(responses, documents, users)


@query(
    "index_profile",
    t.with_tables(
        "vdocs",
        """SELECT 'label' AS metric, label AS key, count(*) AS n FROM vdocs GROUP BY label
        UNION ALL SELECT 'modality', modality, count(*) FROM vdocs GROUP BY modality
        UNION ALL SELECT 'chunks', 'all', count(*) FROM items
        UNION ALL SELECT 'chunks', 'without_vector', count(*) FILTER (topic = 9) FROM items
        UNION ALL SELECT 'label', 'confidential_to_everyone', count(*) FILTER (label = 'confidential' AND list_contains(allowed_roles, 'Everyone')) FROM vdocs""",
    ),
)
def index_state(spark, d):
    """The vectors of one topic are left out, as if not embedded yet."""
    chunks = t.vector_items(spark, d).withColumn(
        "embedding", F.when(F.col("topic") != 9, F.col("embedding"))
    )
    return index_profile(t.vector_documents(spark, d), chunks)
