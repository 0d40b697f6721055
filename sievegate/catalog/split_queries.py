"""Splits, samples, leak-free training rows and table maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievegate.catalog import tables as t
from sievegate.catalog.registry import registry
from sievegate.functions.acl import role_set_key, team_by_sha
from sievegate.functions.rules import label_from_tags
from sievegate.operators import labelling, splits, trainset
from sievegate.operators.encode import ordered_blocks
from sievegate.operators.upsert import (
    grant_roles,
    pending_rows,
    staging_counts,
    update_vectors,
)
from sievegate.plans.index import refresh_documents
from sievegate.session import cut_lineage
from sievegate.sources.files import image_rows

QUERIES, ORACLES, query = registry()

_BUCKET = "(('0x' || substr(sha256(thread_id), 1, 8))::BIGINT % 100)"
_SPLIT = f"CASE WHEN {_BUCKET} < 80 THEN 'train' WHEN {_BUCKET} < 90 THEN 'dev' ELSE 'test' END"
_MANIFEST = f"manifest AS (SELECT doc_id, thread_id, {_SPLIT} AS split FROM turns)"
# Short turns stand for the reviewed rows.
_GOLD = "gold AS (SELECT doc_id FROM turns WHERE length(text) < 60)"
_CUT = (
    f"{_MANIFEST}, {_GOLD}, gold_threads AS (SELECT DISTINCT thread_id FROM turns SEMI JOIN gold USING (doc_id)), "
    "allowed AS (SELECT doc_id FROM manifest WHERE split = 'train' AND thread_id NOT IN (SELECT thread_id FROM gold_threads))"
)


def manifest(spark, d):
    return splits.assign_splits(t.turns(spark, d), "sha")


def gold_turns(spark, d):
    return t.turns(spark, d).filter(F.length("text") < 60)


def allowed(spark, d):
    documents = trainset.document_sizes(t.turns(spark, d))
    train = manifest(spark, d).filter(F.col("split") == "train")
    return trainset.allowed_documents(documents, gold_turns(spark, d), train)


@query(
    "split_buckets",
    t.with_tables("turns", f"SELECT DISTINCT thread_id, {_BUCKET}::BIGINT AS bucket FROM turns"),
)
def split_buckets(spark, d):
    bucket = splits.thread_bucket(F.col("thread_id"), "sha").cast("bigint")
    return t.turns(spark, d).select("thread_id", bucket.alias("bucket")).distinct()


@query("split_counts", t.with_tables("turns", "SELECT split, count(*) AS n_docs FROM manifest GROUP BY split", _MANIFEST))
def split_counts(spark, d):
    return splits.split_counts(manifest(spark, d))


@query("murmur_split")
def murmur_split(spark, d):
    return splits.split_counts(splits.assign_splits(t.turns(spark, d), "murmur"))


@query(
    "split_thread_overlap",
    t.with_tables(
        "turns",
        f"""SELECT 0::BIGINT AS uncovered, 0::BIGINT AS "unknown", 0::BIGINT AS repeated,
        (SELECT count(*) FROM (SELECT conv_id FROM conversations GROUP BY conv_id HAVING count(DISTINCT role) > 1)) AS torn_threads""",
    ),
)
def split_thread_overlap(spark, d):
    """A manifest split by speaker instead of by thread: every mixed conversation is torn."""
    turns = t.turns(spark, d)
    return splits.split_violations(turns, turns.select("doc_id", F.col("title").alias("split")))


@query(
    "thread_exclusion",
    t.with_tables("turns", "SELECT doc_id FROM allowed", _CUT),
)
def thread_exclusion(spark, d):
    return allowed(spark, d)


@query(
    "exclusion_stats",
    t.with_tables(
        "turns",
        """SELECT (SELECT count(*) FROM gold_threads) AS gold_threads,
        (SELECT count(*) FROM manifest SEMI JOIN gold USING (doc_id) WHERE split = 'train') AS doc_cut_docs,
        (SELECT count(*) FROM manifest SEMI JOIN gold USING (doc_id) WHERE split = 'train') AS doc_cut_chunks,
        (SELECT count(*) FROM manifest SEMI JOIN gold_threads USING (thread_id) WHERE split = 'train') AS thread_cut_docs,
        (SELECT count(*) FROM manifest SEMI JOIN gold_threads USING (thread_id) WHERE split = 'train') AS thread_cut_chunks,
        (SELECT coalesce(max(n), 0) FROM (SELECT count(*) AS n FROM turns SEMI JOIN gold_threads USING (thread_id) GROUP BY thread_id)) AS max_gold_thread_docs""",
        _CUT,
    ),
)
def exclusion_stats(spark, d):
    documents = trainset.document_sizes(t.turns(spark, d))
    train = manifest(spark, d).filter(F.col("split") == "train")
    return trainset.exclusion_stats(documents, gold_turns(spark, d), train)


@query(
    "allow_list_rows",
    t.with_tables(
        "turn_evidence",
        f"SELECT doc_id, chunk_ord, title, md5(text) AS digest, {t.SQL_LABEL} AS weak_label FROM turn_evidence SEMI JOIN allowed USING (doc_id)",
        _CUT,
    ),
)
def allow_list_rows(spark, d):
    turns = t.turns(spark, d)
    rows = trainset.train_rows(turns, labelling.label_chunks(turns), allowed(spark, d))
    return rows.select("doc_id", "chunk_ord", "title", F.md5("text").alias("digest"), "weak_label")


@query(
    "leaked_rows",
    t.with_tables(
        "turns",
        "SELECT title, count(*) AS n FROM turns ANTI JOIN allowed USING (doc_id) GROUP BY title",
        _CUT,
    ),
)
def leaked_rows(spark, d):
    """All turns checked against the allow list: the ones that would leak, by speaker."""
    leaks = trainset.leaked_rows(t.turns(spark, d), allowed(spark, d))
    return leaks.groupBy("title").agg(F.count(F.lit(1)).alias("n"))


@query(
    "split_tag_attach",
    t.with_tables(
        "turns", "SELECT doc_id, split FROM gold JOIN manifest USING (doc_id)", f"{_MANIFEST}, {_GOLD}"
    ),
)
def split_tag_attach(spark, d):
    return trainset.tag_splits(gold_turns(spark, d).select("doc_id"), manifest(spark, d))


@query(
    "test_subset",
    t.with_tables(
        "turns", "SELECT title, count(*) AS n FROM turns JOIN manifest USING (doc_id) WHERE split = 'test' GROUP BY title", _MANIFEST
    ),
)
def test_subset(spark, d):
    turns = t.turns(spark, d)
    tags = trainset.tag_splits(turns.select("doc_id", "chunk_ord"), manifest(spark, d))
    subset = trainset.subset_by_split(turns, tags, "test")
    return subset.groupBy("title").agg(F.count(F.lit(1)).alias("n"))


@query(
    "key_set_check",
    """SELECT count(*) FILTER (l.doc_id IS NULL) AS only_left, count(*) FILTER (x.doc_id IS NULL) AS only_right,
    count(*) FILTER (x.doc_id IS NOT NULL AND l.doc_id IS NOT NULL) AS shared FROM documents x FULL JOIN labels l ON l.doc_id = x.doc_id""",
)
def key_set_check(spark, d):
    return trainset.key_differences(
        t.table(spark, d, "documents"), t.table(spark, d, "labels"), ["doc_id"]
    )


_REVIEWED = f"""weak AS (SELECT doc_id, {t.SQL_LABEL} AS weak_label FROM text_evidence),
    verdicts AS (SELECT doc_id::VARCHAR AS doc_id, CASE WHEN toxic = 1 THEN 'confidential' WHEN quality = 1 THEN 'public' ELSE 'internal' END AS gold_label,
    CASE WHEN quality = 1 THEN 'looks clean' ELSE ' ' END AS note FROM labels)"""


def verdicts(spark, d):
    gold = F.when(F.col("toxic") == 1, "confidential").when(F.col("quality") == 1, "public")
    return t.table(spark, d, "labels").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.lit(0).alias("chunk_ord"),
        gold.otherwise("internal").alias("gold_label"),
        F.when(F.col("quality") == 1, "looks clean").otherwise(" ").alias("note"),
    )


def weak(spark, d):
    labels = labelling.label_chunks(t.text_documents(spark, d))
    return labels.withColumnRenamed("label", "weak_label")


@query(
    "review_coverage",
    t.with_tables(
        "text_evidence",
        """SELECT count(*) FILTER (w.doc_id IS NOT NULL) AS candidates, count(*) FILTER (w.doc_id IS NOT NULL AND v.doc_id IS NOT NULL) AS reviewed,
        count(*) FILTER (v.doc_id IS NULL) AS missing, count(*) FILTER (w.doc_id IS NULL) AS strays,
        count(*) FILTER (weak_label <> gold_label) AS changed,
        count(*) FILTER (weak_label <> gold_label AND trim(note) = '') AS changed_without_note
        FROM weak w FULL JOIN verdicts v ON w.doc_id = v.doc_id""",
        _REVIEWED,
    ),
)
def review_coverage(spark, d):
    return trainset.review_coverage(weak(spark, d), verdicts(spark, d))


@query(
    "weak_gold_agreement",
    t.with_tables(
        "text_evidence",
        """SELECT weak_label, gold_label, n, round(sum(CASE WHEN weak_label = gold_label THEN n ELSE 0 END) OVER () / sum(n) OVER (), 6)::DOUBLE AS agreement
        FROM (SELECT weak_label, gold_label, count(*) AS n FROM weak JOIN verdicts USING (doc_id) GROUP BY 1, 2)""",
        _REVIEWED,
    ),
)
def weak_gold_agreement(spark, d):
    rows = weak(spark, d).join(verdicts(spark, d), ["doc_id", "chunk_ord"])
    return labelling.weak_gold_agreement(rows).withColumn("agreement", F.round("agreement", 6))


@query(
    "stratified_sample",
    t.with_tables(
        "corpus_labels",
        """SELECT doc_id, chunk_ord, label AS weak_label FROM strata
        UNION ALL SELECT doc_id, chunk_ord, label FROM (
            SELECT * FROM drawn ANTI JOIN strata USING (doc_id, chunk_ord) ORDER BY fill, doc_id, chunk_ord
            LIMIT (SELECT 200 - count(*) FROM strata))""",
        """drawn AS (SELECT doc_id, chunk_ord, label, md5('42|' || doc_id || '|' || chunk_ord) AS draw,
            md5('43|' || doc_id || '|' || chunk_ord) AS fill FROM corpus_labels),
        strata AS (SELECT doc_id, chunk_ord, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY draw, doc_id, chunk_ord) AS rn FROM drawn) WHERE rn <= 66)""",
    ),
)
def stratified_sample(spark, d):
    chunks = t.stored_corpus(spark, d)
    sample = labelling.review_sample(chunks, cut_lineage(labelling.label_chunks(chunks)))
    return sample.select("doc_id", "chunk_ord", "weak_label")


@query(
    "stratified_folds",
    """SELECT vec_id, label::BIGINT AS label, ((row_number() OVER (PARTITION BY label ORDER BY md5('42|' || vec_id), vec_id) - 1) % 5)::INT AS fold FROM embeddings""",
)
def stratified_folds(spark, d):
    rows = t.table(spark, d, "embeddings").select("vec_id", F.col("label").cast("bigint").alias("label"))
    return labelling.stratified_folds(rows, ["vec_id"], "label")


@query(
    "ordered_blocks",
    t.with_tables(
        "corpus",
        """SELECT block, count(*) AS n, min(doc_id) AS first_doc, max(doc_id) AS last_doc FROM (
        SELECT doc_id, ((row_number() OVER (ORDER BY doc_id, chunk_ord) - 1) // 1000)::INT AS block FROM corpus) GROUP BY block""",
    ),
)
def key_blocks(spark, d):
    """Document ids are ``split:hash``; split and three hash digits make an ordered bucket."""
    keys = t.stored_corpus(spark, d).select("doc_id", "chunk_ord")
    cut = F.substring("doc_id", 1, F.instr("doc_id", ":") + F.lit(3))
    blocks = ordered_blocks(keys, ["doc_id", "chunk_ord"], cut)
    return blocks.groupBy("block").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")
    )


@query(
    "tagged_labels",
    """SELECT event_type, CASE event_type WHEN 'purchase' THEN 'confidential' WHEN 'click' THEN 'internal' WHEN 'signup' THEN 'internal' ELSE 'public' END AS label,
    count(*) AS n FROM events GROUP BY 1, 2""",
)
def tagged_labels(spark, d):
    kind = F.col("event_type")

    def tags(*names):
        return F.array(*[F.lit(n) for n in names])

    listed = (
        F.when(kind == "view", tags("O"))
        .when(kind == "click", tags("B-EMAIL", "O"))
        .when(kind == "purchase", tags("B-CREDITCARDNUMBER", "I-CREDITCARDNUMBER"))
        .when(kind == "signup", tags("B-FULLNAME", "B-EMAIL"))
        .otherwise(tags("I-PIN", "O"))
    )
    rows = t.table(spark, d, "events").select("event_type", label_from_tags(listed).alias("label"))
    return rows.groupBy("event_type", "label").agg(F.count(F.lit(1)).alias("n"))


_ROLES = t.sql_roles(t.sql_team("id"))


@query(
    "upsert_documents",
    t.with_tables(
        "text_evidence",
        """SELECT id, md5(i.title) AS title, i.label AS label,
        CASE WHEN s.id IS NULL THEN '' ELSE array_to_string(list_sort(s.allowed_roles), '+') END AS role_set FROM incoming i LEFT JOIN stored s USING (id)""",
        f"""incoming AS (SELECT doc_id AS id, title, {t.SQL_LABEL} AS label FROM text_evidence),
        stored0 AS (SELECT doc_id::VARCHAR AS id, 'old title' AS title, CASE WHEN toxic = 1 THEN 'confidential' ELSE 'internal' END AS label, 'text' AS modality FROM labels),
        stored AS (SELECT id, title, {_ROLES} AS allowed_roles FROM stored0)""",
    ),
)
def upsert_documents(spark, d):
    """Stored rows for labelled documents meet incoming rows for all documents."""
    stored = t.table(spark, d, "labels").select(
        F.col("doc_id").cast("string").alias("id"),
        F.lit("test").alias("source"),
        F.lit("old title").alias("title"),
        F.lit("text").alias("modality"),
        F.lit("en").alias("lang"),
        F.lit("old thread").alias("thread_id"),
        F.when(F.col("toxic") == 1, "confidential").otherwise("internal").alias("label"),
    )
    stored = grant_roles(stored, team_by_sha, "id")
    documents = t.text_documents(spark, d)
    labels = labelling.document_labels(labelling.label_chunks(documents))
    incoming = documents.join(labels, "doc_id").select(
        F.col("doc_id").alias("id"), F.lit("test").alias("source"), "title", F.lit("text").alias("modality"),
        "lang", F.lit("t").alias("thread_id"), "label",
    )
    merged = refresh_documents(stored, incoming)
    return merged.select(
        "id",
        F.md5("title").alias("title"),
        "label",
        role_set_key(F.col("allowed_roles")).alias("role_set"),
    )


_STAGED = """staged AS (SELECT vec_id AS id, list_transform(embedding::DOUBLE[], lambda x: -x) AS embedding FROM embeddings WHERE label >= 5
    UNION ALL SELECT vec_id + 1000000, embedding::DOUBLE[] FROM embeddings WHERE label = 9)"""


def staged_vectors(spark, d):
    """Sign-flipped vectors for half of the topics, and rows whose id is not stored."""
    rows = t.table(spark, d, "embeddings")
    flipped = F.transform("embedding", lambda x: -x)
    known = rows.filter(F.col("label") >= 5).select(F.col("vec_id").alias("id"), flipped.alias("embedding"))
    unknown = rows.filter(F.col("label") == 9).select((F.col("vec_id") + 1000000).alias("id"), "embedding")
    return known.unionByName(unknown)


def stored_vectors(spark, d):
    return t.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


@query(
    "vector_update",
    f"""WITH {_STAGED} SELECT e.vec_id AS id, round(coalesce(s.embedding, e.embedding::DOUBLE[])[1], 6) AS first_value
    FROM embeddings e LEFT JOIN staged s ON s.id = e.vec_id""",
)
def vector_update(spark, d):
    updated = update_vectors(stored_vectors(spark, d), staged_vectors(spark, d))
    first = F.get("embedding", 0).cast("double")
    return updated.select("id", F.round(first, 6).alias("first_value"))


@query(
    "staging_counts",
    f"WITH {_STAGED} SELECT count(*) AS staged, count(*) FILTER (id IN (SELECT vec_id FROM embeddings)) AS matched FROM staged",
)
def vector_staging(spark, d):
    return staging_counts(stored_vectors(spark, d), staged_vectors(spark, d))


@query(
    "resume_anti_join",
    "SELECT lang, count(*) AS n FROM documents ANTI JOIN labels USING (doc_id) GROUP BY lang",
)
def resume_anti_join(spark, d):
    todo = pending_rows(t.table(spark, d, "documents"), t.table(spark, d, "labels"), ["doc_id"])
    return todo.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query(
    "image_documents",
    """SELECT 'funsd:' || page_id AS id, 'funsd' AS source, 'FUNSD form ' || page_id AS title, 'image' AS modality,
    'funsd:' || page_id AS thread_id, 'internal' AS label, 'funsd:' || page_id || ':0' AS chunk_id FROM pages""",
)
def image_documents(spark, d):
    """Pages stand for scanned forms; only their ids matter here."""
    ids = t.table(spark, d, "pages").select(F.col("page_id").cast("string").alias("id"))
    documents, chunks = image_rows(ids)
    parts = chunks.select(F.col("doc_id").alias("id"), F.col("id").alias("chunk_id"))
    return documents.join(parts, "id")
