"""Permission-filtered search over batches of (user, query) requests.

What a user may see depends only on a document's signature (label and role set). The
nearest items are therefore found once per query and signature, and each request merges
the signatures its user may read: the k best of a union are among the k best of its parts,
so this equals filtering first, without repeating distance work per user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievegate.functions.acl import EVERYONE, is_visible, may_read, signature
from sievegate.functions.text import snippet
from sievegate.operators.neighbors import nearest_items
from sievegate.operators.ranking import top_k_per_group


class AccessViolation(RuntimeError):
    """A result contains a document its reader may not see."""


def unknown_users(requests: DataFrame, users: DataFrame) -> DataFrame:
    """Requests naming a user that does not exist (names are case-sensitive)."""
    return requests.join(users.select("user"), "user", "left_anti")


def named_users(requests: DataFrame, users: DataFrame) -> DataFrame:
    """Requests of known users under their stored name; case and outer blanks do not matter."""
    known = users.select(F.col("user").alias("_stored"), F.lower(F.trim("user")).alias("_loose"))
    found = requests.withColumn("_loose", F.lower(F.trim("user"))).join(known, "_loose")
    return found.withColumn("user", F.col("_stored")).drop("_stored", "_loose")


def signatures(documents: DataFrame) -> DataFrame:
    """Distinct ``acl, label, allowed_roles`` that at least one role can see."""
    return (
        documents.filter(F.size("allowed_roles") > 0)
        .select(
            signature(F.col("label"), F.col("allowed_roles")).alias("acl"),
            "label",
            F.array_sort(F.array_distinct(F.array_compact("allowed_roles"))).alias("allowed_roles"),
        )
        .distinct()
    )


def readable_signatures(users: DataFrame, acls: DataFrame) -> DataFrame:
    """``user, acl`` pairs: an equi-join on single roles instead of testing every pair."""
    held = users.select("user", F.explode("roles").alias("role")).distinct()
    granted = acls.select("acl", "label", F.explode("allowed_roles").alias("role"))
    counts = (F.col("label") != "confidential") | (F.col("role") != EVERYONE)
    return held.join(granted.filter(counts), "role").select("user", "acl").distinct()


def with_signature(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunks of documents somebody can see, with the document's signature.

    The item table should be stored with this column; then searches skip the join.
    """
    acl = documents.filter(F.size("allowed_roles") > 0).select(
        "doc_id", signature(F.col("label"), F.col("allowed_roles")).alias("acl")
    )
    return chunks.join(acl, "doc_id")


def permitted_hits(
    requests: DataFrame,
    queries: DataFrame,
    items: DataFrame,
    documents: DataFrame,
    users: DataFrame,
    k: int,
    dim: int,
) -> DataFrame:
    """``user, qid, chunk_id, doc_id, distance, rank`` for every request ``user, qid``.

    ``items`` carry ``chunk_id, doc_id, embedding, acl``.
    """
    readable = readable_signatures(users, signatures(documents))
    asked = requests.select("user", "qid").distinct()
    wanted = readable.join(asked.select("user").distinct(), "user", "left_semi")
    visible = items.join(wanted.select("acl").distinct(), "acl", "left_semi")
    per_acl = nearest_items(
        queries.join(asked.select("qid").distinct(), "qid", "left_semi"),
        visible, k, dim, carry=["doc_id"], group="acl",
    )
    # Hits are k for each query and signature. The planner takes them for about as many as the items
    # and would send them all to the driver for a broadcast.
    merged = asked.join(wanted, "user").join(per_acl.drop("rank").hint("merge"), ["qid", "acl"]).drop("acl")
    return top_k_per_group(merged, ["user", "qid"], [F.col("distance"), F.col("chunk_id")], k)


def hit_rows(hits: DataFrame, chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Hits with title, text, snippet, modality, label and score; texts join only now."""
    texts = chunks.select("chunk_id", "text", snippet(F.col("text")).alias("snippet"))
    shown = documents.select("doc_id", "title", "modality", "label")
    return (
        hits.join(texts, "chunk_id")
        .join(shown, "doc_id")
        .withColumn("score", F.lit(1.0) - F.col("distance"))
    )


def recheck(hits: DataFrame, documents: DataFrame, users: DataFrame) -> DataFrame:
    """Hits with ``visible`` decided again from the source tables; no document is invisible."""
    granted = documents.select(
        "doc_id", F.col("label").alias("_label"), F.col("allowed_roles").alias("_allowed")
    )
    return (
        hits.join(granted, "doc_id", "left")
        .join(users.select("user", F.col("roles").alias("_roles")), "user", "left")
        .withColumn(
            "visible",
            F.coalesce(is_visible(F.col("_label"), F.col("_allowed"), F.col("_roles")), F.lit(False)),
        )
        .drop("_label", "_allowed", "_roles")
    )


def enforce(rechecked: DataFrame) -> DataFrame:
    """The hits themselves; the job fails as soon as one of them is not visible."""
    message = F.concat(F.lit("access re-check failed: "), F.col("user"), F.lit(" "), F.col("doc_id"))
    return rechecked.filter(
        F.when(F.col("visible"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    )


def visible_documents(documents: DataFrame, users: DataFrame) -> DataFrame:
    """``user, doc_id`` for everything each user may read, through the signatures."""
    acl = signature(F.col("label"), F.col("allowed_roles"))
    readable = readable_signatures(users, signatures(documents))
    return documents.withColumn("acl", acl).join(readable, "acl").select("user", "doc_id")


def fetch_documents(requests: DataFrame, documents: DataFrame, users: DataFrame) -> DataFrame:
    """Requests ``user, doc_id`` with ``found`` and, only then, title, label and modality.

    A missing document and a forbidden one give the same answer.
    """
    body = documents.select("doc_id", "title", "label", "modality", "allowed_roles")
    joined = requests.join(body, "doc_id", "left").join(users, "user", "left")
    found = F.coalesce(
        may_read(F.col("label"), F.col("allowed_roles"), F.col("roles")), F.lit(False)
    )
    joined = joined.withColumn("found", found)
    shown = [F.when(F.col("found"), F.col(c)).alias(c) for c in ("title", "label", "modality")]
    return joined.select("user", "doc_id", "found", *shown)


def answer_context(rows: DataFrame, passage_chars: int = 1500, passage: str = "text") -> DataFrame:
    """Per (user, qid): passages and citations of its at most k hits, in rank order."""
    entry = F.struct(
        "rank", F.substring(F.col(passage), 1, passage_chars).alias("passage"), "doc_id", "chunk_id", "title"
    )
    gathered = rows.groupBy("user", "qid").agg(F.array_sort(F.collect_list(entry)).alias("_hits"))
    return gathered.select(
        "user",
        "qid",
        F.transform("_hits", lambda h: h["passage"]).alias("passages"),
        F.transform(
            "_hits",
            lambda h: F.struct(
                h["doc_id"].alias("doc_id"), h["chunk_id"].alias("chunk_id"), h["title"].alias("title")
            ),
        ).alias("citations"),
    )
