"""Vector checks, nearest neighbours, frozen queries and retrieval scores."""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from sievegate.catalog import tables as t
from sievegate.catalog.registry import registry
from sievegate.functions.text import encoder_input, informative_subject, passage_query
from sievegate.functions.vectors import cosine_distance, l2_norm, renormalize, truncate
from sievegate.operators.approximate import approximate_items, recall_against
from sievegate.operators.bootstrap import bootstrap_mean
from sievegate.operators.encode import encoder_column, hashed_vectors, mean_cosine, vector_report
from sievegate.operators.neighbors import document_ranking, nearest_items
from sievegate.operators.ranking import first_per_group
from sievegate.operators.ranking_metrics import METRICS, mean_scores, query_scores
from sievegate.plans import bench
from sievegate.session import cut_lineage
from sievegate.sources.files import content_digest

QUERIES, ORACLES, query = registry()

_NOISY = "list_transform(v, lambda x, i: (x + {noise} * ((chunk_id * 31 + (i - 1) * 17) % 11 - 5))::FLOAT::DOUBLE)"


@query(
    "vector_check",
    """SELECT count(*) AS n, count(*) FILTER (label = 2) AS missing, count(*) FILTER (label = 3) AS wrong_width,
    count(*) FILTER (label = 4) AS non_finite, count(*) FILTER (label NOT IN (2, 3, 4)) AS valid FROM embeddings""",
)
def vector_check(spark, d):
    """Vectors of three topics are spoilt: missing, one value short, one value not finite."""
    vector, topic = F.col("embedding"), F.col("topic")
    broken = F.concat(F.slice(vector, 1, t.DIM - 1), F.array(F.lit(math.nan).cast("float")))
    spoilt = F.when(topic == 3, F.slice(vector, 1, t.DIM - 1)).when(topic == 4, broken)
    rows = t.vector_items(spark, d).withColumn(
        "embedding", F.when(topic.isin(3, 4), spoilt).when(topic != 2, vector)
    )
    return vector_report(rows, "embedding", t.DIM)


@query(
    "truncate_renorm",
    t.with_tables(
        "items",
        """SELECT chunk_id, round(v[1] / n, 6)::DOUBLE AS first_value, round(v[32] / n, 6)::DOUBLE AS last_value, round(n, 6)::DOUBLE AS old_norm, 1.0::DOUBLE AS new_norm
        FROM (SELECT chunk_id, v, sqrt(list_sum(list_transform(v[1:32], lambda x: x * x))) AS n FROM items)""",
    ),
)
def truncate_renorm(spark, d):
    head = truncate(F.col("embedding"), 32)
    unit = t.vector_items(spark, d).select("chunk_id", head.alias("head"), renormalize(head).alias("unit"))
    return unit.select(
        "chunk_id",
        F.round(F.get("unit", 0), 6).alias("first_value"),
        F.round(F.get("unit", 31), 6).alias("last_value"),
        F.round(l2_norm(F.col("head")), 6).alias("old_norm"),
        F.round(l2_norm(F.col("unit")), 6).alias("new_norm"),
    )


@query(
    "cosine_pairs",
    t.with_tables(
        "items",
        f"SELECT chunk_id, round(1 - list_cosine_similarity(v, {_NOISY.format(noise=0.05)}), 6)::DOUBLE AS distance FROM items",
    ),
)
def cosine_pairs(spark, d):
    pairs = t.vector_items(spark, d).join(
        t.noisy_queries(spark, d, 0.05).withColumnRenamed("qid", "chunk_id"), "chunk_id"
    )
    return pairs.select(
        "chunk_id", F.round(cosine_distance(F.col("embedding"), F.col("vector")), 6).alias("distance")
    )


@query(
    "mean_cosine",
    t.with_tables(
        "items",
        f"SELECT count(*) AS pairs, round(avg(list_cosine_similarity(v, {_NOISY.format(noise=0.1)})), 6)::DOUBLE AS mean_cosine FROM items",
    ),
)
def encoding_similarity(spark, d):
    left = t.vector_items(spark, d).select(F.col("chunk_id").alias("qid"), F.col("embedding").alias("vector"))
    return mean_cosine(left, t.noisy_queries(spark, d, 0.1), ["qid"]).withColumn(
        "mean_cosine", F.round("mean_cosine", 6)
    )


def exact(spark, d, k: int):
    return nearest_items(
        t.vector_queries(spark, d), t.vector_items(spark, d), k, t.DIM, carry=["doc_id", "topic"]
    )


_RANKED = "ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY units, chunk_id) AS rank FROM pairs)"


@query(
    "knn_exact",
    t.with_tables("pairs", "SELECT qid, chunk_id, round(units / 1000000000.0, 6)::DOUBLE AS distance, rank FROM ranked WHERE rank <= 10", _RANKED),
)
def knn_exact(spark, d):
    return exact(spark, d, 10).select(
        "qid", "chunk_id", F.round("distance", 6).alias("distance"), F.col("rank").cast("bigint").alias("rank")
    )


@query(
    "knn_tiled",
    t.with_tables("pairs", "SELECT qid, chunk_id, round(units / 1000000000.0, 6)::DOUBLE AS distance, rank FROM ranked WHERE rank <= 10", _RANKED),
)
def knn_tiled(spark, d):
    """The same join with no room for a broadcast: both sides are cut into tiles."""
    hits = nearest_items(
        t.vector_queries(spark, d), t.vector_items(spark, d), 10, t.DIM,
        broadcast_bytes=0, tile_queries=400, tile_items=900,
    )
    return hits.select(
        "qid", "chunk_id", F.round("distance", 6).alias("distance"), F.col("rank").cast("bigint").alias("rank")
    )


_DOCS = f"""{_RANKED}, firsts AS (SELECT qid, doc_id, min(rank) AS chunk_rank FROM ranked WHERE rank <= 50 GROUP BY 1, 2),
    docs AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY chunk_rank) AS rank FROM firsts)"""


@query(
    "knn_doc_dedupe",
    t.with_tables("pairs", "SELECT qid, doc_id, chunk_rank, rank FROM docs WHERE rank <= 10", _DOCS),
)
def knn_doc_dedupe(spark, d):
    ranked = document_ranking(exact(spark, d, 50))
    return ranked.select(
        "qid", "doc_id", F.col("chunk_rank").cast("bigint").alias("chunk_rank"), F.col("rank").cast("bigint").alias("rank")
    )


def topic_scores(spark, d):
    """A document is relevant when the topic of its first chunk is the query's topic."""
    items = t.vector_items(spark, d)
    about = first_per_group(items.select("doc_id", "chunk_id", "topic"), ["doc_id"], ["chunk_id"])
    about = about.select("doc_id", F.col("topic").alias("doc_topic"))
    sizes = about.groupBy(F.col("doc_topic").alias("topic")).agg(F.count(F.lit(1)).alias("n_relevant"))
    queries = t.vector_queries(spark, d).select("qid", "topic").join(sizes, "topic", "left")
    queries = queries.withColumn("n_relevant", F.coalesce("n_relevant", F.lit(0)))
    ranked = document_ranking(exact(spark, d, 50))
    judged = (
        ranked.join(about, "doc_id")
        .join(queries.select("qid", "topic"), "qid")
        .withColumn("relevant", F.col("doc_topic") == F.col("topic"))
    )
    return query_scores(judged, queries, 10)


_SCORES = f"""{_DOCS}, about AS (SELECT doc_id, arg_min(topic, chunk_id) AS doc_topic FROM items GROUP BY doc_id),
    asked AS (SELECT chunk_id AS qid, topic, (SELECT count(*) FROM about a WHERE a.doc_topic = items.topic) AS n_relevant FROM items),
    gains AS (SELECT qid, count(*) AS n, min(rank) AS first, sum(1 / log2(rank + 1)) AS gain
              FROM docs JOIN about USING (doc_id) JOIN asked USING (qid) WHERE rank <= 10 AND doc_topic = topic GROUP BY qid),
    scores AS (SELECT qid, CASE WHEN n_relevant > 0 THEN coalesce(n / n_relevant, 0) ELSE 0 END::DOUBLE AS recall,
               CASE WHEN n_relevant > 0 THEN coalesce(1 / first, 0) ELSE 0 END::DOUBLE AS mrr,
               CASE WHEN n_relevant > 0 THEN coalesce(gain / list_sum(list_transform(range(1, least(n_relevant, 10)::INT + 1), lambda i: 1 / log2(i + 1))), 0) ELSE 0 END::DOUBLE AS ndcg
               FROM asked LEFT JOIN gains USING (qid))"""


@query(
    "recall_mrr_ndcg",
    t.with_tables("pairs", "SELECT qid, round(recall, 6) AS recall, round(mrr, 6) AS mrr, round(ndcg, 6) AS ndcg FROM scores", _SCORES),
)
def recall_mrr_ndcg(spark, d):
    return topic_scores(spark, d).select("qid", *[F.round(m, 6).alias(m) for m in METRICS])


@query(
    "retrieval_means",
    t.with_tables(
        "pairs",
        "SELECT count(*) AS queries, round(avg(recall), 4) AS recall, round(avg(mrr), 4) AS mrr, round(avg(ndcg), 4) AS ndcg FROM scores",
        _SCORES,
    ),
)
def retrieval_means(spark, d):
    return mean_scores(topic_scores(spark, d))


@query("bootstrap_ci")
def bootstrap_ci(spark, d):
    return bootstrap_mean(topic_scores(spark, d), [], "mrr")


# A sweep over widths: 64 stands for the full width.
SWEEP = (
    bench.Variant("baseline"),
    bench.Variant("dim32", 0.5),
    bench.Variant("dim16", 0.25),
    bench.Variant("no-renorm", 0.25, renorm=False),
    bench.Variant("query-mismatch", queries="plain"),
)
HALF_SWEEP = (bench.Variant("half", half=True), bench.Variant("half-dim16", 0.25, half=True))


def sweep(spark, d, variants):
    queries = {"prompted": t.noisy_queries(spark, d, 0.05), "plain": t.noisy_queries(spark, d, 0.1)}
    return bench.sweep_scores(variants, queries, t.vector_items(spark, d), t.DIM)


@query(
    "variant_sweep",
    t.with_tables(
        "items",
        """SELECT config, count(*) AS queries, round(avg(CASE WHEN rank IS NULL THEN 0 ELSE 1 END), 4)::DOUBLE AS recall,
        round(avg(coalesce(1 / rank, 0)), 4)::DOUBLE AS mrr, round(avg(coalesce(1 / log2(rank + 1), 0)), 4)::DOUBLE AS ndcg
        FROM configs JOIN LATERAL (SELECT chunk_id AS qid, doc_id AS relevant_doc FROM items) q ON true
        LEFT JOIN sdocs USING (config, qid, relevant_doc) GROUP BY config""",
        f"""configs AS (SELECT * FROM (VALUES ('baseline', 64, 0), ('dim32', 32, 0), ('dim16', 16, 0), ('no-renorm', 16, 0), ('query-mismatch', 64, 1)) AS c(config, dim, plain)),
        noisy AS (SELECT chunk_id AS qid, 0 AS plain, {_NOISY.format(noise=0.05)} AS v FROM items UNION ALL SELECT chunk_id, 1, {_NOISY.format(noise=0.1)} FROM items),
        spairs AS (SELECT config, qid, i.chunk_id, i.doc_id, round((1 - list_cosine_similarity(q.v[1:dim], i.v[1:dim])) * 1000000000)::BIGINT AS units
                   FROM configs JOIN noisy q USING (plain), items i),
        sranked AS (SELECT *, row_number() OVER (PARTITION BY config, qid ORDER BY units, chunk_id) AS rank FROM spairs),
        sfirst AS (SELECT config, qid, doc_id AS relevant_doc, min(rank) AS chunk_rank FROM sranked WHERE rank <= 50 GROUP BY 1, 2, 3),
        sdocs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY config, qid ORDER BY chunk_rank) AS rank FROM sfirst) WHERE rank <= 10)""",
    ),
)
def variant_sweep(spark, d):
    return mean_scores(sweep(spark, d, SWEEP), ["config"])


@query("half_precision_sweep")
def half_precision_sweep(spark, d):
    return bench.sweep_summary(sweep(spark, d, HALF_SWEEP))


@query(
    "variant_sizes",
    """SELECT config, (SELECT count(*) FROM embeddings) AS "rows", (SELECT count(*) FROM embeddings) * width AS bytes
    FROM (VALUES ('baseline', 256), ('dim32', 128), ('dim16', 64), ('no-renorm', 64), ('query-mismatch', 256), ('half', 128), ('half-dim16', 32)) AS c(config, width)""",
)
def variant_sizes(spark, d):
    items = t.vector_items(spark, d)
    parts = [bench.variant_size(v, items, t.DIM) for v in (*SWEEP, *HALF_SWEEP)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "lang_retrieval",
    t.with_tables(
        "pairs",
        """SELECT lang, count(*) AS queries, round(avg(recall), 4) AS recall, round(avg(mrr), 4) AS mrr, round(avg(ndcg), 4) AS ndcg
        FROM scores LEFT JOIN documents ON documents.doc_id = scores.qid GROUP BY lang""",
        _SCORES,
    ),
)
def lang_retrieval(spark, d):
    """Scores grouped by the language of the document with the query's number, null where there is none."""
    langs = t.table(spark, d, "documents").select(F.col("doc_id").alias("qid"), "lang")
    return mean_scores(topic_scores(spark, d).join(langs, "qid", "left"), ["lang"])


@query("lsh_knn")
def lsh_knn(spark, d):
    """Neighbours from the inverted file, with a share of misses to expect."""
    return approximate_items(t.vector_queries(spark, d), t.vector_items(spark, d), 10, t.DIM)


@query("lsh_recall", "SELECT count(*) AS queries, true AS nine_of_ten FROM embeddings")
def lsh_recall(spark, d):
    """Whether the inverted file finds at least nine of ten exact neighbours."""
    recall = recall_against(lsh_knn(spark, d), exact(spark, d, 10))
    return recall.agg(F.count(F.lit(1)).alias("queries"), (F.avg("recall") >= 0.9).alias("nine_of_ten"))


@query(
    "certified_knn",
    t.with_tables("pairs", "SELECT qid, chunk_id, round(units / 1000000000.0, 6)::DOUBLE AS distance, rank, true AS certified FROM ranked WHERE rank <= 10", _RANKED),
)
def certified_knn(spark, d):
    """The inverted file searched until no cell can hold anything nearer."""
    found = approximate_items(t.vector_queries(spark, d), t.vector_items(spark, d), 10, t.DIM, miss=0)
    return found.select(
        "qid", "chunk_id", F.round("distance", 6).alias("distance"), F.col("rank").cast("bigint").alias("rank"), "certified"
    )


def word_counter():
    """A stand-in encoder: words of a text counted in 16 slots by the md5 of the word."""

    def encode(texts):
        matrix = np.zeros((len(texts), 16))
        for row, text in zip(matrix, texts, strict=True):
            for word in text.split(" "):
                row[int(hashlib.md5(word.encode()).hexdigest()[0], 16)] += 1
        return matrix

    return encode


@query(
    "embedding_batches",
    """WITH words AS (SELECT conv_id, turn, ('0x' || substr(md5(w), 1, 1))::INT AS slot FROM (
        SELECT conv_id, turn, unnest(string_split(role || chr(10) || text, ' ')) AS w FROM conversations)),
    counts AS (SELECT conv_id, turn, slot, count(*) AS n FROM words GROUP BY 1, 2, 3)
    SELECT conv_id, turn, slot, round((n / sqrt(sum(n * n) OVER (PARTITION BY conv_id, turn)))::FLOAT::DOUBLE, 5) AS value FROM counts""",
)
def embedding_batches(spark, d):
    turns = t.table(spark, d, "conversations")
    vector = encoder_column(encoder_input(F.col("role"), F.col("text")), word_counter, 16)
    slots = turns.select("conv_id", "turn", F.posexplode_outer(vector).alias("slot", "value"))
    return slots.filter(F.col("value") != 0).select(
        "conv_id", "turn", "slot", F.round(F.col("value").cast("double"), 5).alias("value")
    )


@query("hashed_embedding", t.with_tables("corpus", "SELECT doc_id, chunk_ord, 256 AS dim, 1.0::DOUBLE AS norm FROM corpus"))
def hashed_embedding(spark, d):
    chunks = t.corpus(spark, d).withColumn("_in", encoder_input(F.col("title"), F.col("text")))
    vectors = hashed_vectors(chunks, "_in", 256)
    return vectors.select(
        "doc_id", "chunk_ord", F.size("vector").alias("dim"), F.round(l2_norm(F.col("vector")), 4).alias("norm")
    )


@query("text_retrieval")
def text_retrieval(spark, d):
    """Subjects and passages of all held-out documents against all chunks, hashed vectors."""
    chunks = t.stored_corpus(spark, d)
    queries = cut_lineage(frozen(chunks, None))
    asked = hashed_vectors(queries, "text", 256)
    items = hashed_vectors(
        chunks.withColumn("_in", encoder_input(F.col("title"), F.col("text"))), "_in", 256
    ).select(
        F.concat_ws(":", "doc_id", "chunk_ord").alias("chunk_id"), "doc_id", F.col("vector").alias("embedding")
    )
    hits = document_ranking(nearest_items(asked, items, 50, 256, carry=["doc_id"]))
    judged = hits.join(queries, "qid").withColumn("relevant", F.col("doc_id") == F.col("relevant_doc"))
    scores = query_scores(judged, queries.withColumn("n_relevant", F.lit(1)))
    return mean_scores(scores.join(queries.select("qid", "kind"), "qid"), ["kind"])


def corpus_documents(corpus):
    return corpus.groupBy("doc_id").agg(F.min("title").alias("title"), F.lit("text").alias("modality"))


def frozen(corpus, per_kind=bench.PER_KIND):
    chunks = corpus.withColumnRenamed("chunk_ord", "ord")
    return bench.freeze_queries(corpus_documents(corpus), chunks, per_kind)


_STRIPPED = t.sql_strip("title")
_INFORMATIVE = f"(length({_STRIPPED}) >= 15 AND NOT regexp_matches(lower({_STRIPPED}), '^(re:|fw:|fwd:)'))"
_PASSAGE = """CASE WHEN strpos(substr(text, 1, 500), ' ') > 1 AND strpos(substr(text, 1, 500), ' ') < length(substr(text, 1, 500))
    THEN substr(substr(text, 1, 500), strpos(substr(text, 1, 500), ' ') + 1) ELSE substr(text, 1, 500) END"""


@query(
    "informative_subjects",
    t.with_tables("uniq", f"SELECT doc_id, {_INFORMATIVE} AS informative FROM uniq"),
)
def informative_subjects(spark, d):
    return corpus_documents(t.corpus(spark, d)).select("doc_id", informative_subject(F.col("title")).alias("informative"))


@query(
    "chunk_query_text",
    t.with_tables("corpus", f"SELECT doc_id, chunk_ord, md5({_PASSAGE}) AS digest FROM corpus WHERE chunk_ord > 0 AND char_len >= 100"),
)
def chunk_query_text(spark, d):
    later = t.corpus(spark, d).filter((F.col("chunk_ord") > 0) & (F.col("char_len") >= 100))
    return later.select("doc_id", "chunk_ord", F.md5(passage_query(F.col("text"))).alias("digest"))


@query(
    "frozen_queries",
    t.with_tables(
        "corpus",
        f"""SELECT printf('subj-%03d', row_number() OVER (ORDER BY doc_id) - 1) AS qid, 'subject' AS kind, md5({_STRIPPED}) AS digest, doc_id AS relevant_doc
        FROM (SELECT * FROM (SELECT DISTINCT doc_id, title FROM corpus WHERE starts_with(doc_id, 'test:')) WHERE {_INFORMATIVE} ORDER BY doc_id LIMIT 150)
        UNION ALL
        SELECT printf('chunk-%03d', row_number() OVER (ORDER BY doc_id) - 1), 'chunk', md5({_PASSAGE}), doc_id
        FROM (SELECT doc_id, arg_min(text, chunk_ord) AS text FROM corpus WHERE starts_with(doc_id, 'test:') AND chunk_ord > 0 AND char_len >= 100
              GROUP BY doc_id ORDER BY doc_id LIMIT 150)""",
    ),
)
def frozen_queries(spark, d):
    return frozen(t.stored_corpus(spark, d)).select("qid", "kind", F.md5("text").alias("digest"), "relevant_doc")


@query("frozen_digest")
def frozen_digest(spark, d):
    return content_digest(frozen(t.stored_corpus(spark, d)))
