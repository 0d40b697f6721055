"""Sources and sinks: every query writes whole tables through a sink and reads them back.

Output goes to fresh folders below the shared folder; what a query returns comes from the files.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sievegate import schemas
from sievegate.catalog import tables as t
from sievegate.catalog.metric_queries import _train_parts
from sievegate.catalog.registry import registry
from sievegate.catalog.split_queries import _MANIFEST, manifest, verdicts
from sievegate.catalog.vector_queries import ORACLES as FROZEN
from sievegate.catalog.vector_queries import frozen
from sievegate.functions.vectors import label_values
from sievegate.operators import linear_model, trainset
from sievegate.operators.labelling import label_chunks, label_distribution
from sievegate.plans import index, labels, prep
from sievegate.plans.classify import compare
from sievegate.session import scratch_path
from sievegate.sources import buckets, files

QUERIES, ORACLES, query = registry()


def _messages_in_files(spark, d, out):
    """Messages stored the way raw splits arrive, one ``<split>-*.parquet`` each."""
    messages = t.raw_messages(spark, d)
    for split in files.RAW_SPLITS:
        part = messages.filter(F.col("split") == split).drop("split")
        part.write.mode("overwrite").parquet(f"{out}/{split}-00000-of-00001.parquet")


@query(
    "raw_split_files",
    t.with_tables("raw_messages", "SELECT split, md5(email_body) AS body, md5(subject_line) AS subject FROM raw_messages"),
)
def raw_split_files(spark, d):
    """All splits in one scan; the split is read from the name of the file."""
    out = scratch_path(spark, "raw")
    _messages_in_files(spark, d, out)
    raw = files.read_raw_splits(spark, out)
    return raw.select("split", F.md5("email_body").alias("body"), F.md5("subject_line").alias("subject"))


def _corpus_files(spark, d):
    out = scratch_path(spark, "corpus")
    stored = files.write_table(t.corpus(spark, d), out, schemas.CORPUS, sort_by=("doc_id", "chunk_ord"))
    return out, stored


@query(
    "corpus_files",
    t.with_tables("corpus", "SELECT doc_id, thread_id, split, md5(title) AS title, chunk_ord, md5(text) AS digest, char_len FROM corpus"),
)
def corpus_files(spark, d):
    _, stored = _corpus_files(spark, d)
    return stored.withColumns({"title": F.md5("title"), "digest": F.md5("text")}).drop("text")


@query(
    "corpus_file_order",
    t.with_tables("corpus", 'SELECT count(*) AS "rows", 0::BIGINT AS out_of_order, 0::BIGINT AS overlapping_files FROM corpus'),
)
def corpus_file_order(spark, d):
    """Whether rows are sorted inside the stored files and no two files share a range of keys."""
    out, _ = _corpus_files(spark, d)
    return files.order_report(spark, out, ("doc_id", "chunk_ord"))


@query(
    "corpus_key_lookup",
    t.with_tables(
        "corpus",
        """SELECT doc_id, chunk_ord, md5(text) AS digest, true AS fewer_files FROM corpus
        WHERE doc_id IN (SELECT min(doc_id) FROM corpus GROUP BY split)""",
    ),
)
def corpus_key_lookup(spark, d):
    """The first document of every split, found through the key ranges of the stored files."""
    out = scratch_path(spark, "corpus")
    stored = files.write_table(t.corpus(spark, d), out, schemas.CORPUS, sort_by=("doc_id", "chunk_ord"), n_files=16)
    wanted = stored.groupBy("split").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    named, n_files = files.files_with_keys(spark, out, wanted)
    few = F.lit(len(named) < n_files)
    return files.read_keys(spark, out, schemas.CORPUS, wanted).select("doc_id", "chunk_ord", F.md5("text").alias("digest"), few.alias("fewer_files"))


@query(
    "encoder_row_scan",
    t.with_tables("corpus", "SELECT doc_id, chunk_ord, md5(title || chr(10) || text) AS digest FROM corpus"),
)
def encoder_row_scan(spark, d):
    out, _ = _corpus_files(spark, d)
    return files.read_encoder_rows(spark, out).select(
        "doc_id", "chunk_ord", F.md5(F.concat("title", F.lit("\n"), "text")).alias("digest")
    )


@query(
    "label_files",
    t.with_tables(
        "corpus_labels",
        "SELECT doc_id, chunk_ord, label, array_to_string(pii, ',') AS pii, array_to_string(rules, ',') AS rules FROM corpus_labels",
    ),
)
def label_files(spark, d):
    stored = files.write_table(label_chunks(t.corpus(spark, d)), scratch_path(spark, "labels"), schemas.WEAK_LABELS)
    return stored.withColumns({"pii": F.array_join("pii", ","), "rules": F.array_join("rules", ",")})


@query(
    "image_files",
    """SELECT 'funsd:' || page_id AS doc_id, 'funsd:' || page_id || ':0' AS chunk_id, 0 AS ord, '' AS text,
    octet_length(encode(html))::BIGINT AS n_bytes, md5(html) AS digest FROM pages""",
)
def image_files(spark, d):
    """Pages stored as the bytes of a nested image field next to a column nobody asks for."""
    out = scratch_path(spark, "images")
    pages = t.table(spark, d, "pages").select(
        F.col("page_id").alias("id"), F.struct(F.encode("html", "UTF-8").alias("bytes"), F.col("url").alias("path")).alias("image")
    )
    pages.write.parquet(out)
    images = files.read_images(spark, out)
    _, chunks = files.image_rows(images.select("id"))
    sizes = images.select(
        F.concat(F.lit(f"{files.IMAGE_SOURCE}:"), "id").alias("doc_id"),
        F.octet_length("bytes").cast("bigint").alias("n_bytes"), F.md5("bytes").alias("digest"),
    )
    return chunks.withColumnRenamed("id", "chunk_id").join(sizes, "doc_id")


def _vector_rows(spark, d):
    return t.vector_items(spark, d).select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("chunk_id").cast("int").alias("chunk_ord"),
        F.col("embedding").cast("array<float>").alias("vector"), (F.col("doc_id") % 7).cast("int").alias("block"),
    )


@query(
    "vector_block_files",
    f"""SELECT form, (vec_id // 4)::VARCHAR AS doc_id, vec_id::INT AS chunk_ord, embedding[1]::DOUBLE AS first_value,
    embedding[{t.DIM}]::DOUBLE AS last_value FROM embeddings, (VALUES ('parquet'), ('json')) AS f(form)""",
)
def vector_block_files(spark, d):
    """Blocks written twice, so the second run has to replace the first; read in both forms."""
    out = scratch_path(spark, "blocks")
    rows = _vector_rows(spark, d)
    for _ in range(2):
        files.write_vector_blocks(rows, f"{out}/parquet", t.DIM)
    rows.drop("block").write.json(f"{out}/json")
    forms = [
        files.read_vector_blocks(spark, f"{out}/{form}", t.DIM, form).select(
            F.lit(form).alias("form"), "doc_id", "chunk_ord", F.get("vector", 0).cast("double").alias("first_value"),
            F.get("vector", t.DIM - 1).cast("double").alias("last_value"),
        )
        for form in ("parquet", "json")
    ]
    return forms[0].unionByName(forms[1])


@query(
    "grown_vectors",
    t.with_tables(
        "corpus",
        """SELECT 0::BIGINT AS only_left, 0::BIGINT AS only_right, count(*) AS shared, count(*) FILTER (split = 'train') AS first_added,
        count(*) FILTER (split <> 'train') AS second_added, 0::BIGINT AS third_added FROM corpus""",
    ),
)
def grown_vectors(spark, d):
    """Vectors of the train split, then of the whole corpus, then once more: each run adds what is missing."""
    out = scratch_path(spark, "grown")
    whole = files.write_table(t.corpus(spark, d), f"{out}/whole", schemas.CORPUS)
    files.write_table(whole.filter(F.col("split") == "train"), f"{out}/train", schemas.CORPUS)
    added = [
        index.run_embed(spark, f"{out}/{corpus}", f"{out}/vectors", 16, n_blocks=4)["added"]
        for corpus in ("train", "whole", "whole")
    ]
    found = trainset.key_differences(whole, files.read_vector_blocks(spark, f"{out}/vectors", 16))
    names = ("first_added", "second_added", "third_added")
    return found.select("*", *[F.lit(n).cast("bigint").alias(name) for name, n in zip(names, added, strict=True)])


_GOLD = """gold AS (SELECT e.*, CASE WHEN toxic = 1 THEN 'confidential' WHEN quality = 1 THEN 'public' ELSE 'internal' END AS gold_label,
    CASE WHEN quality = 1 THEN 'looks clean' ELSE ' ' END AS note FROM text_evidence e JOIN labels l ON e.doc_id = l.doc_id::VARCHAR)"""


def _reviewed(spark, d):
    """Labelled documents as reviewed rows with their rule label."""
    texts = t.text_documents(spark, d).select("doc_id", "chunk_ord", "title", "text")
    weak = label_chunks(texts).select(
        "doc_id", "chunk_ord", F.col("label").alias("weak_label"), F.col("pii").alias("weak_pii")
    )
    keys = ["doc_id", "chunk_ord"]
    return texts.join(verdicts(spark, d), keys).join(weak, keys).select(*schemas.GOLD.fieldNames())


@query(
    "gold_files",
    t.with_tables(
        "text_evidence",
        f"""SELECT doc_id, md5(text) AS digest, md5(title) AS title, {t.SQL_LABEL} AS weak_label,
        array_to_string({t.SQL_PII}, ',') AS weak_pii, gold_label, note FROM gold""",
        _GOLD,
    ),
)
def gold_files(spark, d):
    out = scratch_path(spark, "gold")
    files.write_rows(_reviewed(spark, d), out)
    return files.read_gold(spark, out).select(
        "doc_id", F.md5("text").alias("digest"), F.md5("title").alias("title"), "weak_label",
        F.array_join("weak_pii", ",").alias("weak_pii"), "gold_label", "note",
    )


@query(
    "eval_files",
    t.with_tables(
        "text_evidence",
        """SELECT doc_id, md5(title) AS title, md5(text) AS digest, gold_label AS gold,
        CASE WHEN doc_id::BIGINT % 5 = 0 THEN 'test' ELSE 'dev' END AS split, CASE WHEN doc_id::BIGINT % 5 = 0 THEN 'test' ELSE 'dev' END AS tag FROM gold""",
        _GOLD,
    ),
)
def eval_files(spark, d):
    """Half of the rows spell the gold field one way, half the other; tags are read on their own."""
    out = scratch_path(spark, "eval")
    number = F.col("doc_id").cast("bigint")
    rows = _reviewed(spark, d).withColumn("split", F.when(number % 5 == 0, "test").otherwise("dev"))
    odd = number % 2 == 1
    rows = rows.withColumn("gold", F.when(odd, F.col("gold_label"))).withColumn("gold_label", F.when(~odd, F.col("gold_label")))
    files.write_rows(rows, out)
    tags = files.read_split_tags(spark, out).withColumnRenamed("split", "tag")
    return files.read_eval_rows(spark, out).join(tags, ["doc_id", "chunk_ord"]).select(
        "doc_id", F.md5("title").alias("title"), F.md5("text").alias("digest"), "gold", "split", "tag"
    )


@query("manifest_files", t.with_tables("turns", "SELECT doc_id, split FROM manifest", _MANIFEST))
def manifest_files(spark, d):
    out = scratch_path(spark, "manifest")
    files.write_manifest(manifest(spark, d), out)
    return files.read_manifest(spark, out)


@query(
    "manifest_order",
    t.with_tables("turns", 'SELECT split, count(*) AS "rows", 0::BIGINT AS out_of_order, 0::BIGINT AS overlapping_files FROM manifest GROUP BY split', _MANIFEST),
)
def manifest_order(spark, d):
    """Whether ids are sorted inside the stored files."""
    out = scratch_path(spark, "manifest")
    files.write_manifest(manifest(spark, d), out)
    return files.order_report(spark, out, ("value",), form="text", by=("split",))


def _prediction_files(spark, d):
    """One run in lines for each method, and an older run of one that has to give way."""
    out = scratch_path(spark, "predictions")
    rows = t.predictions(spark, d)
    for run, method in (("b", "rules"), ("b2", "shifted")):
        files.write_predictions(rows.filter(F.col("method") == method), out, run)
    files.write_predictions(rows.filter(F.col("method") == "rules").withColumn("pred", F.lit("public")), out, "a")
    return out


@query(
    "prediction_files",
    t.with_tables("predictions", "SELECT method, doc_id, chunk_ord, gold, pred, round(sure, 6)::DOUBLE AS confidence, latency_ms::DOUBLE AS latency_ms FROM predictions"),
)
def prediction_files(spark, d):
    found = files.read_predictions(spark, _prediction_files(spark, d))
    top = F.array_max(label_values(F.col("probs")))
    return found.select("method", "doc_id", "chunk_ord", "gold", "pred", F.round(top, 6).alias("confidence"), "latency_ms")


@query(
    "comparison_files",
    t.with_tables(
        "predictions",
        """SELECT method, subset, count(*) AS n, round(avg((gold = pred)::INT), 6)::DOUBLE AS accuracy FROM (
        SELECT method, 'all' AS subset, gold, pred FROM predictions
        UNION ALL SELECT method, 'test', gold, pred FROM predictions WHERE key % 5 = 0) GROUP BY 1, 2""",
    ),
)
def comparison_files(spark, d):
    """The stored comparison of the runs, over all rows and over those tagged as test."""
    out = scratch_path(spark, "comparison")
    number = F.col("doc_id").cast("bigint")
    tags = t.predictions(spark, d).filter(F.col("method") == "rules").select(
        "doc_id", "chunk_ord", "gold", F.when(number % 5 == 0, "test").otherwise("dev").alias("split")
    )
    files.write_rows(tags, f"{out}/eval")
    compare(spark, _prediction_files(spark, d), f"{out}/eval").write.parquet(f"{out}/summary")
    return spark.read.parquet(f"{out}/summary").select("method", "subset", "n", F.round("accuracy", 6).alias("accuracy"))


@query(
    "tagged_text_files",
    """SELECT md5(text) AS digest, CASE role WHEN 'user' THEN 'internal' WHEN 'assistant' THEN 'confidential' ELSE 'public' END AS label
    FROM conversations WHERE text <> ''""",
)
def tagged_text_files(spark, d):
    """Turns as filled templates in a CSV, with a tag list that follows from the role."""
    out = scratch_path(spark, "tagged")
    tags = F.when(F.col("role") == "user", "['B-EMAIL', 'O']").when(F.col("role") == "assistant", "['O', 'B-CREDITCARDNUMBER']")
    rows = t.table(spark, d, "conversations").select(
        F.col("text").alias("Filled Template"), tags.otherwise("['O']").alias("Tokens")
    )
    rows.write.csv(
        out, header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return files.read_tagged_texts(spark, out).select(F.md5("text").alias("digest"), "label")


_STATS = r"""(SELECT count(*) AS n, count(DISTINCT cleaned) AS e, count(DISTINCT lower(regexp_replace(cleaned, '[\s\x0b]+', ' ', 'g'))) AS m FROM cleaned)"""


@query(
    "prep_statistics",
    t.with_tables(
        "corpus",
        f"""SELECT (SELECT count(*) FROM raw_messages) AS raw_rows, n AS cleaned_rows, e AS after_exact, m AS after_normalized,
        n - e AS exact_removed, e - m AS normalized_removed, (SELECT count(*) FROM corpus) AS chunk_rows FROM {_STATS}""",
    ),
)
def prep_statistics(spark, d):
    """What the preparation job writes about its run."""
    out = scratch_path(spark, "prep")
    _messages_in_files(spark, d, f"{out}/raw")
    prep.run(spark, f"{out}/raw", f"{out}/corpus")
    names = ("raw_rows", "cleaned_rows", "after_exact", "after_normalized", "exact_removed", "normalized_removed", "chunk_rows")
    return spark.read.json(f"{out}/corpus-stats").select(*names)


@query(
    "capped_prep",
    t.with_tables(
        "cleaned",
        f"SELECT (SELECT count(*) FROM raw_messages) AS raw_rows, n AS cleaned_rows, m AS after_normalized FROM {_STATS}",
    ).replace(
        t.SQL["raw_messages"], t.SQL["raw_messages"].removesuffix(")") + " ORDER BY email_body, subject_line, split LIMIT 100)"
    ),
)
def capped_prep(spark, d):
    """The preparation job with its row cap, which is the feature shown."""
    out = scratch_path(spark, "capped")
    prep.run(spark, t.raw_messages(spark, d), f"{out}/corpus", limit=100)
    return spark.read.json(f"{out}/corpus-stats").select("raw_rows", "cleaned_rows", "after_normalized")


def _label_job(spark, d):
    out = scratch_path(spark, "label-job")
    corpus, _ = _corpus_files(spark, d)
    labels.run(spark, corpus, f"{out}/labels", f"{out}/gold", sample=100, splits=True)
    return out


@query(
    "label_job",
    t.with_tables(
        "corpus_labels",
        "SELECT label, count(*) AS n FROM corpus_labels GROUP BY label",
    ),
)
def label_job(spark, d):
    """Labels of the job, read from the files it leaves."""
    return label_distribution(files.read_table(spark, f"{_label_job(spark, d)}/labels", schemas.WEAK_LABELS))


@query("candidate_files", "SELECT 100::BIGINT AS \"rows\", 0::BIGINT AS out_of_order, 0::BIGINT AS overlapping_files FROM (SELECT count(*) FROM documents)")
def candidate_files(spark, d):
    """The review sample of the same job: as many rows as asked for, in order."""
    return files.order_report(spark, f"{_label_job(spark, d)}/gold/candidates", ("doc_id", "chunk_ord"), form="json")


@query("chunk_row_ids", t.with_tables("corpus", "SELECT doc_id || ':' || chunk_ord AS id, doc_id, chunk_ord AS ord, md5(text) AS digest FROM corpus"))
def chunk_row_ids(spark, d):
    return index.chunk_rows(t.corpus(spark, d)).withColumn("digest", F.md5("text")).drop("text")


@query(
    "index_document_rows",
    t.with_tables(
        "corpus_labels",
        """SELECT doc_id AS id, 'aeslc' AS source, md5(title) AS title, thread_id, 'text' AS modality, 'en' AS lang,
        CASE max(CASE label WHEN 'public' THEN 0 WHEN 'internal' THEN 1 ELSE 2 END) WHEN 0 THEN 'public' WHEN 1 THEN 'internal' ELSE 'confidential' END AS label
        FROM corpus JOIN corpus_labels USING (doc_id, chunk_ord) GROUP BY doc_id, title, thread_id""",
    ),
)
def index_document_rows(spark, d):
    """One document row each, whatever the number of its chunks."""
    corpus = t.stored_corpus(spark, d)
    return index.document_rows(corpus, label_chunks(corpus)).withColumn("title", F.md5("title"))


@query("frozen_files", FROZEN["frozen_queries"])
def frozen_files(spark, d):
    """The frozen queries as stored."""
    out = scratch_path(spark, "frozen")
    files.write_rows(frozen(t.stored_corpus(spark, d)), out)
    return files.read_frozen_queries(spark, out).select("qid", "kind", F.md5("text").alias("digest"), "relevant_doc")


@query(
    "train_size_guard",
    """WITH docs AS (SELECT DISTINCT vec_id // 4 AS doc_id FROM embeddings) SELECT true AS accepted, true AS too_few, true AS too_many, count(*) > 0 AS rows_found FROM docs""",
)
def train_size_guard(spark, d):
    """The guard lets the true number of rows pass and refuses bounds on either side of it."""
    train, _, _ = _train_parts(spark, d)
    n = trainset.require_row_count(train, 1, None, "train rows")

    def refused(low, high):
        try:
            trainset.require_row_count(train, low, high, "train rows")
        except ValueError:
            return True
        return False

    return spark.createDataFrame(
        [(not refused(n, n), refused(n + 1, None), refused(None, n - 1), n > 0)],
        "accepted boolean, too_few boolean, too_many boolean, rows_found boolean",
    )


@query(
    "weight_files",
    "SELECT (vec_id // 4)::VARCHAR AS doc_id, vec_id::INT AS chunk_ord, true AS same_label, true AS same_probs FROM embeddings",
)
def weight_files(spark, d):
    """Every vector scored by the fitted model and by its weights after a trip through a file."""
    train, _, vectors = _train_parts(spark, d)
    rows = trainset.join_vectors(train, vectors).select(
        F.concat_ws(":", "doc_id", "chunk_ord").alias("key"), F.col("weak_label").alias("label"), "vector"
    )
    model = linear_model.fit(rows, 1.0)
    out = scratch_path(spark, "weights")
    linear_model.save_weights(spark, linear_model.export_weights(model), out)
    weights = linear_model.load_weights(spark, out, t.DIM)
    fitted = linear_model.predict(model, vectors).withColumnsRenamed({"pred": "_pred", "probs": "_probs"})
    both = linear_model.score_with_weights(weights, fitted)
    gap = F.array_max(F.zip_with(label_values(F.col("probs")), label_values(F.col("_probs")), lambda a, b: F.abs(a - b)))
    return both.select(
        "doc_id", "chunk_ord", (F.col("pred") == F.col("_pred")).alias("same_label"), (gap < 1e-9).alias("same_probs")
    )


_BUCKETS = 64
_BUCKET = f"('0x' || substr(sha256(id), 1, 8))::BIGINT % {_BUCKETS}"


@query(
    "merge_touched_buckets",
    t.with_tables(
        "text_evidence",
        f"""SELECT id, md5(coalesce(i.title, s.title)) AS title, coalesce(i.label, s.label) AS label,
        {_BUCKET} IN (SELECT {_BUCKET} FROM incoming) AS rewritten, i.id IS NOT NULL AND s.id IS NULL AS added
        FROM stored s FULL JOIN incoming i USING (id)""",
        f"""stored AS (SELECT doc_id AS id, title, {t.SQL_LABEL} AS label FROM text_evidence),
        incoming AS (SELECT doc_id::VARCHAR AS id, 'found toxic' AS title, 'confidential' AS label FROM labels WHERE toxic = 1
                     UNION ALL SELECT 'page:' || page_id, url, 'internal' FROM pages WHERE contains(lower(html), 'cookie'))""",
    ),
)
def merge_touched_buckets(spark, d):
    """All documents stored in buckets; then toxic documents change and pages with cookie notes come in."""
    out = scratch_path(spark, "buckets")

    def shaped(rows):
        constants = {"source": "test", "modality": "text", "lang": "en", "thread_id": "t"}
        return rows.select("id", "title", "label", *[F.lit(v).alias(c) for c, v in constants.items()])

    documents = t.text_documents(spark, d).select("doc_id", "chunk_ord", "title", "text")
    rated = label_chunks(documents).select("doc_id", "label").join(documents, "doc_id")
    toxic = t.table(spark, d, "labels").filter(F.col("toxic") == 1).select(
        F.col("doc_id").cast("string").alias("id"), F.lit("found toxic").alias("title"), F.lit("confidential").alias("label")
    )
    pages = t.table(spark, d, "pages").filter(F.contains(F.lower("html"), F.lit("cookie"))).select(
        F.concat(F.lit("page:"), "page_id").alias("id"), F.col("url").alias("title"), F.lit("internal").alias("label")
    )
    for incoming in (rated.withColumnRenamed("doc_id", "id"), toxic.unionByName(pages)):
        buckets.merge_buckets(spark, out, shaped(incoming), "id", schemas.DOCUMENTS, index.refresh_documents, _BUCKETS)
    since = buckets.read_manifest(spark, out).select("bucket", "since")
    rows = buckets.read_buckets(spark, out, schemas.DOCUMENTS)
    return rows.withColumn("bucket", buckets.bucket_of(F.col("id"), _BUCKETS)).join(F.broadcast(since), "bucket").select(
        "id", F.md5("title").alias("title"), "label", (F.col("since") > 0).alias("rewritten"),
        F.startswith("id", F.lit("page:")).alias("added"),
    )
