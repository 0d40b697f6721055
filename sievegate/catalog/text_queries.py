"""Cleaning, de-duplication, chunking and rule labels over the text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievegate.catalog import tables as t
from sievegate.catalog.registry import registry
from sievegate.functions.chunks import chunk_texts
from sievegate.functions.prompts import classify_prompt
from sievegate.functions.rules import luhn_cards, parse_label, searched_text
from sievegate.functions.text import (
    clean_text,
    content_doc_id,
    encoder_input,
    normalize_subject,
    thread_id,
)
from sievegate.operators import corpus as corpus_ops
from sievegate.operators import dedupe, labelling
from sievegate.operators.ranking import first_per_group
from sievegate.sources.files import sample_articles

QUERIES, ORACLES, query = registry()


@query(
    "clean_documents",
    f"SELECT doc_id, length(c) AS n_chars, md5(c) AS digest FROM (SELECT doc_id, {t.sql_clean('text')} AS c FROM documents) WHERE c <> ''",
)
def clean_documents(spark, d):
    cleaned = t.texts(spark, d).select("doc_id", clean_text(F.col("text")).alias("c"))
    return cleaned.filter(F.col("c") != "").select(
        "doc_id", F.length("c").cast("bigint").alias("n_chars"), F.md5("c").alias("digest")
    )


@query(
    "title_body_split",
    t.with_tables(
        "raw_messages",
        "SELECT split, count(*) AS n, sum(length(subject_line))::BIGINT AS subject_chars, "
        "sum(length(email_body))::BIGINT AS body_chars FROM raw_messages GROUP BY split",
    ),
)
def title_body_split(spark, d):
    return t.raw_messages(spark, d).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("subject_line")).alias("subject_chars"),
        F.sum(F.length("email_body")).alias("body_chars"),
    )


@query(
    "doc_id_hash",
    t.with_tables(
        "raw_messages",
        "SELECT split || ':' || substr(sha256(email_body || chr(0) || subject_line), 1, 16) AS doc_id, count(*) AS n "
        "FROM raw_messages GROUP BY 1",
    ),
)
def doc_id_hash(spark, d):
    key = content_doc_id(F.col("split"), F.col("email_body"), F.col("subject_line"), 16)
    return t.raw_messages(spark, d).groupBy(key.alias("doc_id")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "thread_id_hash",
    t.with_tables(
        "raw_messages",
        f"SELECT substr(sha256({t.sql_subject('subject_line')}), 1, 12) AS thread_id, "
        f"min({t.sql_subject('subject_line')}) AS subject, count(*) AS n FROM raw_messages GROUP BY 1",
    ),
)
def thread_id_hash(spark, d):
    subject = F.col("subject_line")
    return t.raw_messages(spark, d).groupBy(thread_id(subject).alias("thread_id")).agg(
        F.min(normalize_subject(subject)).alias("subject"), F.count(F.lit(1)).alias("n")
    )


@query(
    "dedupe_exact",
    t.with_tables("cleaned", "SELECT min(doc_id) AS doc_id, md5(cleaned) AS digest FROM cleaned GROUP BY cleaned"),
)
def dedupe_exact(spark, d):
    kept = dedupe.drop_exact_copies(t.cleaned(spark, d), "cleaned", "doc_id")
    return kept.select("doc_id", F.md5("cleaned").alias("digest"))


@query(
    "dedupe_normalized",
    t.with_tables("uniq", "SELECT doc_id, thread_id, split, title, md5(cleaned) AS digest FROM uniq"),
)
def dedupe_normalized(spark, d):
    kept = dedupe.drop_normalized_copies(t.cleaned(spark, d), "cleaned", "doc_id")
    return kept.select("doc_id", "thread_id", "split", "title", F.md5("cleaned").alias("digest"))


@query(
    "dedupe_stats",
    t.with_tables(
        "cleaned",
        r"""SELECT n AS "input", e AS after_exact, m AS after_normalized, n - e AS exact_removed, e - m AS normalized_removed
        FROM (SELECT count(*) AS n, count(DISTINCT cleaned) AS e,
              count(DISTINCT lower(regexp_replace(cleaned, '[\s\x0b]+', ' ', 'g'))) AS m FROM cleaned)""",
    ),
)
def dedupe_stats(spark, d):
    return dedupe.copy_counts(t.cleaned(spark, d), "cleaned")


@query(
    "chunk_bounds",
    t.with_tables("corpus", "SELECT doc_id, chunk_ord, char_len, md5(text) AS digest FROM corpus"),
)
def chunk_bounds(spark, d):
    return t.corpus(spark, d).select("doc_id", "chunk_ord", "char_len", F.md5("text").alias("digest"))


@query(
    "small_windows",
    """WITH RECURSIVE bodies AS (SELECT conv_id, turn, text FROM conversations), w AS (
        SELECT conv_id, turn, 0 AS s, CASE WHEN 300 >= length(text) THEN length(text)
               WHEN strpos(reverse(substr(text, 101, 200)), ' ') = 0 THEN 300 ELSE 300 - strpos(reverse(substr(text, 101, 200)), ' ') END AS e,
               length(text) AS n FROM bodies
        UNION ALL
        SELECT w.conv_id, w.turn, w.e - 20, CASE WHEN w.e + 280 >= n THEN n
               WHEN strpos(reverse(substr(text, w.e + 81, 200)), ' ') = 0 THEN w.e + 280
               ELSE w.e + 280 - strpos(reverse(substr(text, w.e + 81, 200)), ' ') END, n
        FROM w JOIN bodies b ON b.conv_id = w.conv_id AND b.turn = w.turn WHERE w.e < n)
       SELECT conv_id, turn, count(*) AS n_chunks, sum(length(trim(substr(text, s + 1, e - s), chr(32) || chr(10))))::BIGINT AS chars
       FROM w JOIN bodies USING (conv_id, turn) GROUP BY 1, 2""",
)
def small_windows(spark, d):
    pieces = t.table(spark, d, "conversations").select(
        "conv_id", "turn", F.explode_outer(chunk_texts(F.col("text"), 300, 20)).alias("piece")
    )
    return pieces.filter(F.col("piece").isNotNull()).groupBy("conv_id", "turn").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.sum(F.length("piece")).alias("chars")
    )


@query(
    "chunk_profile",
    t.with_tables(
        "corpus",
        "SELECT split, count(*) AS n_chunks, count(DISTINCT doc_id) AS n_docs, sum(char_len)::BIGINT AS chars, "
        "max(chunk_ord)::BIGINT AS last_ord FROM corpus GROUP BY split",
    ),
)
def chunk_profile(spark, d):
    return t.corpus(spark, d).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.count_distinct("doc_id").alias("n_docs"),
        F.sum("char_len").alias("chars"),
        F.max("chunk_ord").cast("bigint").alias("last_ord"),
    )


@query(
    "corpus_integrity",
    t.with_tables(
        "corpus",
        """SELECT count(DISTINCT doc_id) AS documents, count(DISTINCT thread_id) AS threads, count(*) AS chunks,
        count(*) FILTER (text = '') AS empty_texts, count(*) FILTER (length(text) <> char_len) AS length_mismatches,
        count(*) FILTER (title IS NULL OR text IS NULL) AS rows_with_nulls,
        (SELECT count(*) FROM (SELECT doc_id FROM corpus GROUP BY doc_id
            HAVING max(chunk_ord) + 1 <> count(DISTINCT chunk_ord) OR count(*) <> count(DISTINCT chunk_ord))) AS documents_with_gaps,
        count(*) - count(DISTINCT (doc_id, chunk_ord)) AS duplicate_keys FROM corpus""",
    ),
)
def corpus_integrity(spark, d):
    return corpus_ops.integrity_profile(t.corpus(spark, d))


@query(
    "chunks_per_document",
    t.with_tables(
        "corpus",
        """SELECT q, n, value FROM (SELECT count(*) AS n, list_sort(list(c)) AS v FROM (SELECT count(*) AS c FROM corpus GROUP BY doc_id)),
        (VALUES (0.5), (0.9), (0.99)) AS t(q0), LATERAL (SELECT q0::DOUBLE AS q, v[greatest(ceil(q0::DOUBLE * n), 1)::INT] AS value)""",
    ),
)
def chunks_per_document(spark, d):
    return corpus_ops.chunks_per_document(t.stored_corpus(spark, d), (0.5, 0.9, 0.99))


@query(
    "whole_document_text",
    t.with_tables(
        "corpus",
        """SELECT doc_id, length(x)::BIGINT AS n_chars, md5(x) AS digest FROM (
        SELECT doc_id, substr(min(title) || chr(10) || string_agg(text, chr(10) ORDER BY chunk_ord), 1, 4000) AS x
        FROM corpus GROUP BY doc_id)""",
    ),
)
def whole_document_text(spark, d):
    chunks = t.stored_corpus(spark, d)
    titles = chunks.groupBy("doc_id").agg(F.min("title").alias("title"))
    return corpus_ops.whole_texts(chunks, titles).select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("digest")
    )


@query(
    "first_chunk_per_doc",
    t.with_tables("corpus", "SELECT doc_id, md5(substr(text, 1, 200)) AS digest FROM corpus WHERE chunk_ord = 0"),
)
def first_chunk_per_doc(spark, d):
    chunks = t.corpus(spark, d).select("doc_id", "chunk_ord", "text")
    first = first_per_group(chunks, ["doc_id"], ["chunk_ord"])
    return first.select("doc_id", F.md5(F.substring("text", 1, 200)).alias("digest"))


@query(
    "pii_flags",
    t.with_tables(
        "text_evidence",
        f"SELECT doc_id, array_to_string({t.SQL_PII}, ',') AS pii, array_to_string({t.SQL_RULE_LIST}, ',') AS rules FROM text_evidence",
    ),
)
def pii_flags(spark, d):
    return labelling.label_chunks(t.text_documents(spark, d)).select(
        "doc_id", F.array_join("pii", ",").alias("pii"), F.array_join("rules", ",").alias("rules")
    )


@query(
    "pii_flag_counts",
    t.with_tables(
        "text_evidence",
        " UNION ALL ".join(
            f"SELECT '{rule}' AS rule, count(*) FILTER (\"{rule}\") AS n FROM text_evidence" for rule in t.SQL_TESTS
        ),
    ),
)
def pii_flag_counts(spark, d):
    marked = labelling.with_evidence(t.text_documents(spark, d))
    names = [c for c in marked.columns if c.startswith("has_")]
    pairs = [F.struct(F.lit(c.removeprefix("has_")).alias("rule"), F.col(c).alias("hit")) for c in names]
    return (
        marked.select(F.explode(F.array(*pairs)).alias("p"))
        .groupBy("p.rule")
        .agg(F.count_if("p.hit").alias("n"))
    )


@query(
    "luhn_cards",
    t.with_tables("text_evidence", "SELECT doc_id, unnest(cards) AS card FROM text_evidence"),
)
def luhn_card_numbers(spark, d):
    blob = searched_text(F.col("title"), F.col("text"))
    cards = t.text_documents(spark, d).select("doc_id", F.explode_outer(luhn_cards(blob)).alias("card"))
    return cards.filter(F.col("card").isNotNull())


@query(
    "weak_labels",
    t.with_tables("corpus_labels", "SELECT doc_id, chunk_ord, label, array_to_string(pii, ',') AS pii FROM corpus_labels"),
)
def weak_labels(spark, d):
    return labelling.label_chunks(t.corpus(spark, d)).select(
        "doc_id", "chunk_ord", "label", F.array_join("pii", ",").alias("pii")
    )


@query(
    "label_distribution",
    t.with_tables("corpus_labels", "SELECT label, count(*) AS n FROM corpus_labels GROUP BY label"),
)
def label_distribution(spark, d):
    return labelling.label_distribution(labelling.label_chunks(t.corpus(spark, d)))


_DOC_LABEL = """doc_labels AS (SELECT doc_id, CASE max(CASE label WHEN 'public' THEN 0 WHEN 'internal' THEN 1 ELSE 2 END)
    WHEN 0 THEN 'public' WHEN 1 THEN 'internal' ELSE 'confidential' END AS label FROM corpus_labels GROUP BY doc_id)"""


@query("doc_label_max", t.with_tables("corpus_labels", "SELECT * FROM doc_labels", _DOC_LABEL))
def doc_label_max(spark, d):
    return labelling.document_labels(labelling.label_chunks(t.corpus(spark, d)))


@query(
    "doc_label_attach",
    t.with_tables(
        "text_evidence",
        f"""SELECT t.doc_id, coalesce(l.label, 'internal') AS label FROM texts t
        LEFT JOIN (SELECT doc_id, {t.SQL_LABEL} AS label FROM text_evidence WHERE doc_id IN (SELECT doc_id::VARCHAR FROM labels)) l USING (doc_id)""",
    ),
)
def doc_label_attach(spark, d):
    """Only documents of the ``labels`` table were looked at; the others get the default."""
    documents = t.text_documents(spark, d)
    seen = t.table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("doc_id"))
    labels = labelling.label_chunks(documents.join(seen, "doc_id", "left_semi"))
    return labelling.attach_document_label(documents.select("doc_id"), labels)


@query(
    "encoder_inputs",
    t.with_tables(
        "corpus",
        f"""SELECT doc_id, chunk_ord,
        md5(coalesce(nullif({t.sql_strip('title')}, ''), 'none') || chr(10) || text) AS document,
        md5(CASE WHEN title = '' THEN text ELSE title || chr(10) || text END) AS plain,
        md5({t.sql_strip('title')} || chr(10) || {t.sql_strip('text')}) AS context FROM corpus""",
    ),
)
def encoder_inputs(spark, d):
    styles = [
        F.md5(encoder_input(F.col("title"), F.col("text"), style)).alias(style)
        for style in ("document", "plain", "context")
    ]
    return t.corpus(spark, d).select("doc_id", "chunk_ord", *styles)


@query(
    "classify_prompts",
    """SELECT conv_id, turn, length(p)::BIGINT AS n_chars, md5(p) AS digest FROM (SELECT conv_id, turn,
    'You are a data-sensitivity classifier. Reply with exactly one word.' || chr(10) || chr(10) || 'Labels:' || chr(10)
    || '- public: safe to share broadly: no personal data and no internal business content' || chr(10)
    || '- internal: for employees only: internal business content (meetings, budgets, reports, strategy) or low-severity personal data such as names and email addresses; not for public release' || chr(10)
    || '- confidential: restricted: high-severity personal data (SSN, card numbers, passports, passwords or API keys, account numbers) or explicit confidentiality markers (confidential, privileged, attorney, do-not-forward); needs an explicit grant, never shared broadly'
    || chr(10) || chr(10) || 'Subject: ' || coalesce(nullif(trim(role), ''), '(none)') || chr(10) || 'Body:' || chr(10)
    || trim(text, chr(32) || chr(10)) || chr(10) || chr(10) || 'Label:' AS p FROM conversations)""",
)
def classify_prompts(spark, d):
    prompt = classify_prompt(F.col("role"), F.col("text"))
    return t.table(spark, d, "conversations").select(
        "conv_id", "turn", F.length(prompt).cast("bigint").alias("n_chars"), F.md5(prompt).alias("digest")
    )


@query(
    "label_parse",
    r"""SELECT event_type, label, count(*) AS n FROM (SELECT event_type,
        CASE WHEN regexp_extract(g, '(?i)\b(public|internal|confidential)\b', 1) <> ''
             THEN lower(regexp_extract(g, '(?i)\b(public|internal|confidential)\b', 1)) ELSE 'internal' END AS label
        FROM (SELECT event_type, CASE user_id % 5 WHEN 0 THEN 'Public.' WHEN 1 THEN 'It is CONFIDENTIAL, not public' WHEN 2 THEN 'internally'
              WHEN 3 THEN ' internal' ELSE event_type END AS g FROM events)) GROUP BY 1, 2""",
)
def label_parse(spark, d):
    """Answers composed from the events; those without a label word fall back to internal."""
    user = F.col("user_id") % 5
    answer = (
        F.when(user == 0, "Public.")
        .when(user == 1, "It is CONFIDENTIAL, not public")
        .when(user == 2, "internally")
        .when(user == 3, " internal")
        .otherwise(F.col("event_type"))
    )
    label = F.coalesce(parse_label(answer), F.lit("internal"))
    events = t.table(spark, d, "events").select("event_type", label.alias("label"))
    return events.groupBy("event_type", "label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "article_sample",
    f"""SELECT doc_id, length(body)::BIGINT AS n_chars, md5(body) AS digest FROM (
        SELECT doc_id, substr({t.sql_strip('text')}, 1, 2000) AS body FROM documents WHERE length({t.sql_strip('text')}) >= 500
        ORDER BY doc_id LIMIT 500)""",
)
def article_sample(spark, d):
    """The article sample takes the first 500 long enough texts."""
    sample = sample_articles(t.table(spark, d, "documents"), "doc_id", 500)
    return sample.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("digest")
    )


# Lines and phrases put into the tables' texts, so that rules fire which the texts alone never trigger.
PLANTED_LINES = ("> quoted line", "| another one", "----- passed on -----", "On the 3rd the pilot wrote:", "kept\r", "kept too", "--", "cut off")
PLANTED_PHRASES = (
    "mate 987-65-4321 aboard", "passport no: XK4471902", "password = gull42", "iban: DE02120300000000202051",
    "please do not forward", "the forecast of tides", "paid by 5500 0000 0000 0004", "nothing to see",
)
_SQL_LINES = " || chr(10) || ".join("'" + line.replace("\r", "' || chr(13) || '") + "'" for line in PLANTED_LINES)


@query(
    "planted_lines",
    f"SELECT doc_id, length(c) AS n_chars, md5(c) AS digest FROM (SELECT doc_id, {t.sql_clean('body')} AS c FROM "
    f"(SELECT doc_id, '> first' || chr(13) || chr(10) || text || chr(10) || {_SQL_LINES} AS body FROM documents))",
)
def planted_lines(spark, d):
    """Cleaning where every text has quoted and forwarded lines, a carriage return and a signature."""
    body = F.concat(F.lit("> first\r\n"), F.col("text"), F.lit("\n" + "\n".join(PLANTED_LINES)))
    cleaned = t.texts(spark, d).select("doc_id", clean_text(body).alias("c"))
    return cleaned.select("doc_id", F.length("c").cast("bigint").alias("n_chars"), F.md5("c").alias("digest"))


_PLANTED_LIST = "[" + ", ".join(f"'{p}'" for p in PLANTED_PHRASES) + "]"


@query(
    "planted_flags",
    t.with_tables(
        "turns",
        f"SELECT array_to_string({t.SQL_PII}, ',') AS pii, array_to_string({t.SQL_RULE_LIST}, ',') AS rules, {t.SQL_LABEL} AS label, count(*) AS n "
        "FROM planted_evidence GROUP BY 1, 2, 3",
        f"planted AS (SELECT doc_id, chunk_ord, title, text || ' ' || {_PLANTED_LIST}[(thread_id::BIGINT % 8 + 1)::INT] AS text FROM turns), "
        + t.sql_evidence("planted_evidence", "planted", "doc_id, chunk_ord, title, text", "doc_id"),
    ),
)
def planted_flags(spark, d):
    """Rule labels where every text ends with a phrase for one of the rules, or for none."""
    phrases = F.array(*map(F.lit, PLANTED_PHRASES))
    phrase = F.get(phrases, (F.col("thread_id").cast("bigint") % len(PLANTED_PHRASES)).cast("int"))
    turns = t.turns(spark, d).withColumn("text", F.concat_ws(" ", "text", phrase))
    labelled = labelling.label_chunks(turns)
    return labelled.groupBy(F.array_join("pii", ",").alias("pii"), F.array_join("rules", ",").alias("rules"), "label").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "planted_copies",
    r"""SELECT n AS "input", e AS after_exact, m AS after_normalized, n - e AS exact_removed, e - m AS normalized_removed
    FROM (SELECT count(*) AS n, count(DISTINCT text) AS e, count(DISTINCT lower(regexp_replace(text, '[\s\x0b]+', ' ', 'g'))) AS m
          FROM (SELECT text FROM documents UNION ALL SELECT replace(text, ' ', chr(9) || ' ') FROM documents))""",
)
def planted_copies(spark, d):
    """Copy counts where every text has a second form that differs in white space only."""
    texts = t.texts(spark, d).select("text")
    wider = texts.select(F.replace("text", F.lit(" "), F.lit("\t ")).alias("text"))
    return dedupe.copy_counts(texts.unionByName(wider), "text")
