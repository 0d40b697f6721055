"""Views of the driver tables in the shapes the operators expect, in Spark and in SQL.

Every frame here is derived from whole tables. The SQL twins are named CTEs that
``with_tables`` puts in front of a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievegate.functions.acl import team_by_sha
from sievegate.operators.labelling import label_chunks
from sievegate.operators.upsert import grant_roles
from sievegate.plans.prep import build_corpus, clean_messages
from sievegate.schemas import LABELS
from sievegate.session import scratch_path

DIM = 64
CHUNKS_PER_DOC = 4


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


# --- messages: documents as subject line and body ---------------------------------------


def as_messages(documents: DataFrame) -> DataFrame:
    """First line as subject, the rest (or a single line itself) as body, hashed split."""
    text, gap = F.col("text"), F.instr("text", "\n")
    bucket = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 4), 16, 10).cast("int") % 100
    split = F.when(bucket < 80, "train").when(bucket < 90, "validation").otherwise("test")
    return documents.select(
        F.when(gap > 0, F.substr(text, gap + F.lit(1))).otherwise(text).alias("email_body"),
        F.substring_index(text, "\n", 1).alias("subject_line"),
        split.alias("split"),
    )


def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    return as_messages(texts(spark, folder))


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    return build_corpus(raw_messages(spark, folder))


def stored_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus written to the shared folder, for queries that read it several times."""
    path = scratch_path(spark, "corpus")
    rows = corpus(spark, folder)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return clean_messages(raw_messages(spark, folder))


# --- turns: conversations as threads of one-turn documents ------------------------------


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, thread_id, title, chunk_ord, text`` with the conversation as thread."""
    return table(spark, folder, "conversations").select(
        F.concat_ws(":", "conv_id", "turn").alias("doc_id"),
        F.col("conv_id").cast("string").alias("thread_id"),
        F.col("role").alias("title"),
        F.lit(0).alias("chunk_ord"),
        "text",
    )


# --- documents with labels and grants ---------------------------------------------------


def text_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, chunk_ord, title, text, lang, source`` over whole texts."""
    return texts(spark, folder).select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.lit(0).alias("chunk_ord"),
        F.substring_index("text", "\n", 1).alias("title"),
        "text",
        "lang",
        "source",
    )


# --- vectors: four neighbouring ids form one document -----------------------------------


def vector_items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("chunk_id"),
        F.floor(F.col("vec_id") / CHUNKS_PER_DOC).alias("doc_id"),
        "embedding",
        F.col("label").cast("bigint").alias("topic"),
    )


def vector_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents over the vectors: label from the topics, grants seeded from the id."""
    label = F.max(F.col("topic") % 3)
    documents = (
        vector_items(spark, folder)
        .groupBy("doc_id")
        .agg(label.alias("_rank"))
        .select(
            "doc_id",
            F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("title"),
            F.when(F.col("doc_id") % 7 == 6, "image").otherwise("text").alias("modality"),
            F.when(F.col("_rank") == 0, "public")
            .when(F.col("_rank") == 1, "internal")
            .otherwise("confidential")
            .alias("label"),
        )
    )
    return grant_roles(documents, lambda key: team_by_sha(key.cast("string")))


def vector_queries(spark: SparkSession, folder: str) -> DataFrame:
    items = vector_items(spark, folder)
    return items.select(F.col("chunk_id").alias("qid"), F.col("embedding").alias("vector"), "topic")


def noisy_queries(spark: SparkSession, folder: str, noise: float) -> DataFrame:
    """Every vector disturbed by a fixed pattern; its own document is the relevant one."""
    items = vector_items(spark, folder)
    disturbed = F.transform(
        F.col("embedding").cast("array<double>"),
        lambda x, i: x + F.lit(noise) * ((F.col("chunk_id") * 31 + i * 17) % 11 - 5),
    )
    return items.select(
        F.col("chunk_id").alias("qid"), disturbed.cast("array<float>").alias("vector"), F.col("doc_id").alias("relevant_doc")
    )


# --- predictions: gold labels against the rule labels -----------------------------------


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Two methods over the labelled documents, with probabilities from fixed formulas.

    ``rules`` predicts the rule label; ``shifted`` moves every third document one label on.
    """
    gold = F.when(F.col("toxic") == 1, "confidential").when(F.col("quality") == 1, "public")
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("doc_id").alias("key"),
        gold.otherwise("internal").alias("gold"),
    )
    texts = text_documents(spark, folder).join(labels.select("doc_id"), "doc_id", "left_semi")
    names = F.array(*[F.lit(name) for name in LABELS])
    place = (F.array_position(names, F.col("label")) - 1).cast("int")
    scored = label_chunks(texts).join(labels, "doc_id")
    methods = F.array(
        F.struct(F.lit("rules").alias("method"), place.alias("place")),
        F.struct(
            F.lit("shifted").alias("method"),
            F.when(F.col("key") % 3 == 0, (place + 1) % 3).otherwise(place).alias("place"),
        ),
    )
    rows = scored.select("doc_id", "chunk_ord", "gold", "key", F.explode(methods).alias("_m")).select(
        "doc_id", "chunk_ord", "gold", "key", "_m.*"
    )
    sure = F.lit(0.4) + (F.col("key") % 60) / 100
    probs = F.map_from_arrays(
        names,
        F.transform(
            F.sequence(F.lit(0), F.lit(2)),
            lambda i: F.when(i == F.col("place"), sure).otherwise((F.lit(1.0) - sure) / 2),
        ),
    )
    return rows.select(
        "method",
        "doc_id",
        "chunk_ord",
        "gold",
        F.get(names, F.col("place")).alias("pred"),
        probs.alias("probs"),
        ((F.col("key") * 37 % 101) / 4.0).alias("latency_ms"),
    )


# --- SQL twins --------------------------------------------------------------------------

WHITE = r"[\s\x0b\x1c-\x1f\x{85}\pZ]"


def sql_strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WHITE}+', ''), '{WHITE}+$', '')"


def sql_rstrip(x: str) -> str:
    return f"regexp_replace({x}, '{WHITE}+$', '')"


def sql_clean(body: str) -> str:
    lines = f"string_split(replace(replace({body}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))"
    line = sql_strip("x")
    signature = f"({line} IN ('--', '---') OR starts_with(lower({line}), 'sent from my'))"
    dropped = (
        f"(starts_with({line}, '>') OR starts_with({line}, '|') OR starts_with({line}, '-----') "
        f"OR (starts_with({line}, 'On ') AND ends_with({line}, 'wrote:')))"
    )
    before = (
        f"coalesce(nullif(list_position(list_transform({lines}, lambda x: {signature}), true), 0), "
        f"len({lines}) + 1) - 1"
    )
    kept = f"list_filter(({lines})[1:{before}], lambda x: NOT {dropped})"
    joined = f"array_to_string(list_transform({kept}, lambda x: {sql_rstrip('x')}), chr(10))"
    squeezed = f"regexp_replace({joined}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return sql_strip(squeezed)


def sql_subject(subject: str) -> str:
    return f"regexp_replace(lower({sql_strip(subject)}), '^(?:(?:re:|fw:|fwd:){WHITE}*)+', '')"


def sql_window_end(start: str) -> str:
    """End of the window that begins at ``start`` in ``text`` (1000 long, 200 fallback)."""
    limit, floor = f"({start} + 1000)", f"({start} + 800)"
    tail = f"substr(text, {floor} + 1, 200)"
    gap = f"strpos(reverse({tail}), ' ')"
    return (
        f"CASE WHEN {limit} >= length(text) THEN length(text) "
        f"WHEN {gap} = 0 THEN {limit} ELSE {floor} + 200 - {gap} END"
    )


_EMAIL = r"[\w.+-]+@[\w-]+\.[\w.]+"
_PHONE = (
    r"(?:^|[^0-9])(?:\+[0-9]{1,3}[-.\s]?)?(?:\([0-9]{3}\)|[0-9]{3})[-.\s]?[0-9]{3}[-.\s]?[0-9]{4}(?:$|[^0-9])"
)
_TERMS = (
    r"(?i)\b(?:confidential|privileged|attorney|do not (?:forward|distribute)|sensitive|private and confidential)\b"
)
_BUSINESS = (
    r"(?i)\b(?:meeting|budget|forecast|headcount|salary|salaries|layoff|merger|acquisition|report|invoice|"
    r"contract|deadline|quarterly|strategy|internal only)\b"
)
SQL_TESTS = {
    "email": f"regexp_matches(blob, '{_EMAIL}')",
    "phone": f"regexp_matches(blob, '{_PHONE}')",
    "ssn": r"regexp_matches(blob, '(?:^|[^0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?:$|[^0-9])')",
    "passport": r"regexp_matches(blob, '(?i)\bpassport\s*(?:no|number|#)?\s*[:.]?\s*[A-Z0-9]{6,12}\b')",
    "credentials": r"regexp_matches(blob, '(?i)\b(?:password|passwd|pwd|api[_-]?key|secret)\b\s*[:=]\s*\S+')",
    "account": (
        r"regexp_matches(blob, '(?i)\b(?:account|routing|iban|swift)\b\s*(?:no|number|#)?\s*[:.]?\s*"
        r"[0-9A-Z-]{6,34}\b')"
    ),
    "card": "len(coalesce(cards, [])) > 0",
    "confidential-marker": f"regexp_matches(blob, '{_TERMS}')",
    "internal-keyword": f"regexp_matches(blob, '{_BUSINESS}')",
}
SQL_RULES = {
    "email": "email-address", "phone": "phone-number", "ssn": "ssn", "passport": "passport",
    "credentials": "credentials", "account": "account-number", "card": "card-luhn",
}

_LUHN = (
    "list_sum(list_transform(range(length(r)), lambda i: CASE WHEN i % 2 = 0 "
    "THEN CAST(substr(r, length(r) - i, 1) AS INT) "
    "ELSE (2 * CAST(substr(r, length(r) - i, 1) AS INT)) // 10 + (2 * CAST(substr(r, length(r) - i, 1) AS INT)) % 10 END)) % 10 = 0"
)


def sql_evidence(name: str, source: str, columns: str, key: str) -> str:
    """CTEs ``{name}`` with one boolean column per rule over ``source``.

    Card candidates are walked group by group inside a digit run: from each group the longest
    stretch of 13 to 19 digits is taken, and the walk continues after it.
    """
    tests = ", ".join(f'{test} AS "{rule}"' for rule, test in SQL_TESTS.items())
    best = "list_max(list_filter(range(i, len(g) + 1), lambda j: length(array_to_string(g[i:j], '')) BETWEEN 13 AND 19))"
    return (
        f"{name}_blob AS (SELECT {columns}, {key} AS bid, title || chr(10) || text AS blob FROM {source}), "
        f"{name}_runs AS (SELECT bid, generate_subscripts(runs, 1) AS rid, unnest(runs) AS run FROM "
        f"(SELECT bid, regexp_extract_all(blob, '[0-9](?:[ -]?[0-9])*') AS runs FROM {name}_blob)), "
        f"{name}_walk AS (SELECT bid, rid, regexp_extract_all(run, '[0-9]+') AS g, 1 AS i, NULL::VARCHAR AS card FROM {name}_runs "
        "WHERE length(regexp_replace(run, '[ -]', '', 'g')) >= 13 "
        f"UNION ALL SELECT bid, rid, g, coalesce({best} + 1, i + 1)::INT, array_to_string(g[i:{best}], '') "
        f"FROM {name}_walk WHERE i <= len(g)), "
        f"{name}_cards AS (SELECT bid, list(card ORDER BY rid, i) AS cards FROM (SELECT bid, rid, i, card AS r, card FROM {name}_walk "
        f"WHERE length(card) >= 13) WHERE {_LUHN} GROUP BY bid), "
        f"{name} AS (SELECT * EXCLUDE (cards), coalesce(cards, []) AS cards, {tests} FROM {name}_blob LEFT JOIN {name}_cards USING (bid))"
    )


SQL_LABEL = (
    'CASE WHEN "confidential-marker" OR ssn OR card OR passport OR credentials OR account THEN \'confidential\' '
    'WHEN email OR phone OR "internal-keyword" THEN \'internal\' ELSE \'public\' END'
)
SQL_PII = "list_filter([" + ", ".join(f"CASE WHEN {n} THEN '{n}' END" for n in SQL_RULES) + "], lambda x: x IS NOT NULL)"
SQL_RULE_LIST = (
    "list_filter(["
    + ", ".join(f"CASE WHEN {n} THEN '{r}' END" for n, r in SQL_RULES.items())
    + ", CASE WHEN \"confidential-marker\" THEN 'confidential-marker' END"
    + ", CASE WHEN \"internal-keyword\" THEN 'internal-keyword' END], lambda x: x IS NOT NULL)"
)
SQL_USERS = (
    "users AS (SELECT * FROM (VALUES ('alice', ['HR', 'Everyone']), ('bob', ['Finance', 'Everyone']), "
    "('carol', ['Everyone']), ('admin', ['HR', 'Finance', 'Everyone', 'Admin'])) AS t(\"user\", roles))"
)
SQL_MAY_READ = (
    "(len(list_intersect(allowed_roles, roles)) > 0 AND (label <> 'confidential' OR "
    "len(list_filter(list_intersect(allowed_roles, roles), lambda r: r <> 'Everyone')) > 0))"
)


def sql_team(key: str) -> str:
    return f"CASE WHEN right(sha256({key}), 1) IN ('1','3','5','7','9','b','d','f') THEN 'HR' ELSE 'Finance' END"


def sql_roles(team: str) -> str:
    return (
        "CASE WHEN modality = 'image' OR label = 'public' THEN ['Everyone'] "
        f"WHEN label = 'internal' THEN ['Everyone', {team}] ELSE [{team}] END"
    )


SQL = {
    "raw_messages": """raw_messages AS (
        SELECT CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE text END AS email_body,
               split_part(text, chr(10), 1) AS subject_line,
               CASE WHEN ('0x' || substr(md5(doc_id::VARCHAR), 1, 4))::INT % 100 < 80 THEN 'train'
                    WHEN ('0x' || substr(md5(doc_id::VARCHAR), 1, 4))::INT % 100 < 90 THEN 'validation' ELSE 'test' END AS split
        FROM documents)""",
    "cleaned": f"""cleaned AS (SELECT * FROM (
        SELECT split || ':' || substr(sha256(email_body || chr(0) || subject_line), 1, 32) AS doc_id,
               substr(sha256({sql_subject('subject_line')}), 1, 12) AS thread_id, split, subject_line AS title,
               {sql_clean('email_body')} AS cleaned FROM raw_messages) WHERE cleaned <> '')""",
    "uniq": r"""uniq AS (SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY lower(regexp_replace(cleaned, '[\s\x0b]+', ' ', 'g'))
                                     ORDER BY doc_id, thread_id, split, title, cleaned) AS rn FROM cleaned) WHERE rn = 1)""",
    "windows": f"""bodies AS (SELECT doc_id, cleaned AS text FROM uniq),
        windows AS (
        SELECT doc_id, 0 AS s, {sql_window_end('0')} AS e, length(text) AS n FROM bodies
        UNION ALL
        SELECT w.doc_id, w.e - 100, {sql_window_end('(w.e - 100)')}, w.n FROM windows w JOIN bodies USING (doc_id) WHERE w.e < w.n)""",
    "corpus": f"""pieces AS (SELECT doc_id, s, {sql_strip('substr(text, s + 1, e - s)')} AS text FROM windows JOIN bodies USING (doc_id)),
        corpus AS (SELECT p.doc_id, thread_id, split, title,
                   CAST(row_number() OVER (PARTITION BY p.doc_id ORDER BY s) - 1 AS INT) AS chunk_ord, p.text,
                   CAST(length(p.text) AS INT) AS char_len
                   FROM pieces p JOIN uniq u USING (doc_id) WHERE p.text <> '')""",
    "turns": """turns AS (SELECT conv_id || ':' || turn AS doc_id, conv_id::VARCHAR AS thread_id, role AS title,
                0 AS chunk_ord, text FROM conversations)""",
    "texts": """texts AS (SELECT doc_id::VARCHAR AS doc_id, split_part(text, chr(10), 1) AS title, text, lang, source FROM documents)""",
    "text_evidence": sql_evidence("text_evidence", "texts", "doc_id, title, text, lang, source", "doc_id"),
    "corpus_evidence": sql_evidence("corpus_evidence", "corpus", "doc_id, chunk_ord, title, text", "doc_id || ':' || chunk_ord"),
    "turn_evidence": sql_evidence("turn_evidence", "turns", "doc_id, chunk_ord, title, text", "doc_id"),
    "corpus_labels": f"""corpus_labels AS (SELECT doc_id, chunk_ord, {SQL_LABEL} AS label, {SQL_PII} AS pii,
        {SQL_RULE_LIST} AS rules FROM corpus_evidence)""",
    "items": """items AS (SELECT vec_id AS chunk_id, vec_id // 4 AS doc_id, embedding::DOUBLE[] AS v, label::BIGINT AS topic FROM embeddings)""",
    "vdocs": f"""vdocs0 AS (SELECT doc_id, 'doc ' || doc_id AS title, CASE WHEN doc_id % 7 = 6 THEN 'image' ELSE 'text' END AS modality,
        CASE max(topic % 3) WHEN 0 THEN 'public' WHEN 1 THEN 'internal' ELSE 'confidential' END AS label FROM items GROUP BY doc_id),
        vdocs AS (SELECT *, {sql_roles(sql_team("doc_id::VARCHAR"))} AS allowed_roles FROM vdocs0)""",
    "users": SQL_USERS,
    "pairs": """pairs AS (SELECT q.chunk_id AS qid, i.chunk_id, i.doc_id,
        round((1 - list_cosine_similarity(q.v, i.v)) * 1000000000)::BIGINT AS units FROM items q, items i)""",
    "predictions": f"""gold AS (SELECT doc_id AS key, CASE WHEN toxic = 1 THEN 'confidential' WHEN quality = 1 THEN 'public' ELSE 'internal' END AS gold FROM labels),
        ruled AS (SELECT key, e.doc_id, gold, CASE {SQL_LABEL} WHEN 'public' THEN 0 WHEN 'internal' THEN 1 ELSE 2 END AS base
                  FROM gold JOIN text_evidence e ON e.doc_id = key::VARCHAR),
        placed AS (SELECT 'rules' AS method, *, base AS place FROM ruled
                   UNION ALL SELECT 'shifted', *, CASE WHEN key % 3 = 0 THEN (base + 1) % 3 ELSE base END FROM ruled),
        predictions AS (SELECT method, doc_id, 0 AS chunk_ord, key, gold, ['public', 'internal', 'confidential'][place + 1] AS pred,
                        0.4 + (key % 60) / 100 AS sure, (key * 37 % 101) / 4.0 AS latency_ms FROM placed)""",
}
_NEEDS = {
    "cleaned": ["raw_messages"], "uniq": ["cleaned"], "windows": ["uniq"], "corpus": ["windows"],
    "corpus_evidence": ["corpus"], "corpus_labels": ["corpus_evidence"], "text_evidence": ["texts"],
    "turn_evidence": ["turns"], "vdocs": ["items"], "pairs": ["items"], "predictions": ["text_evidence"],
}


def with_tables(names: str, select: str, extra: str = "") -> str:
    """``select`` behind the named CTEs and everything they need, in order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        visit(name)
    ctes = [SQL[name] for name in ordered] + ([extra] if extra else [])
    return f"WITH RECURSIVE {', '.join(ctes)} {select}" if ctes else select
