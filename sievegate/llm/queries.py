"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievegate.llm.alignment import align_documents
from sievegate.llm.mixing import mix_sources
from sievegate.llm.ngram_join import join_classes
from sievegate.llm.packing import pack_documents
from sievegate.llm.personal import KINDS, find_personal_data, fit_field
from sievegate.llm.phrases import mine_phrases
from sievegate.llm.quality import judged
from sievegate.llm.secret_scan import joined, scan
from sievegate.llm.shared import documents
from sievegate.llm.sharding import assign_shards
from sievegate.llm.substring_dedup import remove_repeated_windows
from sievegate.llm.suffix_dedup import remove_repeated_strings
from sievegate.llm.token_files import token_index
from sievegate.llm.tokens import tokenizer_path
from sievegate.llm.topk import exact_top_k

#: Names of the public tokenizer files.
WORD_TOKENIZER, BYTE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"


def op1_substring_dedup(spark, sf_dir):
    return remove_repeated_windows(documents(spark, sf_dir)).drop("kept_text")


def op2_exact_top_k(spark, sf_dir):
    return exact_top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op3_suffix_dedup(spark, sf_dir):
    return remove_repeated_strings(documents(spark, sf_dir)).drop("kept_bytes")


def op4_secret_scan(spark, sf_dir):
    return scan(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_token_files(spark, sf_dir):
    return token_index(documents(spark, sf_dir), tokenizer_path(WORD_TOKENIZER), spaces_matter=False)


def op6_mix_sources(spark, sf_dir):
    return mix_sources(documents(spark, sf_dir))


def op7_pack_documents(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir), tokenizer_path(BYTE_TOKENIZER))


def op8_ngram_join(spark, sf_dir):
    return join_classes(documents(spark, sf_dir)).drop("row", "class")


def op9_shard_tree(spark, sf_dir):
    return assign_shards(documents(spark, sf_dir))


def op10_quality_rules(spark, sf_dir):
    return judged(documents(spark, sf_dir))


def op11_token_alignment(spark, sf_dir):
    found = align_documents(documents(spark, sf_dir), tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_TOKENIZER))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return found.withColumn("groups_sha256", digest).drop("groups")


def op12_phrase_mining(spark, sf_dir):
    return mine_phrases(documents(spark, sf_dir))


def op13_personal_data(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = find_personal_data(docs, fit_field(docs))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base, spans = F.sha2(joined(F.col("base")), 256), joined(F.col("spans"))
    return found.select("doc_id", *map(count, KINDS), base.alias("base_sha256"), spans.alias("spans"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_secret_scan": op4_secret_scan,
    "op5_token_files": op5_token_files,
    "op6_mix_sources": op6_mix_sources,
    "op7_pack_documents": op7_pack_documents,
    "op8_ngram_join": op8_ngram_join,
    "op9_shard_tree": op9_shard_tree,
    "op10_quality_rules": op10_quality_rules,
    "op11_token_alignment": op11_token_alignment,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_personal_data": op13_personal_data,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Verdicts over the columns doc_id and text of a table.
QUALITY_SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w, coalesce(text, '') AS t,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM {{table}}),
words AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i,
    CASE WHEN generate_subscripts(w, 1) + 4 <= len(w)
      THEN array_to_string(w[generate_subscripts(w, 1):generate_subscripts(w, 1) + 4], ' ') END AS win
  FROM texts),
counted AS (SELECT *, win IS NOT NULL AND count(*) OVER (PARTITION BY r, win) > 1 AS hit FROM words),
marked AS (
  SELECT r, bool_or(hit) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS again
  FROM counted),
repeats AS (SELECT r, count(*) FILTER (again) AS n_repeat_words FROM marked GROUP BY r),
measured AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(len(ls) AS BIGINT) AS n_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM texts LEFT JOIN repeats USING (r)),
failing AS (
  SELECT *, CAST((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT
    + 4 * (word_chars < 2 * n_words)::INT + 8 * (word_chars > 20 * n_words)::INT
    + 16 * (100 * n_symbols > 25 * n_words)::INT + 32 * (100 * n_dup_lines > 50 * n_lines)::INT AS INTEGER) AS failed
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed,
  failed = 0 AS kept, failed, n_lines
FROM failing"""

_LOWER_WORDS = _WORDS.replace(
    "coalesce(text, '')",
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')",
)

ORACLES = {
    "op1_substring_dedup": rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
words AS (
  SELECT r, doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i,
    CASE WHEN generate_subscripts(w, 1) + 34 <= len(w)
      THEN array_to_string(w[generate_subscripts(w, 1):generate_subscripts(w, 1) + 34], ' ') END AS win
  FROM texts),
counted AS (SELECT *, win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 AS hit FROM words),
marked AS (
  SELECT *, bool_or(hit) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM counted),
spans AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), false) AS opens FROM marked),
sums AS (
  SELECT r, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
    string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM spans GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN sums USING (r)""",
    "op2_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op6_mix_sources": rf"""
WITH docs AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS source_rank
  FROM docs GROUP BY source),
weighed AS (SELECT *, [1, 2, 3][(source_rank - 1) % 3 + 1] AS weight FROM sizes),
shared AS (
  SELECT *, sum(source_size) OVER () AS words, sum(weight) OVER () AS weights,
    coalesce(sum(3 * source_size) OVER before, 0) AS stopped, coalesce(sum(weight) OVER before, 0) AS gone
  FROM weighed
  WINDOW before AS (ORDER BY source_size / weight, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
units AS (SELECT *, CAST(words - stopped AS DOUBLE) / CAST(weights - gone AS DOUBLE) AS unit FROM shared),
level AS (SELECT max(unit) FILTER (3 * source_size > unit * weight) AS unit FROM units),
targets AS (
  SELECT source, source_rank, source_size,
    least(CAST(3 * source_size AS DOUBLE), coalesce(level.unit, 0) * weight) AS target
  FROM units, level),
budgets AS (
  SELECT *, floor(target + 0.5)::BIGINT AS budget,
    CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS epochs
  FROM targets),
placed AS (
  SELECT docs.*, b.* EXCLUDE (source), coalesce(sum(size) OVER (
    PARTITION BY source_rank ORDER BY md5(concat('0:', doc_id)), doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs JOIN budgets b ON docs.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, source, source_rank,
  (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
FROM placed""",
    "op10_quality_rules": QUALITY_SQL.format(table="documents"),
    "op12_phrase_mining": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
sized AS (SELECT lang, w, unnest(range(1, 6)) AS m FROM words),
placed AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM sized WHERE len(w) >= m),
frequent AS MATERIALIZED (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, m, count(*) AS a FROM placed
  GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT *, string_split(phrase, ' ') AS s, unnest(range(1, m)) AS k FROM frequent WHERE m > 1),
scores AS (
  SELECT c.lang, c.phrase, c.m, c.a, c.k, x.a AS l, y.a AS r, sizes.n,
    CAST((CAST(1000 AS HUGEINT) * c.a * sizes.n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(s[1:k], ' ')
  JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(s[k + 1:c.m], ' ') JOIN sizes ON sizes.lang = c.lang),
best AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
spans AS (SELECT lang, s, m, a, unnest(range(2, m)) AS part FROM cuts WHERE k = 1 AND m > 2),
inner_parts AS (SELECT lang, s, a, part, unnest(range(1, m - part + 2)) AS i FROM spans),
held AS (
  SELECT lang, array_to_string(s[i:i + part - 1], ' ') AS phrase, max(a) AS most FROM inner_parts GROUP BY ALL)
SELECT best.lang, CAST(row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.phrase) AS BIGINT) AS rank,
  best.phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, score
FROM best LEFT JOIN held ON held.lang = best.lang AND held.phrase = best.phrase
WHERE most IS NULL OR 100 * most < 100 * a
QUALIFY rank <= 2000""",
    "op8_ngram_join": rf"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id,
    {_LOWER_WORDS} AS w
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) >= 3
    THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM texts),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
sized AS MATERIALIZED (SELECT * FROM shingles JOIN sizes USING (r)),
pairs AS (
  SELECT a.r AS x, b.r AS y FROM sized a JOIN sized b ON a.s = b.s AND a.r < b.r
  WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
edges AS MATERIALIZED (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (
  SELECT r AS x, r AS y FROM texts
  UNION SELECT reach.x, edges.y FROM reach JOIN edges ON reach.y = edges.x),
least_ids AS (SELECT reach.x AS r, min(t.doc_id) AS component_id FROM reach JOIN texts t ON t.r = reach.y GROUP BY reach.x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM texts JOIN least_ids USING (r) LEFT JOIN sizes USING (r)""",
}
