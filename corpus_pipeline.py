"""Preparation of a training corpus in stages, each a job over what the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievegate.llm import mixing, ngram_join, packing, quality, secret_scan
from sievegate.llm.shared import drop, scratch, small_batches, stored
from sievegate.llm.tokens import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "byte_bpe_50k.json"
#: Near copies share 80 of 100 shingles of five words; op8's query has its own numbers.
SHINGLE_WORDS, LINK, PARTS = 5, 80, 100
#: Distinct pieces that a worker remembers: few, since executors are nearly full when packing begins.
REMEMBERED = 300_000


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy of the quality rules; rows are judged one by one."""
    rows = docs.select(F.struct(*COLUMNS).alias("doc"), "text")
    return quality.ledger(rows).filter(quality.passes()).select("doc.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every class of documents whose five-word shingles link at a similarity of 0.8."""
    return ngram_join.one_per_class(docs, COLUMNS, words=SHINGLE_WORDS, link=LINK, parts=PARTS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced and lengths counted anew."""
    models = secret_scan.labelled_models(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select(F.struct(*COLUMNS).alias("doc"), "text")
    found = secret_scan.find_secrets(rows, models)
    text = secret_scan.redacted(F.col("text"), F.col("spans"))
    found = found.select("doc", F.when(F.size("spans") > 0, text).otherwise(F.col("text")).alias("text"), "spans")
    length = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("doc.n_chars"))
    return found.select("doc.doc_id", "text", "doc.lang", "doc.source", length.alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; the last copy may be cut after a word."""
    return mixing.mixed_documents(docs, COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and the sequences that hold them, stored at once while workers get small batches."""
    pieces = packing.pack_documents(docs, tokenizer_path(TOKENIZER), remembered=REMEMBERED, keep_encoder=False)
    with small_batches(spark):
        return stored(pieces, "packed")


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]

#: Models and token ids have no SQL; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed corpus. A stage's tables go once its result is stored, that once the next one is."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (_, stage) in enumerate(STAGES):
        with scratch(spark):
            rows = stage(spark, docs, sf_dir)
            docs = stored(rows, f"stage-{number}", keep=True)
        if last is not None:
            drop(last)
        last = docs
    return docs
