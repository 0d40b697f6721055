import pytest
from pyspark.sql import functions as F

from sievegate.functions import rules
from sievegate.functions.prompts import classify_prompt, grounded_prompt
from sievegate.operators.labelling import document_labels, label_chunks

CASES = [
    ("Harbour", "The ferry leaves pier four at dawn.", "public", [], []),
    ("Harbour", "pilot@ferry.example.org has the tide table", "internal", ["email"], ["email-address"]),
    ("Harbour", "radio room: 212-555-0187", "internal", ["phone"], ["phone-number"]),
    ("Crew", "987-65-4321 is the mate's", "confidential", ["ssn"], ["ssn"]),
    ("Diesel", "paid by 5500 0000 0000 0004", "confidential", ["card"], ["card-luhn"]),
    ("Diesel", "barrel 5500 0000 0000 0005", "public", [], []),
    ("Gate", "password: gull-42-pier", "confidential", ["credentials"], ["credentials"]),
    ("Gate", "do not forward this chart", "confidential", [], ["confidential-marker"]),
    ("Dredging", "the forecast for spring", "internal", [], ["internal-keyword"]),
    ("Salary of the cook", "one page", "internal", [], ["internal-keyword"]),
    ("Trip", "Passport No: AB1234567", "confidential", ["passport"], ["passport"]),
    ("Bank", "account current balance", "confidential", ["account"], ["account-number"]),
    ("Bank", "IBAN: DE44500105175407324931", "confidential", ["account"], ["account-number"]),
    ("Call", "+12125550187", "internal", ["phone"], ["phone-number"]),
    ("Digits", "9123-45-67890", "public", [], []),
    ("Folded", "ſALARY and BUDGET", "internal", [], ["internal-keyword"]),
    ("Folded", "the ſalary only", "internal", [], ["internal-keyword"]),
    ("Arabic digits", "٥٥٠٠ ٠٠٠٠ ٠٠٠٠ ٠٠٠٤", "confidential", ["card"], ["card-luhn"]),
    ("Two cards", "5500 0000 0000 0004 5500 0000 0000 0004", "confidential", ["card"], ["card-luhn"]),
    ("Everything", "a@b.co 212-555-0187 987-65-4321 pwd=x confidential report", "confidential",
     ["email", "phone", "ssn", "credentials"],
     ["email-address", "phone-number", "ssn", "credentials", "confidential-marker", "internal-keyword"]),
    (None, "plain", "public", [], []),
]


def test_labels(spark):
    rows = [(str(i), 0, c[0], c[1]) for i, c in enumerate(CASES)]
    corpus = spark.createDataFrame(rows, "doc_id string, chunk_ord int, title string, text string")
    got = {int(r.doc_id): (r.label, list(r.pii), list(r.rules)) for r in label_chunks(corpus).collect()}
    for i, (_, text, label, pii, fired) in enumerate(CASES):
        assert got[i] == (label, pii, fired), text


def test_document_label_is_the_strictest(spark):
    rows = [("a", "public"), ("a", "confidential"), ("a", "internal"), ("b", "public"), ("c", "odd")]
    labels = spark.createDataFrame(rows, "doc_id string, label string")
    got = {r.doc_id: r.label for r in document_labels(labels).collect()}
    assert got == {"a": "confidential", "b": "public", "c": "public"}


def one(spark, expression):
    return spark.range(1).select(expression.alias("o")).first().o


def tags(*names):
    return F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")


def test_tag_labels(spark):
    assert one(spark, rules.label_from_tags(tags())) == "public"
    assert one(spark, rules.label_from_tags(tags("O", "I-PIN"))) == "public"
    assert one(spark, rules.label_from_tags(tags("B-CITY", "I-CITY"))) == "internal"
    assert one(spark, rules.label_from_tags(tags("B-CITY", "B-PASSWORD"))) == "confidential"
    assert one(spark, rules.entity_types(tags("B-CITY", "O", "B-CITY", "B-IP"))) == ["CITY", "IP"]
    with pytest.raises(Exception, match="unknown entity types: PLANET"):
        one(spark, rules.label_from_tags(tags("B-PLANET")))


def test_parse_label(spark):
    assert one(spark, rules.parse_label(F.lit("It is CONFIDENTIAL, not public"))) == "confidential"
    assert one(spark, rules.parse_label(F.lit("internally"))) is None


def test_prompts(spark):
    prompt = one(spark, classify_prompt(F.lit(" "), F.lit(" a {b} ")))
    assert prompt.startswith("You are a data-sensitivity classifier. Reply with exactly one word.\n\nLabels:\n- public: ")
    assert prompt.endswith("\n\nSubject: (none)\nBody:\na {b}\n\nLabel:")
    grounded = one(spark, grounded_prompt(F.lit("why?"), tags("x", "y")))
    assert grounded.endswith("Question: why?\n\nPassages:\n[1] x\n[2] y\n\nAnswer:")
