"""Prompt and citation assembly for batches of questions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievegate.functions.text import strip
from sievegate.schemas import LABELS

# The instruction texts.
ANSWER_INSTRUCTION = (
    "Answer the question using ONLY the passages below. "
    "Cite every claim as [n]. If the passages do not answer it, say so."
)
CLASSIFY_INSTRUCTION = "You are a data-sensitivity classifier. Reply with exactly one word."
LABEL_DESCRIPTIONS = {
    "public": "safe to share broadly: no personal data and no internal business content",
    "internal": (
        "for employees only: internal business content (meetings, budgets, "
        "reports, strategy) or low-severity personal data such as names and "
        "email addresses; not for public release"
    ),
    "confidential": (
        "restricted: high-severity personal data (SSN, card numbers, "
        "passports, passwords or API keys, account numbers) or explicit "
        "confidentiality markers (confidential, privileged, attorney, "
        "do-not-forward); needs an explicit grant, never shared broadly"
    ),
}
MISSING_SUBJECT = "(none)"


def numbered_passages(passages: Column) -> Column:
    """``[1] first`` newline ``[2] second`` … in the given order."""
    lines = F.transform(
        passages, lambda p, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), p)
    )
    return F.array_join(lines, "\n")


def grounded_prompt(question: Column, passages: Column) -> Column:
    return F.concat(
        F.lit(f"{ANSWER_INSTRUCTION}\n\nQuestion: "),
        question,
        F.lit("\n\nPassages:\n"),
        numbered_passages(passages),
        F.lit("\n\nAnswer:"),
    )


def classify_prompt(title: Column, text: Column) -> Column:
    """Zero-shot classification message for one text."""
    described = "\n".join(f"- {name}: {LABEL_DESCRIPTIONS[name]}" for name in LABELS)
    subject = strip(F.coalesce(title, F.lit("")))
    return F.concat(
        F.lit(f"{CLASSIFY_INSTRUCTION}\n\nLabels:\n{described}\n\nSubject: "),
        F.when(subject == "", F.lit(MISSING_SUBJECT)).otherwise(subject),
        F.lit("\nBody:\n"),
        strip(text),
        F.lit("\n\nLabel:"),
    )
