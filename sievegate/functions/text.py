"""Text cleaning, identifiers and text assembly as Column expressions.

Everything here stays in the JVM. Ends of texts and lines are trimmed with an explicit list
of white-space characters, which is both exact and far cheaper than a pattern. The patterns
that remain are written without nested repetition, so time is linear in the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode white-space character, by rule; Spark's plain ``trim`` only knows the blank.
WHITE_SPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# (?U) makes \\s cover Unicode; the controls U+001C..U+001F are added as Java leaves them out.
_SPACE = r"[\s\x1c-\x1f]"
_INLINE_SPACE = r"[\s\x1c-\x1f&&[^\n]]"

# Reply prefixes, quote marks, forward and signature markers.
REPLY_PREFIXES = ("re:", "fw:", "fwd:")
QUOTE_MARKS = (">", "|")
FORWARD_RULE = "-----"
ATTRIBUTION = ("On ", "wrote:")
SIGNATURE_LINES = ("--", "---")
MOBILE_SIGNATURE = "sent from my"
MISSING_TITLE = "none"

# Flags: U Unicode classes, d only \n ends a line, m line anchors, s dot takes \n.
_SIGNATURE_TO_END = (
    rf"(?Udms)^{_INLINE_SPACE}*+(?:-{{2,3}}{_INLINE_SPACE}*+$"
    r"|[Ss][Ee][Nn][Tt] [Ff][Rr][Oo][Mm] [Mm][Yy]).*"
)
_DROPPED_LINE = (
    rf"(?Udm)^{_INLINE_SPACE}*+"
    rf"(?:[>|].*|-----.*|On (?:.*)wrote:{_INLINE_SPACE}*)(?:\n|\z)"
)
_PREFIX_CHAIN = rf"(?U)\A(?:(?:{'|'.join(REPLY_PREFIXES)}){_SPACE}*+)++"


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def _strip_line_ends(text: Column) -> Column:
    lines = F.transform(F.split(text, "\n", -1), lambda line: F.rtrim(line, F.lit(WHITE_SPACE)))
    return F.array_join(lines, "\n")


def clean_text(body: Column) -> Column:
    """Message text without quoted replies, forward headers and the signature block."""
    newline = F.lit("\n")
    text = F.replace(F.replace(body, F.lit("\r\n"), newline), F.lit("\r"), newline)
    text = F.regexp_replace(text, _SIGNATURE_TO_END, "")
    text = F.regexp_replace(text, _DROPPED_LINE, "")
    text = _strip_line_ends(text)
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def normalize_subject(subject: Column) -> Column:
    """Lower-cased subject without its chain of reply and forward prefixes."""
    lowered = F.lower(strip(F.coalesce(subject, F.lit(""))))
    return F.regexp_replace(lowered, _PREFIX_CHAIN, "")


def thread_id(subject: Column) -> Column:
    """Pseudo-thread: 12 hex digits over the normalised subject."""
    return F.substring(F.sha2(normalize_subject(subject), 256), 1, 12)


def content_doc_id(split: Column, body: Column, subject: Column, hex_digits: int = 32) -> Column:
    """``split:hash`` over body and subject; eight digits give short ids that may collide."""
    digest = F.sha2(F.concat_ws("\u0000", body, subject), 256)
    return F.concat(split, F.lit(":"), F.substring(digest, 1, hex_digits))


def dedupe_key(text: Column) -> Column:
    """Comparison form for near-identical copies: lower case, white space collapsed.

    Single blanks are already in that form and are not rewritten.
    """
    return F.lower(F.regexp_replace(text, r"\s{2,}|[\t\n\x0B\f\r]", " "))


def chunk_id(doc_id: Column, ordinal: Column) -> Column:
    return F.concat_ws(":", doc_id, ordinal.cast("string"))


def encoder_input(title: Column, text: Column, style: str = "document") -> Column:
    """The one definition of what an encoder sees, for training and for scoring.

    ``document``  stripped title or ``none``, newline, text
    ``plain``     title and text, or the text alone when the title is empty
    ``context``   stripped title, newline, stripped text
    """
    title = F.coalesce(title, F.lit(""))
    if style == "document":
        stripped = strip(title)
        head = F.when(stripped == "", F.lit(MISSING_TITLE)).otherwise(stripped)
        return F.concat(head, F.lit("\n"), text)
    if style == "plain":
        return F.when(title == "", text).otherwise(F.concat(title, F.lit("\n"), text))
    if style == "context":
        return F.concat(strip(title), F.lit("\n"), strip(text))
    raise ValueError(f"unknown encoder input style {style!r}")


def snippet(text: Column, length: int = 200) -> Column:
    return F.substring(text, 1, length)


def informative_subject(title: Column, min_length: int = 15) -> Column:
    """Long enough, and not a bare reply or forward."""
    stripped = strip(F.coalesce(title, F.lit("")))
    lowered = F.lower(stripped)
    is_reply = F.lit(False)
    for prefix in REPLY_PREFIXES:
        is_reply = is_reply | F.startswith(lowered, F.lit(prefix))
    return (F.length(stripped) >= min_length) & ~is_reply


def passage_query(text: Column, length: int = 500) -> Column:
    """Opening of a passage without its first, possibly cut, word."""
    head = F.substring(text, 1, length)
    gap = F.instr(head, " ")
    return F.when(
        (gap > 1) & (gap < F.length(head)), F.substr(head, gap + F.lit(1))
    ).otherwise(head)
