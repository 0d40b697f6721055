"""Rule-based sensitivity flags, labels and label parsing as Column expressions."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache, reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievegate.schemas import LABELS

# Detection patterns with flag name and rule id, in reporting order.
PII_PATTERNS = (
    ("email", "email-address", r"[\w.+-]+@[\w-]+\.[\w.]+"),
    (
        "phone",
        "phone-number",
        r"(?<!\d)(?:\+\d{1,3}[-.\s]?)?(?:\(\d{3}\)|\d{3})[-.\s]?\d{3}[-.\s]?\d{4}(?!\d)",
    ),
    ("ssn", "ssn", r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)"),
    ("passport", "passport", r"(?i)\bpassport\s*(?:no|number|#)?\s*[:.]?\s*[A-Z0-9]{6,12}\b"),
    (
        "credentials",
        "credentials",
        r"(?i)\b(?:password|passwd|pwd|api[_-]?key|secret)\b\s*[:=]\s*\S+",
    ),
    (
        "account",
        "account-number",
        r"(?i)\b(?:account|routing|iban|swift)\b\s*(?:no|number|#)?\s*[:.]?\s*[\dA-Z-]{6,34}\b",
    ),
)
CARD_FLAG, CARD_RULE = "card", "card-luhn"
CARD_PATTERN = r"(?<!\d)(?:\d[ -]?){13,19}(?!\d)"
HIGH_SEVERITY = ("ssn", "card", "passport", "credentials", "account")
CONFIDENTIAL_RULE = "confidential-marker"
CONFIDENTIAL_TERMS = (
    "confidential", "privileged", "attorney", "do not (?:forward|distribute)",
    "sensitive", "private and confidential",
)
INTERNAL_RULE = "internal-keyword"
INTERNAL_TERMS = (
    "meeting", "budget", "forecast", "headcount", "salary", "salaries", "layoff", "merger",
    "acquisition", "report", "invoice", "contract", "deadline", "quarterly", "strategy",
    "internal only",
)

# Words of which at least one must occur (case folded) before a pattern can match.
_GUARD_WORDS = {
    "passport": ("passport",),
    "credentials": ("password", "passwd", "pwd", "api", "secret"),
    "account": ("account", "routing", "iban", "swift"),
    CONFIDENTIAL_RULE: ("confidential", "privileged", "attorney", "do not ", "sensitive"),
    INTERNAL_RULE: INTERNAL_TERMS,
}
# Digit runs that must occur before a number pattern can match.
_GUARD_DIGITS = {"phone": r"\d{4}", "ssn": r"\d{4}", "card": r"\d[ -]?\d[ -]?\d"}
# The only letters outside ASCII that equal an ASCII letter when case is ignored.
_FOLDED = ("\u0130\u0131\u017f\u212a", "iisk")

# Tagged entity types by tier.
CONFIDENTIAL_ENTITIES = (
    "PASSWORD", "PIN", "CREDITCARDNUMBER", "CREDITCARDCVV", "IBAN", "BIC", "ACCOUNTNUMBER",
    "MASKEDNUMBER", "BITCOINADDRESS", "ETHEREUMADDRESS", "LITECOINADDRESS",
)
INTERNAL_ENTITIES = (
    "FULLNAME", "NAME", "FIRSTNAME", "LASTNAME", "DISPLAYNAME", "ACCOUNTNAME", "USERNAME",
    "EMAIL", "CITY", "STATE", "COUNTY", "STREET", "STREETADDRESS", "BUILDINGNUMBER",
    "SECONDARYADDRESS", "ZIPCODE", "NEARBYGPSCOORDINATE", "IP", "IPV4", "IPV6", "MAC", "URL",
    "USERAGENT", "AMOUNT", "CURRENCY", "CURRENCYCODE", "CURRENCYNAME", "CURRENCYSYMBOL",
    "CREDITCARDISSUER", "NUMBER", "GENDER", "SEX", "SEXTYPE", "JOBAREA", "JOBDESCRIPTOR",
    "JOBTITLE", "JOBTYPE", "ORDINALDIRECTION",
)

FALLBACK_LABEL = "internal"


def _unicode(pattern: str) -> str:
    return f"(?U){pattern}"


def _any_word(terms: tuple[str, ...]) -> str:
    return rf"(?i)\b(?:{'|'.join(terms)})\b"


@cache
def _digit_table() -> tuple[str, str]:
    """Every decimal digit outside ASCII and the ASCII digit it stands for."""
    foreign = [
        chr(code)
        for code in range(128, sys.maxunicode + 1)
        if unicodedata.category(chr(code)) == "Nd"
    ]
    return "".join(foreign), "".join(str(unicodedata.digit(ch)) for ch in foreign)


def searched_text(title: Column, text: Column) -> Column:
    """Rules look at subject and body together."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")))


def luhn_cards(blob: Column) -> Column:
    """Card-like digit runs of ``blob`` that pass the checksum, digits only."""
    foreign, ascii_digits = _digit_table()

    def digits(run: Column) -> Column:
        return F.translate(F.regexp_replace(run, "[ -]", ""), foreign, ascii_digits)

    runs = F.regexp_extract_all(blob, F.lit(_unicode(CARD_PATTERN)), F.lit(0))
    return F.filter(F.transform(runs, digits), lambda run: F.call_function("luhn_check", run))


def folded(blob: Column) -> Column:
    """Lower-case form used by the literal guards."""
    return F.lower(F.translate(blob, *_FOLDED))


def _guarded(blob: Column, low: Column, name: str, pattern: str) -> Column:
    """Pattern test behind a cheap necessary condition; ``AND`` stops at the first false."""
    found = blob.rlike(_unicode(pattern))
    if name == "email":
        return F.contains(blob, F.lit("@")) & found
    if name in _GUARD_DIGITS:
        return blob.rlike(_unicode(_GUARD_DIGITS[name])) & found
    words = [F.contains(low, F.lit(word)) for word in _GUARD_WORDS[name]]
    return reduce(or_, words) & found


def evidence(blob: Column, low: Column | None = None) -> dict[str, Column]:
    """One boolean column per rule, named by flag (or by rule for the two word lists).

    ``low`` is ``folded(blob)``, when the caller has it as a column already.
    """
    low = folded(blob) if low is None else low
    tests = {name: _guarded(blob, low, name, regex) for name, _, regex in PII_PATTERNS}
    tests[CARD_FLAG] = _guarded(blob, low, CARD_FLAG, CARD_PATTERN) & (F.size(luhn_cards(blob)) > 0)
    for rule, terms in ((CONFIDENTIAL_RULE, CONFIDENTIAL_TERMS), (INTERNAL_RULE, INTERNAL_TERMS)):
        tests[rule] = _guarded(blob, low, rule, _any_word(terms))
    return tests


def _present(candidates: list[tuple[Column, str]]) -> Column:
    listed = F.array(*[F.when(hit, F.lit(name)) for hit, name in candidates])
    return F.filter(listed, lambda name: name.isNotNull())


def label_from_evidence(found: dict[str, Column]) -> dict[str, Column]:
    """``label``, ``pii`` and ``rules`` from already evaluated evidence columns."""
    flags = [(name, rule) for name, rule, _ in PII_PATTERNS] + [(CARD_FLAG, CARD_RULE)]
    pii = _present([(found[name], name) for name, _ in flags])
    rules = _present(
        [(found[name], rule) for name, rule in flags]
        + [(found[rule], rule) for rule in (CONFIDENTIAL_RULE, INTERNAL_RULE)]
    )
    severe = reduce(or_, [found[name] for name in HIGH_SEVERITY], found[CONFIDENTIAL_RULE])
    mild = reduce(or_, [found[name] for name, _ in flags], found[INTERNAL_RULE])
    public, internal, confidential = (F.lit(name) for name in LABELS)
    label = F.when(severe, confidential).when(mild, internal).otherwise(public)
    return {"label": label, "pii": pii, "rules": rules}


def entity_types(tags: Column) -> Column:
    """Distinct entity types of a BIO tag sequence; a ``B-`` tag opens an entity."""
    opening = F.filter(tags, lambda tag: F.startswith(tag, F.lit("B-")))
    return F.array_distinct(F.transform(opening, lambda tag: F.substr(tag, F.lit(3))))


def label_from_tags(tags: Column) -> Column:
    """Label of a tagged text; an entity type outside both tiers is an error."""

    def literal(names: tuple[str, ...]) -> Column:
        return F.array(*[F.lit(name) for name in names])

    types = entity_types(tags)
    unknown = F.array_except(types, literal(CONFIDENTIAL_ENTITIES + INTERNAL_ENTITIES))
    message = F.concat(F.lit("unknown entity types: "), F.array_join(unknown, ", "))
    return (
        F.when(F.size(unknown) > 0, F.raise_error(message).cast("string"))
        .when(F.arrays_overlap(types, literal(CONFIDENTIAL_ENTITIES)), F.lit("confidential"))
        .when(F.size(types) > 0, F.lit("internal"))
        .otherwise(F.lit("public"))
    )


def parse_label(generated: Column) -> Column:
    """First label word in free text, or null."""
    found = F.regexp_extract(generated, _unicode(rf"(?i)\b({'|'.join(LABELS)})\b"), 1)
    return F.when(found != "", F.lower(found))
