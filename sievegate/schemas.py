"""Declared table layouts and the drift check applied around every write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

LABELS = ("public", "internal", "confidential")


_TEXT, _INT, _REAL = T.StringType(), T.IntegerType(), T.DoubleType()
_TEXTS, _VECTOR = T.ArrayType(_TEXT), T.ArrayType(T.FloatType())


def _table(nullable: bool, **columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t in columns.items()])


CORPUS = _table(
    False, doc_id=_TEXT, thread_id=_TEXT, split=_TEXT, title=_TEXT, chunk_ord=_INT, text=_TEXT,
    char_len=_INT,
)
WEAK_LABELS = _table(False, doc_id=_TEXT, chunk_ord=_INT, label=_TEXT, pii=_TEXTS, rules=_TEXTS)
GOLD = _table(
    True, doc_id=_TEXT, chunk_ord=_INT, text=_TEXT, title=_TEXT, weak_label=_TEXT, weak_pii=_TEXTS,
    gold_label=_TEXT, note=_TEXT,
)
VECTORS = _table(True, doc_id=_TEXT, chunk_ord=_INT, vector=_VECTOR)
DOCUMENTS = _table(
    False, id=_TEXT, source=_TEXT, title=_TEXT, modality=_TEXT, lang=_TEXT, thread_id=_TEXT,
    label=_TEXT, allowed_roles=_TEXTS,
)
CHUNKS = _table(True, id=_TEXT, doc_id=_TEXT, ord=_INT, text=_TEXT, embedding=_VECTOR)
FROZEN_QUERIES = _table(True, qid=_TEXT, kind=_TEXT, text=_TEXT, relevant_doc=_TEXT)
EVAL_ROWS = _table(
    True, doc_id=_TEXT, chunk_ord=_INT, title=_TEXT, text=_TEXT, gold_label=_TEXT, gold=_TEXT,
    split=_TEXT, weak_label=_TEXT, weak_pii=_TEXTS, note=_TEXT,
)
PREDICTIONS = _table(
    True,
    config=_table(True, method=_TEXT, cost_per_1k_usd=_REAL, cost_usd_per_1k=_REAL),
    rows=T.ArrayType(
        _table(
            True, doc_id=_TEXT, chunk_ord=_INT, gold=_TEXT, pred=_TEXT,
            probs=T.MapType(_TEXT, _REAL), latency_ms=_REAL,
        )
    ),
)


class SchemaDrift(ValueError):
    """A DataFrame does not have the declared columns."""


def _signature(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, type(f.dataType).__name__) for f in schema.fields]


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Return ``df`` unchanged when names and type classes match; nullability is free."""
    got, want = _signature(df.schema), _signature(expected)
    if got != want:
        raise SchemaDrift(f"columns are {got}, declared {want}")
    return df
