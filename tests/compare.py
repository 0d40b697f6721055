"""Run registered queries and their SQL side by side and compare the results."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    """One form for values that may differ only in type."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (float, Decimal)):
        return float(f"{float(value):.9g}") + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(frame, con, sql: str) -> list[str]:
    """Empty when names and rows agree."""
    got_columns = frame.columns
    got = rows_of(got_columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    want_columns = [c[0] for c in result.description]
    want = rows_of(want_columns, result.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return [f"columns {sorted(got_columns)} != {sorted(want_columns)}"]
    if len(got) != len(want):
        extra = [r for r in got if r not in set(want)][:2]
        lost = [r for r in want if r not in set(got)][:2]
        return [f"{len(got)} rows != {len(want)}; only spark {extra}; only sql {lost}"]
    return [f"{g} != {w}" for g, w in zip(got, want, strict=True) if g != w][:3]


def main() -> int:
    folder = sys.argv[1]
    wanted = sys.argv[2:]
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from sievegate.session import build_session

    spark = build_session("compare", 8)
    con, sql = connect(folder), entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        started = time.monotonic()
        try:
            frame = run(spark, folder)
            if name in sql:
                problems = differences(frame, con, sql[name])
                kinds = dict(frame.dtypes)
                theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql[name]}").fetchall()}
                note = " ".join(f"{c}:{kinds[c]}/{theirs.get(c)}" for c in sorted(kinds))
            else:
                problems, note = [], f"rows only: {frame.count()}"
        except Exception as error:
            problems, note = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
        state = "BAD " if problems else "ok  "
        bad += bool(problems)
        print(f"{state}{name} {time.monotonic() - started:.1f}s {note}", flush=True)
        for problem in problems:
            print("     ", problem, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
