"""Run queries against their SQL in DuckDB: ``python tests/compare.py <folder> [query …]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def rows(columns: list[str], values) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in values)


def differences(df, con, sql: str) -> str:
    """Empty when both give the same columns, types and bag of rows."""
    answer = con.execute(sql)
    names = [c[0] for c in answer.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    kinds = {c[0]: str(c[1]) for c in answer.description}
    odd = {c: (kind, kinds[c]) for c, kind in df.dtypes if TYPES.get(kind) != kinds[c]}
    if odd:
        return f"types {odd}"
    want = rows(names, answer.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        return ""
    more, less = got - want, want - got
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; "
        f"only here {list(more.items())[:2]}; only there {list(less.items())[:2]}"
    )


def main() -> None:
    from conftest import build_session

    import __spark_entry__ as entry

    spark, con = build_session(), connect(sys.argv[1])
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = query(spark, sys.argv[1])
            result = differences(df, con, oracles[name]) if name in oracles else "no SQL"
        except Exception as e:  # report and go on with the next query
            result = f"{type(e).__name__}: {str(e)[:900]}"
        print(f"{name:28} {time.time() - start:6.2f}s {result or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
