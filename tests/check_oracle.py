"""Runs registered queries next to their SQL and reports differences.

    python tests/check_oracle.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def sql_connection(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def sql_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def compare(spark, con, folder, fn, sql):
    """None when both sides agree, else a description of the first difference."""
    columns, rows = spark_rows(fn(spark, folder))
    if sql is None:
        return None if rows else "no rows"
    sql_columns, expected = sql_rows(con, sql)
    if columns != sql_columns:
        return f"columns {columns} != {sql_columns}"
    if rows == expected:
        return None if rows else "no rows on either side"
    extra = [r for r in rows if r not in set(expected)][:2]
    missing = [r for r in expected if r not in set(rows)][:2]
    return f"{len(rows)} rows vs {len(expected)}\n   spark only {str(extra)[:260]}\n   sql only {str(missing)[:260]}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from corposcope.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session("check")
    con = sql_connection(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            fault = compare(spark, con, folder, fn, oracles.get(name))
        except Exception as error:  # noqa: BLE001
            fault = f"{type(error).__name__}: {str(error)[:900]}"
        bad += fault is not None
        kind = "sql" if name in oracles else "rows"
        print(f"{'ok  ' if fault is None else 'FAIL'} {kind:4} {time.time() - start:6.2f}s {name} {fault or ''}", flush=True)
    print(f"{bad} failed of {len(queries)}")
