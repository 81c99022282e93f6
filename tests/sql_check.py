"""Runs registered queries against their SQL on DuckDB and compares columns, types and rows.

``python tests/sql_check.py [folder] [name ...]``
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TYPES = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        if file.endswith(".parquet"):
            con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM read_parquet('{folder}/{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    ours = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(set(ours) ^ set(theirs))}"
    wrong = {c: (ours[c], theirs[c]) for c in ours if TYPES.get(theirs[c], theirs[c]) != ours[c]}
    if wrong:
        return f"types {wrong}"
    names, order = sorted(ours), list(theirs)
    at = [order.index(n) for n in names]
    expected = Counter(tuple(_plain(row[i]) for i in at) for row in rows)
    got = Counter(tuple(_plain(row[n]) for n in names) for row in spark_df.collect())
    if expected == got:
        return None if rows else "no rows on either side"
    extra, missing = list((got - expected).elements()), list((expected - got).elements())
    key = lambda row: tuple(str(v) for v in row)
    return (
        f"rows {sum(got.values())} against {len(rows)}; {len(extra)} extra, {len(missing)} missing; {names}\n"
        f"    extra   {sorted(extra, key=key)[:2]}\n    missing {sorted(missing, key=key)[:2]}"
    )


def main() -> int:
    from wattloom.catalog import all_queries, all_sql
    from wattloom.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "sql-check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failures = connect(folder), all_sql(), 0
    for name, run in all_queries().items():
        if wanted and not any(name == w or name.startswith(w + "_") for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            problem = compare(df, con, sqls[name]) if name in sqls else (None if df.count() else "no rows")
        except Exception as error:  # noqa: BLE001 - one broken query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
