"""Compare every registered query with its SQL in DuckDB: ``python tests/sql_check.py <sf_dir> [name ...]``."""

from __future__ import annotations

import datetime as dt
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple[str, ...]]:
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in at) for row in rows)


def difference(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when both engines agree on columns, rows and values."""
    frame = query(spark, sf_dir)
    found = rows_of(frame.columns, frame.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted = rows_of(names, cursor.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(found) != len(wanted):
        return f"{len(found)} rows, SQL gives {len(wanted)}"
    for mine, theirs in zip(found, wanted):
        if mine != theirs:
            pairs = [(n, a[:80], b[:80]) for n, a, b in zip(sorted(names), mine, theirs) if a != b]
            return f"first difference: {pairs}"
    return None if found else "no rows"


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from chatpulse.session import build_session

    sf_dir, chosen = argv[0], argv[1:]
    spark = build_session(
        "chatpulse-check", master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if name not in sqls:
            continue
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            problem = difference(spark, con, sf_dir, query, sqls[name])
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:24s} {time.time() - started:6.1f}s  {problem or 'equal'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
