"""Runs registered queries against their comparison SQL. Usage: python tests/compare.py [sf] [names...]"""

from __future__ import annotations

import datetime as dt
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(value):
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return "NULL" if value is None else str(value)


def difference(frame, connection, statement: str) -> str | None:
    """None if the DataFrame and the SQL give the same columns and the same multiset of rows."""
    started = time.time()
    result = connection.execute(statement)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if time.time() - started > 2:
        print(f"    the SQL took {time.time() - started:.1f}s")
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    order = sorted(names)
    got = sorted(tuple(canonical(row[c]) for c in order) for row in frame.collect())
    want = sorted(tuple(canonical(row[names.index(c)]) for c in order) for row in expected)
    if got == want:
        return None
    missing = [r for r in want if r not in set(got)][:3]
    surplus = [r for r in got if r not in set(want)][:3]
    return f"{len(got)} rows, expected {len(want)}; columns {order}; missing {missing}; surplus {surplus}"


def main() -> int:
    import __spark_entry__ as registry
    from veilcount.session import build_session

    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    queries, oracles = registry.queries(), registry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        started = time.time()
        try:
            frame = queries[name](spark, sf_dir)
            problem = difference(frame, connection, oracles[name]) if name in oracles else f"no SQL, {frame.count()} rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        mark = "ok" if problem is None else ("--" if problem.startswith("no SQL") else "BAD")
        bad += mark == "BAD"
        print(f"{mark:4}{name:28}{time.time() - started:7.2f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
