"""Run registered queries and their SQL side by side: python tests/compare.py [folder] [name ...]"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def cell(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def kind(value) -> str:
    return type(value).__name__


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, query, sql: str, folder: str) -> str:
    """'' when equal, else what differs."""
    df = query(spark, folder)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    fetched = cur.fetchall()
    theirs = rows_of(names, fetched)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}; only one side: {sorted(set(mine) ^ set(theirs))[:4]}"
    if not mine:
        return "no rows"
    differ = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if differ:
        return f"{len(differ)} of {len(mine)} rows differ: {str(differ[0])[:600]}"
    return ""


def main() -> None:
    import __spark_entry__ as entry
    from reviewloom.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            problem = compare(spark, con, name, queries[name], oracle[name], folder) if name in oracle else f"no SQL; rows {queries[name](spark, folder).count()}"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += bool(problem)
        print(f"{'ok ' if not problem else 'BAD'} {name} {time.time() - start:.2f}s {problem}", flush=True)
    print(f"{bad} not equal")


if __name__ == "__main__":
    main()
