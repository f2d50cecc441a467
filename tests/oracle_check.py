"""Runs named queries and their SQL side by side.

``python -m tests.oracle_check [data folder] [query…]``
"""

from __future__ import annotations

from collections import Counter
from decimal import Decimal
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return value


def rows_of(names: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df) -> tuple[list[str], Counter]:
    return rows_of(df.columns, df.collect())


def sql_rows(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = db.execute(sql)
    return rows_of([c[0] for c in result.description], result.fetchall())


def main(folder: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from prefkit.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    db, sql, failed = connect(folder), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            columns, mine = spark_rows(run(spark, folder))
            took = time.time() - started
            if name not in sql:
                print(f"rows  {name:26s} {sum(mine.values()):7d} {took:6.2f}s", flush=True)
                continue
            started = time.time()
            names, theirs = sql_rows(db, sql[name])
            sql_took = time.time() - started
            same = columns == names and mine == theirs
            print(f"{'ok   ' if same else 'DIFF '} {name:26s} {sum(mine.values()):7d} {took:6.2f}s  sql {sql_took:6.2f}s", flush=True)
            if not same:
                failed += 1
                print("  columns", columns, names, "rows", sum(mine.values()), sum(theirs.values()))
                for side, extra in (("spark", mine - theirs), ("sql", theirs - mine)):
                    print("  only", side, sum(extra.values()), [tuple(str(v)[:90] for v in r) for r in list(extra)[:2]])
        except Exception:
            failed += 1
            print("FAIL ", name, flush=True)
            print("   ", "\n    ".join(traceback.format_exc().splitlines()[-14:])[:1800])
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(min(main(args[0] if args else "/root/testdata/sf0.01", args[1:]), 1))
