"""Compare the registered queries with their SQL in DuckDB, as multisets of rows."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(normal(r[i]) for i in order) for r in rows)


def duck(sf_dir: str):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            db.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{name}')")
    return db


def compare(spark, db, sf_dir, query, sql):
    """None if equal, else a short description of the difference."""
    df = query(spark, sf_dir)
    columns, mine = as_rows(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(sql)
    other_columns, theirs = as_rows([d[0] for d in result.description], result.fetchall())
    if columns != other_columns:
        return f"columns {columns} != {other_columns}"
    if mine != theirs:
        only_mine, only_theirs = mine - theirs, theirs - mine
        return (
            f"rows {sum(mine.values())} / {sum(theirs.values())}, "
            f"only in Spark {sum(only_mine.values())} e.g. {list(only_mine)[:2]}, "
            f"only in SQL {sum(only_theirs.values())} e.g. {list(only_theirs)[:2]}"
        )
    return None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as registry
    from tidemark.session import local_session

    spark, db = local_session(8), duck(sf_dir)
    bad = 0
    for name, query in registry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            difference = compare(spark, db, sf_dir, query, registry.oracle_sql()[name])
        except Exception as error:
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += difference is not None
        print(f"{name:28s} {time.time() - started:6.2f}s {'ok' if difference is None else difference}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
