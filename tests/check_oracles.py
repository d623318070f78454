"""Run queries and their SQL side by side: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def compare(df, con, sql: str) -> str | None:
    """None when both sides hold the same rows under the same columns, else what differs."""
    relation = con.execute(sql)
    sql_columns = [d[0] for d in relation.description]
    expected = relation.fetchall()
    if sorted(df.columns) != sorted(sql_columns):
        return f"columns {sorted(df.columns)} != {sorted(sql_columns)}"
    order = [sql_columns.index(c) for c in df.columns]
    got = Counter(tuple(_plain(v) for v in row) for row in df.collect())
    want = Counter(tuple(_plain(row[i]) for i in order) for row in expected)
    if got == want:
        return None
    return f"rows {sum(got.values())} != {sum(want.values())}; extra {list((got - want))[:3]}; lacking {list((want - got))[:3]}"


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    spark, con, failures = make_session(), connect(sf_dir), 0
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        df = fn(spark, sf_dir)
        problem = compare(df, con, oracles[name]) if name in oracles else f"no SQL, {df.count()} rows"
        failures += problem is not None
        print(f"{name:30s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    return failures


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(main(args[0] if args else "/root/testdata/sf0.01", args[1:]))
