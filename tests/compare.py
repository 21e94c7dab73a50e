"""Run queries in Spark and DuckDB and compare columns and values.

``python tests/compare.py SF_DIR [query ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


# DuckDB name of each Spark type the queries return.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple((type(_plain(r[i])).__name__, _plain(r[i])) for i in order) for r in rows)


def compare(df, con, sql) -> list[str]:
    """Differences between a DataFrame and a DuckDB query; none when they agree."""
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want_types = {d[0]: str(d[1]) for d in result.description}
    got_types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    want = _rows(want_columns, result.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if sorted(df.columns) != sorted(want_columns):
        problems.append(f"columns {df.columns} != {want_columns}")
    elif got_types != want_types:
        problems.append(f"types {set(got_types.items()) ^ set(want_types.items())}")
    if got != want:
        problems.append(
            f"{got.total()} rows against {want.total()}; only in Spark {list((got - want).items())[:2]}; "
            f"only in DuckDB {list((want - got).items())[:2]}"
        )
    return [str(p)[:1500] for p in problems]


def main() -> int:
    from session import start

    import __spark_entry__ as registry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con, oracle = start(), connect(sf_dir), registry.oracle_sql()
    failed = 0
    for name, query in registry.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        df = query(spark, sf_dir)
        if name in oracle:
            problems = compare(df, con, oracle[name])
            verdict = "; ".join(problems) or "match"
            failed += bool(problems)
        else:
            verdict = f"{len(df.collect())} rows"
        print(f"{name:28s} {time.time() - begin:6.1f}s  {verdict}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
