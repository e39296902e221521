"""Compare a query with its SQL on DuckDB: names, counts and values, order ignored.

Run as a script: ``python tests/oracle.py [folder] [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (Decimal, date, datetime)):
        raise TypeError(f"not portable: {value!r}")
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, query, folder: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, folder)
    got = rows_of(df.columns, df.collect())
    result = con.execute(query.sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    if not want:
        return "the SQL gives no rows"
    types_got = [type(v) for row in list(got)[:200] for v in row if v is not None]
    types_want = [type(v) for row in list(want)[:200] for v in row if v is not None]
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"{sum(got.values())} rows against {sum(want.values())}; only here {extra}; only there {missing}"
    if set(types_got) != set(types_want):
        return f"types {set(types_got)} against {set(types_want)}"
    return None


def main(argv: list[str]) -> int:
    from freightmart.catalog import QUERIES
    from freightmart.session import local_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    chosen = argv[1:] or list(QUERIES)
    spark, con, bad = local_session("oracle"), connect(folder), 0
    for name in chosen:
        start = time.time()
        try:
            problem = compare(spark, con, QUERIES[name], folder)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
