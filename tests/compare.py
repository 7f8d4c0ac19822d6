"""Run registered queries in Spark and their SQL in DuckDB and compare the results."""

from __future__ import annotations

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


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if hasattr(value, "item"):
        return value.item()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(spark, con, sf_dir: str, function, sql: str | None):
    """``None`` when equal, else a short description; also the Spark row count."""
    df = function(spark, sf_dir)
    got = df.collect()
    if sql is None:
        return None, len(got)
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    want = relation.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    a, b = _rows(df.columns, got), _rows(names, want)
    if a == b:
        return None, len(got)
    extra, missing = list((a - b).items())[:2], list((b - a).items())[:2]
    return (
        f"{len(got)} rows vs {len(want)}; {sum((a - b).values())} extra {str(extra)[:400]}; "
        f"{sum((b - a).values())} missing {str(missing)[:400]}",
        len(got),
    )


def main() -> None:
    from tests.conftest import make_session
    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark, con = make_session(), duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, function in queries.items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            problem, rows = difference(spark, con, sf_dir, function, oracles.get(name))
        except Exception as error:  # noqa: BLE001
            problem, rows = f"{type(error).__name__}: {str(error)[:900]}", -1
        kind = "V" if name in oracles else "R"
        print(f"{'ok ' if problem is None else 'BAD'} {kind} {name:28s} {rows:8d} {time.time() - start:6.2f}s"
              + (f"  {problem}" if problem else ""), flush=True)
        bad += problem is not None
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
