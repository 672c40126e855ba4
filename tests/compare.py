"""Run registered queries against their DuckDB SQL: ``python -m tests.compare [sf_dir] [keys…]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((repr(tuple(_value(r[i]) for i in order)) for r in rows))


def difference(spark_df, con, sql) -> str | None:
    """None when rows, names and values agree, otherwise what differs."""
    got_names, got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_names, want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"first difference\n  got  {g}\n  want {w}"
    return None


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as e
    from tablewarden.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), e.oracle_sql(), 0
    for key, run in e.queries().items():
        if argv[1:] and key not in argv[1:]:
            continue
        start = time.time()
        try:
            if key in sql:
                diff = difference(run(spark, sf_dir), con, sql[key])
                note = "ok" if diff is None else diff
            else:
                diff, note = None, f"no oracle, {run(spark, sf_dir).count()} rows"
        except Exception as err:  # report and go on with the next key
            diff = note = f"{type(err).__name__}: {str(err)[:600]}"
        bad += diff is not None
        print(f"{key:28s} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
