"""Run registered queries against DuckDB and report differences."""

from __future__ import annotations

import datetime
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{d}/{name}.parquet')")
    return con


def canon(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def types(kind: str) -> str:
    kind = kind.lower()
    return {
        "long": "bigint", "integer": "int", "varchar": "string", "str": "string", "hugeint": "HUGE",
        "number": "double",
    }.get(kind, kind)


def compare(spark, con, fn, sql: str, d: str) -> str | None:
    """None if both agree, else what differs."""
    df = fn(spark, d)
    names = sorted(df.columns)
    rows = Counter(tuple(canon(r[n]) for n in names) for r in df.collect())
    got = con.execute(sql)
    heads = [c[0] for c in got.description]
    if sorted(heads) != names:
        return f"columns {names} / {sorted(heads)}"
    kinds = {c[0]: types(str(c[1])) for c in got.description}
    ours = {n: types(t) for n, t in df.dtypes}
    mixed = {n: (ours[n], kinds[n]) for n in names if ours[n] != kinds[n]}
    at = [heads.index(n) for n in names]
    want = Counter(tuple(canon(r[i]) for i in at) for r in got.fetchall())
    if rows != want:
        extra, missing = rows - want, want - rows
        return (
            f"rows {sum(rows.values())} / {sum(want.values())}; extra {sum(extra.values())}: "
            f"{str(list(extra)[:2])[:600]}; missing {sum(missing.values())}: {str(list(missing)[:2])[:600]}"
        )
    if mixed:
        return f"types {mixed}"
    return None


def main() -> None:
    import __spark_entry__ as e
    from foliant.session import session

    d = sys.argv[1]
    only = sys.argv[2:]
    spark = session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(d)
    oracle = e.oracle_sql()
    bad = 0
    for name, fn in e.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in oracle:
                diff = compare(spark, con, fn, oracle[name], d)
                rows = ""
            else:
                rows, diff = f"{fn(spark, d).count()} rows, no SQL", None
        except Exception as error:  # report and go on
            diff = f"{type(error).__name__}: {str(error)[:900]}"
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name} {time.time() - start:.1f}s {rows if diff is None else diff}", flush=True)
    print(f"{bad} of {len(e.queries())} differ")


if __name__ == "__main__":
    main()
