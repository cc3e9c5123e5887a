"""Run registered queries and their check SQL side by side.  Usage: python -m tests.compare SF_DIR [name ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from decimal import Decimal

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(norm(v) for v in value)
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark, con, name: str, fn, check: str | None, sf_dir: str) -> str:
    df = fn(spark, sf_dir)
    cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if check is None:
        return f"rows-only {len(got)}"
    cur = con.execute(check)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if cols != want_cols:
        return f"MISMATCH columns {cols} vs {want_cols}"
    if len(got) != len(want):
        return f"MISMATCH rows {len(got)} vs {len(want)}"
    diffs = [(g, w) for g, w in zip(got, want) if g != w]
    if diffs:
        return f"MISMATCH values {len(diffs)}/{len(got)} {cols}\n   spark {diffs[0][0]}\n   duck  {diffs[0][1]}"
    return f"ok {len(got)}"


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from bankweave.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, checks = duck(sf_dir), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        started = time.time()
        try:
            result = compare(spark, con, name, queries[name], checks.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            result = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
        bad += result.startswith(("MISMATCH", "ERROR"))
        print(f"{name:32s} {time.time() - started:6.2f}s {result}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
