"""Run queries next to their SQL: ``python -m checks.compare [sf] [name ...]``."""

from __future__ import annotations

import hashlib
import os
import sys
import time

import duckdb

from gitloom.session import scratch_scope

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _cell(value) -> str:
    if value is None or value != value:
        return "~"
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    return str(value)


def digest(columns: list[str], rows) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_cell(row[i]) for i in order) for row in rows)
    return len(lines), hashlib.md5("\n".join(lines).encode("utf-8", "replace")).hexdigest()


def compare(spark, sf: str, name: str, fn, sql: str | None) -> str:
    start = time.time()
    with scratch_scope(spark):
        df = fn(spark, sf)
        ours = digest(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - start
    if sql is None:
        return f"ROWS  {name} rows={ours[0]} {seconds:.1f}s"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    start = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    rows = result.fetchall()
    theirs = digest(names, rows)
    state = "OK   " if ours == theirs and sorted(names) == sorted(df.columns) else "FAIL "
    note = "" if state.startswith("OK") else f" spark={ours} duckdb={theirs} cols={df.columns} {names}"
    return f"{state} {name} rows={ours[0]} {seconds:.1f}s (sql {time.time() - start:.1f}s){note}"


def main(argv: list[str]) -> None:
    from checks import all_checks
    from gitloom.session import build_session

    sf = f"/root/testdata/sf{argv[0] if argv else '0.01'}"
    wanted = argv[1:]
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": os.path.abspath("spark-warehouse/_compare"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    for name, (fn, sql) in all_checks().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            print(compare(spark, sf, name, fn, sql), flush=True)
        except Exception as error:  # report and go on
            print(f"ERROR {name}: {type(error).__name__}: {str(error)[:1500]}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
