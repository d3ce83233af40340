"""Run queries on Spark and their SQL on DuckDB and compare sorted rows.

    python -m workload.compare <data dir> [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from hitloom import build_session
from workload.oracles import ORACLES
from workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return str(value)
    return str(value)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(tuple(_cell(row[k]) for k in order) for row in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    took = time.time() - started
    started = time.time()
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    note = f"{len(got)} rows, spark {took:.1f}s, duckdb {time.time() - started:.1f}s"
    if sorted(names) != sorted(df.columns):
        return False, f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    if got != want:
        extra, lost = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
        return False, f"{len(got)} / {len(want)} rows\n   spark only {extra}\n   duckdb only {lost}"
    return True, note


def main(sf_dir: str, *chosen: str) -> int:
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in chosen or QUERIES:
        try:
            same, note = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            same, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not same
        print("ok  " if same else "FAIL", name, note, flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
