"""Compare queries with their SQL: python tests/check_oracle.py [--sf 0.01] [name ...]"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(value + 0.0)
    return f"{type(value).__name__}:{value}"


def table_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None where both agree, else what differs."""
    got_columns, got = table_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_columns, want = table_of([c[0] for c in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    different = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(different)} rows differ, first {different[0]}" if different else None


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--twice", action="store_true")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from panelloom.plans.driver_queries import ORACLE, QUERIES
    from panelloom.session import get_session

    spark = get_session(
        "check", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                                "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{args.sf}"
    con = connect(sf_dir)
    names = [n for n in QUERIES if not args.names or any(n.startswith(a) for a in args.names)]
    failed = 0
    for name in names:
        try:
            start = time.time()
            if args.twice:
                QUERIES[name](spark, sf_dir).collect()
                start = time.time()
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                problem = compare(df, con, ORACLE[name])
            else:
                problem = f"no SQL, {len(df.collect())} rows"
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {' '.join(str(error).split())[:300]}"
        failed += bool(problem and not problem.startswith("no SQL"))
        print(f"{name:55s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{len(names)} queries, {failed} failed")


if __name__ == "__main__":
    main()
