"""Run registered queries and their SQL on the same tables and compare every value.

usage: python tools/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "item"):
        return normal(value.item())
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = [tuple(normal(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False)]
    return sorted(rows, key=repr)


def connect(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return db


def compare(spark, db, query, folder: str) -> tuple[str, str]:
    started = time.time()
    result_frame = query.build(spark, folder)
    whole = {f.name for f in result_frame.schema if f.dataType.typeName() in ("integer", "long")}
    got = result_frame.toPandas()
    spark_time = time.time() - started
    if query.sql is None:
        return ("rows" if len(got) else "EMPTY"), f"{len(got)} rows {spark_time:.1f}s"
    started = time.time()
    result = db.sql(query.sql)
    want = result.df()
    note = f"{len(got)} rows {spark_time:.1f}s duckdb {time.time() - started:.1f}s"
    if sorted(got.columns) != sorted(want.columns):
        return "COLUMNS", f"only spark {set(got) - set(want)} only sql {set(want) - set(got)}"
    if len(got) != len(want):
        return "ROWS", f"spark {len(got)} sql {len(want)}"
    kinds = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got.columns}
    odd = {
        c: k
        for c, k in kinds.items()
        if k[0] != k[1]
        and not all("datetime" in x or x in ("object", "str") for x in k)
        # pandas shows whole numbers with nulls as floats
        and not (c in whole and k[1].startswith("Int"))
    }
    a, b = rows_of(got), rows_of(want)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        x, y = wrong[0]
        cells = [(c, p, q) for c, p, q in zip(sorted(got.columns), x, y) if p != q]
        return "VALUES", f"{len(wrong)} differ, e.g. {cells[:4]}"
    return ("ok" if not odd else "ok?"), note + (f" types {odd}" if odd else "")


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--skip-slow", action="store_true", help="leave out queries without SQL")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from pasarlens.registry import all_queries
    from pasarlens.session import build_session

    spark = build_session(
        "compare",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(args.sf)
    bad = 0
    for query in all_queries():
        if args.names and query.name not in args.names:
            continue
        if args.skip_slow and query.sql is None:
            continue
        try:
            verdict, note = compare(spark, db, query, args.sf)
        except Exception as error:  # report and go on with the next query
            verdict, note = "ERROR", str(error)[:600]
        bad += verdict not in ("ok", "rows")
        print(f"{verdict:8} {query.name:28} {note}", flush=True)
    print(f"{bad} not ok")
    return bad


if __name__ == "__main__":
    sys.exit(main())
