"""Run registered queries and their SQL side by side.

    python tests/compare.py [--sf 0.01] [names...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    got_names, got = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_names, want = [d[0] for d in cur.description], cur.fetchall()
    if sorted(got_names) != sorted(want_names):
        return [f"columns {sorted(got_names)} != {sorted(want_names)}"]
    a, b = _rows(got_names, got), _rows(want_names, want)
    out = [] if len(a) == len(b) else [f"rows {len(a)} != {len(b)}"]
    types = dict(df.dtypes)
    oracle_types = {d[0]: str(d[1]) for d in cur.description}
    if any("HUGEINT" in t or "DECIMAL" in t for t in oracle_types.values()):
        out.append(f"wide types in {oracle_types} / {types}")
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        out.append(f"{len(wrong)} rows differ, first {wrong[0][0]} != {wrong[0][1]}")
    if not a:
        out.append("no rows")
    return out


def main() -> None:
    import __spark_entry__ as contract
    from tidemark.session import build_session

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("names", nargs="*")
    args = args.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = build_session("compare", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": "/tmp/tidemark-warehouse",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), contract.oracle_sql()
    bad = 0
    for name, fn in contract.queries().items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            problems = differences(df, con, sqls[name]) if name in sqls else []
            note = f"{df.count()} rows" if name not in sqls else ""
        except Exception as err:
            problems, note = [str(err)[:600]], ""
        bad += bool(problems)
        mark = "FAIL" if problems else ("ok" if name in sqls else "rows")
        print(f"{mark:5} {name:26} {time.time() - start:6.2f}s {note} {problems or ''}", flush=True)
    print("failed", bad)


if __name__ == "__main__":
    main()
