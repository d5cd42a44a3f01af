"""Run queries and their oracle SQL side by side and report differences.

usage: python tools/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from oracle import oracle_queries  # noqa: E402
from wardline.context import build_session  # noqa: E402
from wardline.plans.registry import all_queries  # noqa: E402


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if isinstance(v, float) and math.isnan(v):
            return "NaN"
        return f"{type(v).__name__}:{v!r}"

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, con, folder, name, build, sql) -> tuple[str, float, float]:
    t0 = time.time()
    df = build(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return f"rows only ({len(rows)})", t1 - t0, 0.0
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    t2 = time.time()
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {sorted(set(names) ^ set(df.columns))}", t1 - t0, t2 - t1
    mine, theirs = normal(rows, df.columns), normal(expected, names)
    if mine == theirs:
        return f"ok ({len(rows)})", t1 - t0, t2 - t1
    a, b = set(mine) - set(theirs), set(theirs) - set(mine)
    sample = "\n   spark  ".join([""] + [str(x) for x in sorted(a)[:2]])
    sample += "\n   oracle ".join([""] + [str(x) for x in sorted(b)[:2]])
    return f"DIFF {len(rows)} vs {len(expected)} rows{sample}", t1 - t0, t2 - t1


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", 8, **{"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    oracle = oracle_queries()
    bad = 0
    for name, build in all_queries().items():
        if wanted and name not in wanted:
            continue
        try:
            verdict, mine, theirs = compare(spark, con, folder, name, build, oracle.get(name))
        except Exception as error:  # noqa: BLE001 - report and go on
            verdict, mine, theirs = f"ERROR {str(error)[:700]}", 0.0, 0.0
        bad += not verdict.startswith(("ok", "rows only"))
        print(f"{name:28s} {mine:6.2f}s {theirs:6.2f}s  {verdict}", flush=True)
    print(f"{bad} of {len(wanted) or len(all_queries())} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
