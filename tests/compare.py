"""Run registered queries against DuckDB on the same tables: ``python tests/compare.py SF [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else ("f", round(value, 5) + 0.0)
    if hasattr(value, "item"):
        return normal(value.item())
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, int):
        return ("f", float(value))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(normal(r[i]) for i in order) for r in rows)


def oracle_connection(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def compare(spark, connection, sf_dir, name, function, sql) -> tuple[bool, str]:
    started = time.time()
    df = function(spark, sf_dir)
    got = df.collect()
    took = time.time() - started
    columns, mine = rows_of(df.columns, [tuple(r) for r in got])
    if sql is None:
        return True, f"{name}: {len(got)} rows, no SQL ({took:.1f}s)"
    result = connection.execute(sql)
    their_columns = [d[0] for d in result.description]
    columns2, theirs = rows_of(their_columns, result.fetchall())
    if columns != columns2:
        return False, f"{name}: columns {columns} != {columns2}"
    if mine != theirs:
        only_mine = list((mine - theirs).items())[:2]
        only_theirs = list((theirs - mine).items())[:2]
        return False, (
            f"{name}: rows {sum(mine.values())} vs {sum(theirs.values())} columns {columns}\n"
            f"   spark only {only_mine}\n   sql only   {only_theirs}"
        )
    return True, f"{name}: {len(got)} rows ({took:.1f}s)"


def main() -> int:
    import __spark_entry__ as entry
    from lakemart.session import build_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", 8, {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, function in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        try:
            ok, text = compare(spark, connection, sf_dir, name, function, oracles.get(name))
        except Exception as error:  # report and go on to the next query
            ok, text = False, f"{name}: {type(error).__name__}: {str(error)[:700]}"
        bad += not ok
        print("ok  " if ok else "FAIL", text, flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
