"""Run registered queries in Spark and their oracles in DuckDB, and compare the rows."""

from __future__ import annotations

import sys
import time

import duckdb

from harness.queries import ORACLES, QUERIES
from skytally.session import build_session

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def cell(value):
    if value is None or value != value:
        return "∅"
    if isinstance(value, float):
        return f"{value:.6f}"
    return f"{type(value).__name__}:{value}"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted([tuple(cell(r[i]) for i in order) for r in rows])


def compare(spark, con, name: str, sf_dir: str, allow_empty: bool = False) -> str:
    """Empty when equal, else what differs. Two empty results count as a failure by default."""
    df = QUERIES[name](spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return "" if mine[1] else "no rows"
    cursor = con.execute(ORACLES[name])
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} vs {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows vs {len(theirs[1])}"
    if not mine[1] and not allow_empty:
        return "no rows"
    different = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    return f"{len(different)} rows differ, first {different[0]}" if different else ""


def main(sf_dir: str, only: list[str]) -> int:
    spark = build_session("compare", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in only or QUERIES:
        started = time.time()
        try:
            found = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(found)
        kind = "oracle" if name in ORACLES else "rows"
        print(f"{'BAD' if found else 'ok '} {name} [{kind}] {time.time() - started:.1f}s {found}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
