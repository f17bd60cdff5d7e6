"""Run registered queries beside their SQL and compare rows.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter
from datetime import date, datetime

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _plain(value):
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def _bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


_KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
}


def compare(df, con, sql: str) -> tuple[int, str]:
    """Row count and a description of the first difference, empty if equal."""
    rows = df.collect()
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected = found.fetchall()
    if sorted(names) != sorted(df.columns):
        return len(rows), f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {d[0]: str(d[1]) for d in found.description}
    for name, kind in df.dtypes:
        if _KINDS.get(kinds[name], kinds[name]) != kind:
            return len(rows), f"type of {name}: {kind} != {kinds[name]}"
    ours, theirs = _bag(rows, df.columns), _bag(expected, names)
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        return len(rows), (
            f"{len(rows)} rows vs {len(expected)}; {sum(extra.values())} differ, "
            f"e.g. {next(iter(extra), None)} vs {next(iter(missing), None)}"
        )
    return len(rows), ""


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv[1:] or list(queries):
        started = time.time()
        con = duck(folder)
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                n, problem = compare(df, con, oracles[name])
            else:
                n, problem = len(df.collect()), ""
        except Exception as error:  # noqa: BLE001 - report and go on
            n, problem = -1, f"{type(error).__name__}: {str(error)[:400]}"
        bad += bool(problem)
        mark = "FAIL" if problem else "ok" if name in oracles else "rows"
        print(f"{mark:5}{name:32}{n:8} rows {time.time() - started:6.2f}s {problem}", flush=True)
    print(f"{len(argv[1:] or queries)} queries, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
