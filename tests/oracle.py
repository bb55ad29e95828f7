"""Run registered queries against their SQL and compare row by row."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    if isinstance(value, float):
        if math.isnan(value) or math.isinf(value):
            return f"bad:{value}"
        return repr(value + 0.0) if value != int(value) else repr(float(value))
    if isinstance(value, int):
        return str(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return f"{type(value).__name__}:{value}"


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows),
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def compare(df, con, sql: str) -> list[str]:
    """Differences between a frame and the SQL result; empty when equal."""
    got = [tuple(row) for row in df.collect()]
    relation = con.sql(sql)
    problems = []
    if sorted(df.columns) != sorted(relation.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(relation.columns)}"]
    want = relation.fetchall()
    if len(got) != len(want):
        problems.append(f"rows {len(got)} vs {len(want)}")
    if not want:
        problems.append("the oracle has no rows")
    a, b = _sorted_rows(df.columns, got), _sorted_rows(relation.columns, want)
    differing = [(x, y) for x, y in zip(a, b) if x != y]
    if differing:
        problems.append(f"{len(differing)} rows differ, first {differing[:2]}")
    kinds = dict(zip(relation.columns, (str(t) for t in relation.types)))
    for name, dtype in df.dtypes:
        expected = {
            "bigint": ("BIGINT",), "int": ("INTEGER",), "double": ("DOUBLE",), "string": ("VARCHAR",),
            "boolean": ("BOOLEAN",),
        }.get(dtype)
        if expected and kinds[name] not in expected:
            problems.append(f"type of {name}: {dtype} vs {kinds[name]}")
    return problems


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracles = entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in oracles:
                problems = compare(df, con, oracles[name])
            else:
                problems = [] if df.collect() else ["no rows"]
        except Exception as error:  # report and go on
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        kind = "sql " if name in oracles else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {kind} {name} {time.time() - start:.2f}s", *problems, flush=True)
    print("failed", failed)


if __name__ == "__main__":
    main()
