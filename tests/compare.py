"""Side-by-side check of registered queries: ``python -m tests.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, dict):
        return sorted((k, plain(v)) for k, v in value.items())
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def kind(value: object) -> str:
    return "none" if value is None else type(value).__name__


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[str | None, int]:
    """What differs, or None, and the number of rows."""
    rows = df.collect()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(rows)
    order = sorted(names)
    left = sorted(([plain(r[c]) for c in order] for r in rows), key=repr)
    right = sorted(([plain(dict(zip(names, r))[c]) for c in order] for r in expected), key=repr)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}", len(left)
    for a, b in zip(left, right):
        if a != b:
            return f"first difference in {order}\n  spark {str(a)[:700]}\n  duck  {str(b)[:700]}", len(left)
        if [kind(x) for x in a] != [kind(x) for x in b]:
            return f"types {[kind(x) for x in a]} != {[kind(x) for x in b]}", len(left)
    return None, len(left)


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        begin = time.time()
        try:
            if name in sqls:
                problem, count = difference(build(spark, sf_dir), con, sqls[name])
            else:
                problem, count = None, build(spark, sf_dir).count()
        except Exception as error:  # noqa: BLE001 - every query is reported
            problem, count = f"{type(error).__name__}: {str(error)[:900]}", -1
        bad += problem is not None
        note = "" if name in sqls else " (rows only)"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name}{note} rows={count} {time.time() - begin:.1f}s", flush=True)
        if problem:
            print("    ", problem, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
