"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return 0.0 if value == 0 else value
    if isinstance(value, bytearray):
        return bytes(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def kind(type_name: str) -> str:
    """Coarse type so that bigint and BIGINT, double and DOUBLE agree."""
    t = type_name.lower()
    for family, names in {
        "int": ("tinyint", "smallint", "int", "integer", "bigint", "hugeint", "decimal(20,0)", "long", "utinyint", "ubigint"),
        "float": ("double", "float", "real"),
        "text": ("string", "varchar"),
        "bool": ("boolean",),
        "bytes": ("binary", "blob"),
    }.items():
        if t in names:
            return family
    return t


def compare(con, df, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    spark_rows = df.collect()
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    types = dict(zip(names, (str(d[1]) for d in found.description)))
    rows = found.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} <> {sorted(names)}"
    ours = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    off = {n: (ours[n], types[n]) for n in names if kind(ours[n]) != kind(types[n])}
    if off:
        return f"types {off}"
    order = sorted(names)
    left = sorted((tuple(plain(r[n]) for n in order) for r in spark_rows), key=repr)
    at = [names.index(n) for n in order]
    right = sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)
    if len(left) != len(right):
        return f"rows {len(left)} <> {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"values {dict(zip(order, a))} <> {dict(zip(order, b))}"
    return None if left else "no rows"


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = "/root/testdata/sf0.01"
    only = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            problem = compare(con, df, oracle[name]) if name in oracle else f"no SQL, {df.count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        if problem and name in oracle:
            bad += 1
        print(f"{'ok ' if not problem else 'BAD' if name in oracle else '-- '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
