"""Runs a query on Spark and its check SQL on DuckDB, and compares names, types and all values.

``python tests/compare.py [folder] [name ...]`` checks all or the named queries and prints times.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import tempfile
import time

import duckdb
import pyarrow as pa


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(t: pa.DataType) -> str:
    return "string" if pa.types.is_large_string(t) or pa.types.is_string(t) else str(t)


def _sort_key(row):
    return tuple((v is not None, str(v)) for v in row)


def rows_of(table: pa.Table, names: list[str]):
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=_sort_key)


def differences(spark_table: pa.Table, duck_table: pa.Table) -> list[str]:
    left, right = spark_table.column_names, duck_table.column_names
    if sorted(left) != sorted(right):
        return [f"columns differ: {sorted(set(left) ^ set(right))}"]
    names = sorted(left)
    out = []
    for n in names:
        a, b = _kind(spark_table.schema.field(n).type), _kind(duck_table.schema.field(n).type)
        if a != b:
            out.append(f"type of {n}: {a} against {b}")
    if spark_table.num_rows != duck_table.num_rows:
        out.append(f"rows: {spark_table.num_rows} against {duck_table.num_rows}")
        return out
    a, b = rows_of(spark_table, names), rows_of(duck_table, names)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    for x, y in bad[:3]:
        parts = [f"{n}: {u!r} / {v!r}" for n, u, v in zip(names, x, y) if u != v]
        out.append("; ".join(parts))
    if bad:
        out.append(f"{len(bad)} rows differ")
    for row in a:
        if any(isinstance(v, float) and math.isnan(v) for v in row):
            out.append("NaN in result")
            break
    return out


def main() -> None:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tillsight-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[2:] or list(queries)
    failed = 0
    for name in wanted:
        started = time.time()
        try:
            result = queries[name](spark, folder).toArrow()
        except Exception as error:  # report and go on to the next query
            print(f"ERROR {name}: {str(error)[:600]}", flush=True)
            failed += 1
            continue
        took = time.time() - started
        if name not in sql:
            print(f"rows  {name} {took:.2f}s {result.num_rows} rows", flush=True)
            continue
        started = time.time()
        try:
            expected = con.sql(sql[name]).to_arrow_table()
        except Exception as error:
            print(f"SQL   {name}: {str(error)[:600]}", flush=True)
            failed += 1
            continue
        bad = differences(result, expected)
        failed += bool(bad)
        print(
            f"{'BAD  ' if bad else 'ok   '} {name} {took:.2f}s duck {time.time() - started:.2f}s"
            f" {result.num_rows} rows {bad if bad else ''}",
            flush=True,
        )
    from tillsight.sources.storage import release

    release(spark)
    print("missing queries:", sorted(set(sql) - set(queries)), "failed:", failed)


if __name__ == "__main__":
    main()
