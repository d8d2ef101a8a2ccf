"""Compare every query with its SQL on DuckDB: names, types, row count, values.

    python -m tests.oracle_check [folder] [query ...]
"""

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("number", format(value.normalize(), "f"))
    if isinstance(value, float):
        return ("number", "nan" if math.isnan(value) else repr(round(value, 9)))
    if isinstance(value, dt.datetime):
        return ("time", value.isoformat())
    return (type(value).__name__, str(value))


def _family(type_name: str) -> str:
    name = type_name.lower()
    for family, words in {
        "integer": ("int", "hugeint"),
        "double": ("double", "float"),
        "text": ("string", "varchar"),
        "boolean": ("bool",),
        "date": ("date",),
    }.items():
        if any(word in name for word in words):
            return family
    return name.replace(" ", "")


def compare(spark, con, query, sql, folder) -> list[str]:
    """What differs; empty when nothing does."""
    df = query(spark, folder)
    names = sorted(df.columns)
    left = sorted(tuple(_plain(v) for v in row) for row in df.select(*names).collect())
    cursor = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(types) != names:
        return [f"columns {names} against {sorted(types)}"]
    problems = []
    for name, spark_type in df.dtypes:
        if _family(spark_type) != _family(types[name]):
            problems.append(f"{name}: {spark_type} against {types[name]}")
    position = [list(types).index(name) for name in names]
    right = sorted(tuple(_plain(row[p]) for p in position) for row in cursor.fetchall())
    if len(left) != len(right):
        problems.append(f"{len(left)} rows against {len(right)}")
    elif left != right:
        first = next((a, b) for a, b in zip(left, right) if a != b)
        n = sum(a != b for a, b in zip(left, right))
        problems.append(f"{n} rows differ, first: {first}")
    if not left:
        problems.append("no rows")
    return problems


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(contract.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in wanted:
        began = time.time()
        try:
            sql = contract.oracle_sql().get(name)
            problems = compare(spark, con, contract.queries()[name], sql, folder)
        except Exception as error:  # one query must not hide the others
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{name:24} {time.time() - began:6.2f}s {'ok' if not problems else problems}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
