"""Run named queries next to their SQL equivalents in DuckDB and compare the rows."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
ALIASES = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    return value


def difference(spark_df, connection, sql: str) -> str | None:
    """None if names, types and rows agree, else what differs."""
    result = connection.execute(sql)
    theirs = {d[0]: ALIASES.get(str(d[1]), str(d[1])) for d in result.description}
    expected = result.fetchall()
    ours = dict(spark_df.dtypes)
    if sorted(ours) != sorted(theirs):
        return f"columns differ: only here {sorted(set(ours) - set(theirs))}, only there {sorted(set(theirs) - set(ours))}"
    names = sorted(ours)
    wrong_types = [(n, ours[n], theirs[n]) for n in names if ours[n] != theirs[n]]
    at = {n: k for k, n in enumerate(theirs)}
    want = Counter(tuple(cell(row[at[n]]) for n in names) for row in expected)
    got = Counter(tuple(cell(row[n]) for n in names) for row in spark_df.select(*[f"`{n}`" for n in names]).collect())
    if got != want:
        extra, lost = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"rows differ: {sum(got.values())} here, {sum(want.values())} there\n   columns {names}\n   extra {extra}\n   lost  {lost}"
    if wrong_types:
        return f"types differ: {wrong_types}"
    return None


def main(folder: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    from matchday.registry import Inputs, load

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name, query in load().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query.run(Inputs(spark, folder))
            if query.sql:
                problem = difference(df, connection, query.sql)
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} of {len(load()) if not names else len(names)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
