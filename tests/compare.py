"""Run a query on Spark and its SQL on DuckDB and compare rows as multisets."""

import datetime as dt
import decimal
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

FAMILIES = {"TINYINT": "int", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double",
            "VARCHAR": "string", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
            "BOOLEAN": "boolean"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str:
    """Empty when equal, else a short description."""
    start = time.time()
    rows = spark_df.collect()
    spark_time = time.time() - start
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: FAMILIES.get(str(d[1]), str(d[1])) for d in result.description}
    expected = multiset(columns, result.fetchall())
    difference.times = spark_time, time.time() - start - spark_time
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    have = {f.name: f.dataType.simpleString() for f in spark_df.schema}
    if have != types:
        odd = {c: (have[c], types[c]) for c in have if have[c] != types[c]}
        return f"types (spark, sql): {odd}"
    actual = multiset(spark_df.columns, rows)
    if actual != expected:
        return (
            f"{sum(actual.values())} rows against {sum(expected.values())}; only spark "
            f"{list((actual - expected).items())[:3]}; only sql {list((expected - actual).items())[:3]}"
        )
    return ""
