"""Run a query and its SQL twin on the same files and compare them as multisets of rows."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)
SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str:
    """Empty when schema and rows agree."""
    result = con.execute(sql)
    sql_types = {d[0]: str(d[1]) for d in result.description}
    spark_types = {name: SPARK_TO_SQL[kind] for name, kind in df.dtypes}
    sql_rows = _rows(list(sql_types), result.fetchall())
    if spark_types != sql_types:
        return f"schema: {sorted(set(spark_types.items()) ^ set(sql_types.items()))}"
    spark_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    if spark_rows == sql_rows:
        return ""
    only_spark, only_sql = spark_rows - sql_rows, sql_rows - spark_rows
    return (
        f"rows: spark {spark_rows.total()} sql {sql_rows.total()}; columns {sorted(sql_types)}; "
        f"only spark {only_spark.total()} {list(only_spark)[:2]}; only sql {only_sql.total()} {list(only_sql)[:2]}"
    )
