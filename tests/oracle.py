"""Compare a Spark result with the result of a SQL text in DuckDB."""

import math
from decimal import Decimal

import duckdb

from wardenlake.sources.adapters import BASE_TABLES


def connect(sf_dir):
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"create view {name} as from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = int(value) if value == int(value) else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def sorted_rows(table, names):
    return sorted(zip(*[[plain(v) for v in table.column(n).to_pylist()] for n in names]))


def compare(spark_table, con, sql):
    """None if equal, else a text that says what differs."""
    other = con.sql(sql).to_arrow_table()
    names = sorted(spark_table.schema.names)
    if names != sorted(other.schema.names):
        return f"columns {names} and {sorted(other.schema.names)}"
    ours, theirs = sorted_rows(spark_table, names), sorted_rows(other, names)
    if ours == theirs:
        return None
    return f"{len(ours)} and {len(theirs)} rows; only ours {sorted(set(ours) - set(theirs))[:2]}; only theirs {sorted(set(theirs) - set(ours))[:2]}"
