"""Daily jobs that write: all derived tables of a day are worked out and stored aside, then put in their places.

Nothing of the day changes before everything is worked out, and every step replaces what it had written before, so a job can be
repeated, also after it was cut off. What analysts have added for the day is cleared, as its connections may be gone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.records import on_day
from ..session import work_path
from ..sources.sinks import DAY_KEYS, clear_day
from . import daily

# Tables of analysts that a new run of the day empties.
ANALYST_TABLES = {
    "flow": ("threat_investigation", "timeline", "storyboard", "feedback"),
    "dns": ("threat_dendro", "threat_investigation", "storyboard", "feedback"),
    "proxy": ("threat_investigation", "timeline", "storyboard", "feedback"),
}

_DAYS: dict[str, Callable[..., dict[str, DataFrame]]] = {"flow": daily.flow_day, "dns": daily.dns_day, "proxy": daily.proxy_day}


def day_path(root: str, table: str, day) -> str:
    return f"{root}/{table}/" + "/".join(f"{k}={v}" for k, v in zip(DAY_KEYS, (day.year, day.month, day.day)))


def stage(tables: dict[str, DataFrame], spark: SparkSession) -> dict[str, DataFrame]:
    """The tables, each written once aside."""
    folder = work_path(spark, "day")
    for name, rows in tables.items():
        rows.drop(*DAY_KEYS).write.parquet(f"{folder}/{name}")
    return {name: spark.read.schema(rows.drop(*DAY_KEYS).schema).parquet(f"{folder}/{name}") for name, rows in tables.items()}


def commit(staged: dict[str, DataFrame], root: str, day, clear=()) -> None:
    """Put staged tables in the place of a day, empty ones too, and clear other tables of the day."""
    for name, rows in staged.items():
        rows.write.mode("overwrite").parquet(day_path(root, name, day))
        for other in clear:
            clear_day(rows.sparkSession, f"{root}/{other}", day)


def run(
    source: str, records: DataFrame, results: DataFrame, lookups: daily.Lookups, root: str, day, limit: int, whole: bool = False
) -> tuple[str, ...]:
    """Run the job of a source (flow, dns, proxy) for a day; returns the names of the tables below ``root``.

    ``whole``: the records and results are those of the day already and are not picked by their y, m, d columns.
    """
    if not whole:
        records, results = on_day(records, day), on_day(results, day)
    staged = stage(_DAYS[source](records, results, lookups, limit), records.sparkSession)
    commit(staged, root, day, [f"{source}_{name}" for name in ANALYST_TABLES[source]])
    return tuple(staged)
