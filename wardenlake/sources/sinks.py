"""Writers of tables, result files and models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOUR_KEYS = ("y", "m", "d", "h")
DAY_KEYS = ("y", "m", "d")


def append_events(df: DataFrame, path: str, keys=HOUR_KEYS) -> None:
    """Append to a partitioned table. The rebalance brings the rows of a partition
    together and splits a partition that is much larger than the others."""
    df.hint("rebalance", *keys).write.mode("append").partitionBy(*keys).parquet(path)


def replace_days(df: DataFrame, path: str, keys=DAY_KEYS) -> None:
    """Write the days present in the data anew and leave the others: a run can be repeated."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def clear_day(spark, path: str, day, keys=DAY_KEYS) -> None:
    """Remove the rows of one day of a derived table, if there are any."""
    jvm = spark._jvm
    parts = (day.year, day.month, day.day)
    folder = jvm.org.apache.hadoop.fs.Path(path + "/" + "/".join(f"{k}={v}" for k, v in zip(keys, parts)))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_results(df: DataFrame, path: str, delimiter: str = "\t", header: bool = False, single_file: bool = False) -> None:
    """Delimited text. A single file is meant for a list that a limit has made short."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").csv(path, sep=delimiter, header=header)


def write_if_any(df: DataFrame, path: str) -> bool:
    """Parquet of invalid or corrupt records; nothing is written if there are none."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def corrupt_records(scored: DataFrame, score: str = "score") -> DataFrame:
    """Records whose word could not be built (error score)."""
    return scored.filter(F.col(score) == -1.0)
