"""Backfill of legacy day folders into the partitioned tables.

The day is in the folder name (``20160708``), the hour and the address in the file
name; one read of the whole tree replaces a statement per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_days(spark: SparkSession, root: str, file_glob: str, schema: str, sep: str = "\t", header: bool = False) -> DataFrame:
    """All matching files of all day folders with the partition columns of their folder."""
    rows = spark.read.csv(f"{root}/2*/{file_glob}", sep=sep, schema=schema, header=header)
    rows = rows.withColumn("file", F.input_file_name())
    day = F.regexp_extract("file", r"/(2\d{7})/[^/]*$", 1)
    return rows.withColumns({
        "y": F.substring(day, 1, 4).cast("int"), "m": F.substring(day, 5, 2).cast("int"), "d": F.substring(day, 7, 2).cast("int"),
    })


def edge_hour(df: DataFrame) -> DataFrame:
    """Hour and minute from a file name such as ``edge-10_0_0_1-10_0_0_2-13-45.tsv``
    or ``edge-name_13_45.csv``."""
    clock = r"[-_](\d{1,2})[-_](\d{1,2})\.\w+$"
    return df.withColumns({c: F.regexp_extract("file", clock, i).try_cast("int") for i, c in ((1, "hh"), (2, "mn"))})


def file_address(df: DataFrame, prefix: str, out: str = "ip_threat") -> DataFrame:
    """Address from a file name such as ``chord-10_0_0_1.tsv``."""
    text = F.regexp_extract("file", rf"{prefix}-(\d+[_.]\d+[_.]\d+[_.]\d+)\.\w+$", 1)
    return df.withColumn(out, F.replace(text, F.lit("_"), F.lit(".")))


def scored_only(df: DataFrame, severity: str) -> DataFrame:
    """Rows an analyst has scored."""
    return df.filter(F.col(severity) > 0)


def with_response_names(df: DataFrame, names: DataFrame) -> DataFrame:
    """Response names of legacy proxy rows; '' where the code is unknown."""
    side = names.select(F.col("k").alias("respcode"), F.col("name").alias("respcode_name"))
    return df.join(side, "respcode", "left").withColumn("respcode_name", F.coalesce("respcode_name", F.lit("")))
