"""Readers of logs, results and lookup files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def read_events(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet events; no rows if the path does not exist (then a schema is needed)."""
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND" or schema is None:
            raise
        return spark.createDataFrame([], schema)


def read_flows(spark: SparkSession, path: str, input_type: str, schema: str | None = None) -> DataFrame:
    """Flows from CSV with a header or from Parquet."""
    if input_type == "csv":
        reader = spark.read.option("header", True)
        return reader.csv(path, schema=schema) if schema else reader.option("inferSchema", True).csv(path)
    if input_type == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unknown input type {input_type!r}")


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schemas.LABELLED_FLOW)


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """Scored flows: tab separated, no header, eighteen columns by position."""
    return spark.read.csv(path, sep="\t", schema=schemas.SCORED_FLOW)


def read_flow_staging(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=schemas.FLOW_STAGING)


def read_dns_staging(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=schemas.DNS_STAGING)


def flow_records(staging: DataFrame) -> DataFrame:
    """Staging rows as table rows: unix time and partition columns."""
    rows = staging.withColumn("unix_tstamp", F.unix_seconds(F.col("treceived").try_cast("timestamp")))
    return rows.withColumns({"y": F.col("tryear"), "m": F.col("trmonth"), "d": F.col("trday"), "h": F.col("trhour")})


def dns_records(staging: DataFrame) -> DataFrame:
    """Staging rows as table rows: day and time joined to one frame time."""
    at = F.timestamp_seconds("unix_tstamp")
    rows = staging.withColumn("frame_time", F.concat("frame_day", "frame_time")).drop("frame_day")
    return rows.withColumns({"y": F.year(at), "m": F.month(at), "d": F.dayofmonth(at), "h": F.hour(at)})


def read_geo(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=schemas.GEO_RANGES)


def read_context(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schemas.CONTEXT_RANGES)


def read_internal(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=schemas.INTERNAL_RANGES)


def read_top_domains(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=schemas.TOP_DOMAINS)


def read_codes(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Code table: the first columns of a CSV with a header, under the given names."""
    table = spark.read.csv(path, header=True)
    return table.toDF(*columns, *table.columns[len(columns):]).select(*columns)


def first_results(results: DataFrame, limit: int, score: str = "score", keys=()) -> DataFrame:
    """First rows of a result table in score order."""
    return results.orderBy(score, *keys).limit(limit)
