"""Streaming ingest of proxy lines, flow files and DNS files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from .. import schemas
from ..functions.texts import is_log_line, log_tokens
from ..sources.files import dns_records, flow_records

# Token position of each proxy column, in column order.
PROXY_TOKENS = {
    "p_date": 0, "p_time": 1, "clientip": 3, "host": 15, "reqmethod": 12, "useragent": 20, "resconttype": 13, "duration": 2,
    "username": 4, "authgroup": 5, "exceptionid": 6, "filterresult": 7, "webcat": 8, "referer": 9, "respcode": 10,
    "action": 11, "urischeme": 14, "uriport": 16, "uripath": 17, "uriquery": 18, "uriextension": 19, "serverip": 21,
    "scbytes": 22, "csbytes": 23, "virusid": 24, "bcappname": 25, "bcappoper": 26,
}
_NUMBERS = ("duration", "scbytes", "csbytes")


def proxy_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """Log lines (one or more per message) to the 32 proxy columns."""
    line = F.explode(F.split(column, "\n")).alias("line")
    rows = lines.select(line).filter(is_log_line(F.col("line")))
    clean = F.replace(F.regexp_replace("line", r"^\r+|\r+$", ""), F.lit("\t"), F.lit(" "))
    clean = F.replace(clean, F.lit("  "), F.lit(" "))
    tokens = rows.select(log_tokens(clean).alias("t")).filter(F.size("t") > 1)

    def token(i: int) -> Column:
        return F.get("t", F.lit(i))

    def column_of(name: str) -> Column:
        value = token(PROXY_TOKENS[name])
        return (value.try_cast("int") if name in _NUMBERS else value).alias(name)

    def longer_than_one(i: int) -> Column:
        return F.when(F.length(token(i)) > 1, token(i)).otherwise(F.lit(""))

    day = F.split(token(0), "-")
    two = lambda c: F.lpad(c, 2, "0")
    return tokens.select(
        *[column_of(c) for c in PROXY_TOKENS],
        F.concat(token(15), longer_than_one(17), longer_than_one(18)).alias("fulluri"),
        F.get(day, F.lit(0)).alias("y"),
        two(F.get(day, F.lit(1))).alias("m"),
        two(F.get(day, F.lit(2))).alias("d"),
        two(F.get(F.split(token(1), ":"), F.lit(0))).alias("h"),
    ).select(*schemas.PROXY_COLUMNS)


def line_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Lines of text files that arrive in a folder."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Lines of a Kafka topic (needs the Kafka package of Spark)."""
    rows = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return rows.select(F.col("value").cast("string").alias("value"))


def staging_stream(spark: SparkSession, path: str, schema: str, glob: str = "*.csv", max_files: int = 1000) -> DataFrame:
    """Rows of delimited files that arrive in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files)
    return reader.csv(path)


def flow_stream(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    return flow_records(staging_stream(spark, path, schemas.FLOW_STAGING, glob))


def dns_stream(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    return dns_records(staging_stream(spark, path, schemas.DNS_STAGING, glob))


def table_writer(
    stream: DataFrame, path: str, checkpoint: str, keys=("y", "m", "d", "h"), files_per_key: int = 4
) -> DataStreamWriter:
    """Exactly-once append to a partitioned Parquet table; an empty batch writes nothing.

    Rows of a partition meet in a few tasks, by a hash of the row: a busy hour is
    spread and no task opens every partition.
    """
    spread = F.pmod(F.xxhash64(*[c for c in stream.columns if c not in keys]), F.lit(files_per_key))
    return (
        stream.repartition(*keys, spread).writeStream.format("parquet").partitionBy(*keys).option("path", path)
        .option("checkpointLocation", checkpoint).outputMode("append")
    )
