"""Session helpers: shared working folder, lineage cuts, skew settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session that
    names none (tests) gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if named:
        if current is None:
            sc.setCheckpointDir(named)
        return named
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="wardenlake-")
    sc.setCheckpointDir(made)
    return made


def work_path(spark: SparkSession, name: str) -> str:
    """Fresh path in the shared folder for a written table or model."""
    return f"{shared_dir(spark).rstrip('/')}/work/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_to_files(df: DataFrame, name: str = "cut") -> DataFrame:
    """Lineage cut by a table written in the shared folder. Compressed columns take a fraction of the space of a checkpoint,
    and a later pass reads only those it needs. Rows may come back in another order and other partitions."""
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_and_cut(df: DataFrame) -> DataFrame:
    """Checkpoint for data that many passes will read: rows are spread over at least as
    many partitions as there are cores, whatever adaptive execution had merged."""
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return cut_lineage(df.repartition(parts))


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the library relies on (all are changeable at run time)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return spark
