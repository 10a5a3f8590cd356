"""Feature table of the netflow detectors: one row per consolidated flow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import flowfeatures as ff
from ..operators.records import drop_incomplete, normalise_flow_dialect

KEYS = (
    "treceived", "tryear", "trmonth", "trday", "trhour", "trminute", "trsec", "sip", "dip", "sport", "dport", "proto", "flag",
)
SUMS = ("tdur", "ipkt", "ibyt", "opkt", "obyt")
LOGGED = ("tdur", "ipkt", "ibyt")
SCALED = ("tdur", "ipkt", "ibyt", "nconnections")
PROTO = tuple(f"proto_onehot{i}" for i in range(5))
FLAGS = tuple(f"flag_onehot{i}" for i in range(6))

# The order is the same in training and scoring.
FEATURES = ("sport", "dport", *FLAGS, *PROTO, "opkt", "obyt", "tdNorm", "ipktNorm", "ibytNorm", "nconnNorm")
SCALED_NAMES = dict(zip(SCALED, ("tdNorm", "ipktNorm", "ibytNorm", "nconnNorm")))


def consolidate(flow: DataFrame) -> DataFrame:
    """Sum and count the flows with equal keys in a single aggregation (durations in seconds)."""
    rows = drop_incomplete(normalise_flow_dialect(flow)).withColumn("tdur", F.col("tdur") / 1000)
    return rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS], F.count(F.lit(1)).alias("nconnections"))


def preprocess(flow: DataFrame) -> DataFrame:
    """Consolidated flows with logarithms, protocol slots and flag counts."""
    rows = consolidate(flow)
    rows = rows.withColumns({c: ff.log_plus_one(F.col(c)) for c in LOGGED})
    rows = rows.withColumns({c: ff.protocol_slot(F.col("proto"), i) for i, c in enumerate(PROTO)})
    return rows.withColumns({c: ff.flag_count(F.col("flag"), letter) for c, letter in zip(FLAGS, ff.FLAG_LETTERS)})


def min_max(rows: DataFrame) -> DataFrame:
    """One row with the ends of every scaled feature, from one pass."""
    ends = [f(c).alias(f"{name}_{c}") for c in SCALED for name, f in (("min", F.min), ("max", F.max))]
    return rows.agg(*ends)


def scale(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Add the scaled features. ``ends`` is the one-row table of ``min_max``."""
    return scale_by(rows, ends.first().asDict())


def scale_by(rows: DataFrame, row: dict) -> DataFrame:
    """Add the scaled features by known ends."""
    return rows.withColumns({
        SCALED_NAMES[c]: ff.min_max_scaled(
            F.col(c).cast("double"), F.lit(float(row[f"min_{c}"])), F.lit(float(row[f"max_{c}"]))
        )
        for c in SCALED
    })


def feature_array(rows: DataFrame, names=FEATURES, out: str = "features") -> DataFrame:
    """Features as one array of doubles; a feature without spread counts as zero."""
    return rows.withColumn(out, F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names]))


def save_stats(stats: DataFrame, path: str) -> None:
    stats.coalesce(1).write.mode("overwrite").parquet(path)


def load_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
