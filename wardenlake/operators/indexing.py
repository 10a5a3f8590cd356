"""Dense indexes for words and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

BUCKETS = 4096


def dense_index(df: DataFrame, column: str, index: str = "idx", buckets: int = BUCKETS) -> DataFrame:
    """Distinct values of a column numbered 0..n-1.

    Values are numbered inside hash buckets in parallel; the sizes of the buckets
    (one row each) give the offsets. The numbering depends on the values only.
    """
    # both the numbers and the sizes read the distinct values
    values = cut_lineage(df.select(column).distinct().withColumn("_b", F.pmod(F.xxhash64(column), F.lit(buckets))))
    inside = values.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(column)))
    sizes = values.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    joined = inside.join(F.broadcast(offsets), "_b")  # one row per bucket
    return joined.select(column, (F.col("_o") + F.col("_r") - 1).alias(index))
