"""Address lookups in range tables, as equi joins.

Work is done once per distinct address, so an address that holds a large share
of the records costs one row here; the result goes back to the records by a
plain join on the address.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.addresses import ip_to_long, range_bounds

LEVELS = 32


def distinct_addresses(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct addresses of some columns with their number: (ip, ip_num)."""
    ips = df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("ip"))
    return ips.filter(F.col("ip").isNotNull()).distinct().withColumn("ip_num", ip_to_long(F.col("ip")))


def prefix_blocks(ranges: DataFrame) -> DataFrame:
    """Cut ranges (lo, hi, ...) into aligned blocks of 2^level addresses.

    Every range becomes at most 64 blocks that cover it exactly once: at each
    level only the first and the last full block can lack a covering parent.
    """
    cols = [F.col(c) for c in ranges.columns]
    lo, hi = F.col("lo"), F.col("hi")

    def edge(level):
        size = F.expr(f"shiftleft(1L, {level})")
        first = F.floor((lo + size - 1) / size.cast("double")).cast("bigint")
        last = F.floor((hi + 1) / size.cast("double")).cast("bigint") - 1
        return first, last

    out = ranges.filter(lo <= hi).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    first, last = edge("level")
    up_first, up_last = edge("level + 1")
    out = out.select(
        *cols, "level", first.alias("_f"), last.alias("_l"), up_first.alias("_uf"), up_last.alias("_ul")
    ).filter("_f <= _l")
    out = out.withColumn("block", F.explode(F.array_distinct(F.array("_f", "_l"))))
    parent = F.floor(F.col("block") / F.lit(2.0)).cast("bigint")
    return out.filter(~parent.between(F.col("_uf"), F.col("_ul"))).drop("_f", "_l", "_uf", "_ul")


def _address_blocks(addresses: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each address with the block it lies in at every level that occurs in the blocks (33 levels at most)."""
    levels = sorted(r["level"] for r in blocks.select("level").distinct().collect())
    levels = F.array(*[F.lit(x) for x in levels]).cast("array<int>")
    return addresses.withColumn("level", F.explode(levels)).withColumn(
        "block", F.expr("shiftright(ip_num, level)")
    )


def narrowest_range(addresses: DataFrame, ranges: DataFrame, value: str) -> DataFrame:
    """Per address (ip, ip_num) the ``value`` of the narrowest range (lo, hi) around it.

    Ties go to the lower start, then to the smaller value. Addresses outside
    every range are left out.
    """
    best = F.min(F.struct((F.col("hi") - F.col("lo")).alias("width"), F.col("lo"), F.col(value))).alias("best")
    blocks = prefix_blocks(ranges.select("lo", "hi", value)).groupBy("level", "block").agg(best)
    hits = _address_blocks(addresses, blocks).join(blocks, ["level", "block"])
    return hits.groupBy("ip").agg(F.min("best").alias("best")).select("ip", F.col(f"best.{value}").alias(value))


def addresses_inside(addresses: DataFrame, ranges: DataFrame) -> DataFrame:
    """Addresses (ip) that lie in any of the ranges (lo, hi)."""
    blocks = prefix_blocks(ranges.select("lo", "hi")).select("level", "block").distinct()
    return _address_blocks(addresses, blocks).join(blocks, ["level", "block"], "left_semi").select("ip").distinct()


def last_start_at_or_below(addresses: DataFrame, starts: DataFrame, start: str, payload) -> DataFrame:
    """As-of lookup: per address the row of ``starts`` with the greatest start <= address.

    Both sides are cut by the upper 16 bits. A bucket then holds at most 65,536
    distinct addresses and as many starts, and one carry-in row brings the last
    start of the buckets below it.
    """
    rows = starts.groupBy(F.col(start).alias("key")).agg(
        F.max(F.struct(*[F.col(c) for c in payload])).alias("hit")
    )
    rows = rows.withColumn("bucket", F.expr("shiftright(key, 16)"))
    ips = addresses.filter(F.col("ip_num").isNotNull()).withColumn("bucket", F.expr("shiftright(ip_num, 16)"))

    # One row per bucket in use (65,536 at most): the last start of all buckets below.
    last = rows.groupBy("bucket").agg(F.max(F.struct("key", "hit")).alias("last"))
    used = ips.select("bucket").distinct()
    every = last.join(used, "bucket", "full")
    below = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = every.withColumn("carry", F.last("last", ignorenulls=True).over(below)).filter("carry is not null")
    carry = carry.select("bucket", F.lit(-1).cast("bigint").alias("pos"), F.col("carry.hit").alias("hit"))

    kind = F.lit(None).cast("string")
    points = rows.select("bucket", F.col("key").alias("pos"), "hit", kind.alias("ip"))
    carry = carry.select("bucket", "pos", "hit", kind.alias("ip"))
    asks = ips.select("bucket", F.col("ip_num").alias("pos"), F.lit(None).cast(rows.schema["hit"].dataType).alias("hit"), "ip")
    upto = Window.partitionBy("bucket").orderBy("pos", F.col("ip").isNotNull())
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = points.unionByName(carry).unionByName(asks)
    found = merged.withColumn("found", F.last("hit", ignorenulls=True).over(upto))
    return found.filter("ip is not null and found is not null").select("ip", "found.*")


def context_ranges(lookup: DataFrame) -> DataFrame:
    """Range texts (CIDR, dash range, single address) to (lo, hi, name)."""
    out = lookup.withColumn("_r", range_bounds(F.col("range_text")))
    return out.select(F.col("_r.lo").alias("lo"), F.col("_r.hi").alias("hi"), "name").filter("lo is not null and hi is not null")


def internal_ranges(lookup: DataFrame) -> DataFrame:
    return lookup.select(ip_to_long(F.col("lo_ip")).alias("lo"), ip_to_long(F.col("hi_ip")).alias("hi")).filter(
        "lo is not null and hi is not null"
    )
