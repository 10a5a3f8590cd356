"""Renames, casts, value rules and top lists on records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import lookup_join

# Names of the two netflow dialects.
FLOW_DIALECT = {
    "ts": "treceived", "td": "tdur", "sa": "sip", "da": "dip",
    "sp": "sport", "dp": "dport", "pr": "proto", "flg": "flag",
}


def normalise_flow_dialect(df: DataFrame) -> DataFrame:
    """One set of names and types for both netflow dialects."""
    df = df.withColumnsRenamed(FLOW_DIALECT)
    if "tryear" not in df.columns:
        halves = F.split("treceived", " ")
        day, clock = F.split(F.get(halves, F.lit(0)), "-"), F.split(F.get(halves, F.lit(1)), ":")
        parts = [(day, n) for n in ("tryear", "trmonth", "trday")] + [(clock, n) for n in ("trhour", "trminute", "trsec")]
        df = df.withColumns({name: F.get(src, F.lit(i % 3)) for i, (src, name) in enumerate(parts)})
    if "opkt" not in df.columns:
        df = df.withColumns({"opkt": F.lit(0), "obyt": F.lit(0)})
    ints = ("tryear", "trmonth", "trday", "trhour", "trminute", "trsec")
    return df.select(
        "treceived",
        *[F.col(c).try_cast("int").alias(c) for c in ints],
        F.col("tdur").cast("float").alias("tdur"),
        "sip", "dip",
        *[F.col(c).try_cast("int").alias(c) for c in ("sport", "dport")],
        "proto", "flag",
        *[F.col(c).cast("float").alias(c) for c in ("ipkt", "ibyt", "opkt", "obyt")],
    )


def drop_incomplete(df: DataFrame, columns=None) -> DataFrame:
    return df.dropna(how="any", subset=columns)


def replace_value(column: Column, old, new) -> Column:
    """The column with one value changed."""
    return F.when(column == F.lit(old), F.lit(new)).otherwise(column)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def label_by_watchlist(df: DataFrame, watchlist: DataFrame, columns=("sip", "dip"), hit="WANNACRY", miss="BENIGN") -> DataFrame:
    """Label a record by an address watch-list (one column ``ip``)."""
    listed = watchlist.select("ip").distinct()
    flags = []
    for i, c in enumerate(columns):
        df = lookup_join(df, listed.select(F.col("ip").alias(c), F.lit(True).alias(f"_hit{i}")), c)
        flags.append(F.coalesce(F.col(f"_hit{i}"), F.lit(False)))
    any_hit = flags[0]
    for f in flags[1:]:
        any_hit = any_hit | f
    return df.withColumn("label", F.when(any_hit, F.lit(hit)).otherwise(F.lit(miss))).drop(
        *[f"_hit{i}" for i in range(len(columns))]
    )


def most_suspicious(df: DataFrame, limit: int, score: str = "score", keys=()) -> DataFrame:
    """Lowest scores first; the keys make ties stable. No limit if it is not positive."""
    ordered = df.orderBy(F.col(score), *[F.col(k) for k in keys])
    return ordered.limit(limit) if limit > 0 else ordered


def ranked(top: DataFrame, score: str, keys=()) -> DataFrame:
    """Zero-based rank in score order: places inside ranges of the order plus the rows of the ranges before, so a list
    of any length is numbered in parallel."""
    order = [F.col(score), *[F.col(k) for k in keys]]
    rows = top.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = cut_lineage(rows)  # number of the range in the upper bits, place in it in the lower 33
    sizes = rows.groupBy(F.shiftright("_at", 33).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rows = rows.withColumn("_range", F.shiftright("_at", 33)).join(F.broadcast(starts), "_range")  # one row per range
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("rank", (F.col("_before") + place).cast("int")).drop("_at", "_range", "_before")


def first_per_key(df: DataFrame, keys, order, n: int) -> DataFrame:
    """At most n rows per key in the given order (the n first are picked before the shuffle)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def hash_split(df: DataFrame, keys, train_percent: int = 90, salt: int = 123) -> tuple[DataFrame, DataFrame]:
    """Train and test part by a hash of the keys: stable under any partitioning."""
    slot = F.pmod(F.xxhash64(F.lit(salt), *[F.col(k) for k in keys]), F.lit(100))
    return df.filter(slot < train_percent), df.filter(slot >= train_percent)


def high_risk_addresses(threat: DataFrame, level: int = 1) -> DataFrame:
    """Distinct addresses (either side) of the connections with the given severity."""
    hits = threat.filter(F.col("severity") == level)
    return hits.select(F.explode(F.array("srcip", "dstip")).alias("ip")).distinct()


def search_flow(df: DataFrame, ip: str | None) -> DataFrame:
    return df if ip is None else df.filter((F.col("srcip") == ip) | (F.col("dstip") == ip))


def search_text(df: DataFrame, column: str, text: str | None) -> DataFrame:
    return df if text is None else df.filter(F.col(column).contains(text))


def search_equal(df: DataFrame, **wanted) -> DataFrame:
    """Filter by the given columns; an argument that is None does not filter."""
    for name, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df


def row_sample(df: DataFrame, n: int, seed: int) -> DataFrame:
    """n rows (all of a smaller table), picked by a hash of the row and the seed: the same rows
    under any partitioning and by the same rule at any size."""
    return df.orderBy(F.xxhash64(*df.columns, F.lit(seed)), *[c for c, kind in df.dtypes if kind in ("string", "bigint", "int")]).limit(n)


def on_day(df: DataFrame, day) -> DataFrame:
    """Records of one day by the partition columns; all days if day is None."""
    if day is None:
        return df
    return df.filter((F.col("y") == day.year) & (F.col("m") == day.month) & (F.col("d") == day.day))


def between_days(df: DataFrame, first, last) -> DataFrame:
    """Records of a range of days. The year test prunes partitions, the date test is exact."""
    date = F.make_date(F.col("y").cast("int"), F.col("m").cast("int"), F.col("d").cast("int"))
    return df.filter(F.col("y").between(first.year, last.year) & date.between(F.lit(first), F.lit(last)))
