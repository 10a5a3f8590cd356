"""Enrichment of result rows: geography, context, code names, reputation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.domains import name_tails
from .joins import lookup_join
from .ranges import (
    addresses_inside,
    context_ranges,
    distinct_addresses,
    internal_ranges,
    last_start_at_or_below,
    narrowest_range,
)

GEO_PAYLOAD = ("state", "city", "latitude", "longitude", "owner", "domain")


def geo_of(addresses: DataFrame, geo: DataFrame) -> DataFrame:
    """Per address its geography row; ``geo_loc`` is ``state;city owner``."""
    hit = last_start_at_or_below(addresses, geo, "range_start", GEO_PAYLOAD)
    text = F.concat(F.concat_ws(";", "state", "city"), F.lit(" "), F.col("owner"))
    return hit.withColumn("geo_loc", text)


def with_internal_flags(df: DataFrame, lookup: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add a 1/0 column per address column: inside any internal range or not."""
    inside = addresses_inside(distinct_addresses(df, *columns), internal_ranges(lookup))
    for column, flag in columns.items():
        side = inside.select(F.col("ip").alias(column), F.lit(1).alias(flag))
        df = df.join(side, column, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))
    return df


def with_geo(df: DataFrame, geo: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Add location text and domain per address column; '' where nothing is known."""
    found = geo_of(distinct_addresses(df, *columns), geo)
    for column, (loc, domain) in columns.items():
        side = found.select(F.col("ip").alias(column), F.col("geo_loc").alias(loc), F.col("domain").alias(domain))
        df = df.join(side, column, "left").withColumns(
            {loc: F.coalesce(F.col(loc), F.lit("")), domain: F.coalesce(F.col(domain), F.lit(""))}
        )
    return df


def context_of(addresses: DataFrame, lookup: DataFrame) -> DataFrame:
    """Network context per address: (ip, name). An exact entry is the narrowest range."""
    return narrowest_range(addresses, context_ranges(lookup), "name")


def with_context(df: DataFrame, lookup: DataFrame, column: str, out: str = "network_context") -> DataFrame:
    side = context_of(distinct_addresses(df, column), lookup).select(F.col("ip").alias(column), F.col("name").alias(out))
    return df.join(side, column, "left")


def with_client_name(df: DataFrame, names: DataFrame, column: str, out: str = "network_context") -> DataFrame:
    """Exact-key context; '' where the key is unknown."""
    side = names.groupBy(F.col("ip").alias(column)).agg(F.min("name").alias(out))
    return lookup_join(df, side, column).withColumn(out, F.coalesce(F.col(out), F.lit("")))


def code_names(lookup: DataFrame, *key_columns: str) -> DataFrame:
    """(k, name) from a code table with one or more key columns."""
    keys = F.explode(F.array(*[F.col(c).cast("string") for c in key_columns]))
    return lookup.select(keys.alias("k"), "name").groupBy("k").agg(F.min("name").alias("name"))


def with_code_name(df: DataFrame, names: DataFrame, column: str, out: str) -> DataFrame:
    """Name of a code; ``Unknown (code)`` where the table has none."""
    side = names.select(F.col("k").alias("_k"), F.col("name").alias(out))
    df = df.withColumn("_k", F.col(column).cast("string"))
    df = lookup_join(df, side, "_k").drop("_k")
    return df.withColumn(out, F.coalesce(F.col(out), F.concat(F.lit("Unknown ("), F.col(column).cast("string"), F.lit(")"))))


def merged_reputation(feeds: list[DataFrame]) -> DataFrame:
    """One text per key from the feeds (k, label) of the services, joined by ``::``.

    A feed is first reduced to one label per key, so the list of a key never
    has more entries than there are services.
    """
    parts = [
        feed.groupBy("k").agg(F.max("label").alias("label")).withColumn("pos", F.lit(i))
        for i, feed in enumerate(feeds)
    ]
    both = reduce(DataFrame.unionByName, parts)
    labels = F.array_sort(F.collect_list(F.struct("pos", "label")))
    return both.groupBy("k").agg(F.concat_ws("::", F.transform(labels, lambda x: x["label"])).alias("rep"))


def with_reputation(df: DataFrame, column: str, feeds: list[DataFrame], out: str) -> DataFrame:
    """Merged reputation of a key column; '' where no service knows the key."""
    side = merged_reputation(feeds).select(F.col("k").alias(column), F.col("rep").alias(out))
    return df.join(side, column, "left").withColumn(out, F.coalesce(F.col(out), F.lit("")))


def registered_domains(names: DataFrame, name: str, suffixes: DataFrame) -> DataFrame:
    """Registered domain per distinct name: one label in front of the longest public suffix.

    ``suffixes`` has one column ``suffix``. Names without a known suffix get null.
    """
    distinct = names.select(F.col(name)).filter(F.col(name).isNotNull()).distinct()
    tails = distinct.select(name, name_tails(F.col(name)).alias("tails"))
    tails = tails.select(name, "tails", F.posexplode("tails").alias("pos", "tail"))
    listed = suffixes.select(F.col("suffix").alias("tail")).distinct()
    hits = lookup_join(tails, listed, "tail", "inner")
    longest = hits.groupBy(name, "tails").agg(F.min("pos").alias("pos"))
    found = longest.select(name, F.when(F.col("pos") > 0, F.get("tails", F.col("pos") - 1)).alias("tld"))
    return distinct.join(found, name, "left")


def with_registered_domain(df: DataFrame, suffixes: DataFrame, name: str = "dns_qry_name") -> DataFrame:
    return df.join(registered_domains(df, name, suffixes), name, "left")
