"""Storyboards: what the flows around threat addresses look like.

All functions take a table of anchors (one column ``ip_threat``) and serve every
anchor in one job; a single address is a table with one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.addresses import context_category
from ..operators.details import flow_timeline
from ..operators.enrich import context_of, geo_of
from ..operators.joins import is_small
from ..operators.ranges import distinct_addresses
from ..operators.records import first_per_key
from ..session import cut_lineage

TOP_RESULTS = 20
INBOUND, OUTBOUND, TWO_WAY = "Inbound Only", "Outbound Only", "two way"


def anchors_of(spark: SparkSession, *ips: str) -> DataFrame:
    return spark.createDataFrame([(ip,) for ip in ips], "ip_threat string")


def connection_groups(flow: DataFrame, *keys: str) -> DataFrame:
    """Flows per (source, destination, ports): times, count, highest and mean packets and bytes."""
    return flow.groupBy(*keys, F.col("sip").alias("srcip"), F.col("dip").alias("dstip"), "sport", "dport").agg(
        F.min("treceived").alias("firstseen"),
        F.max("treceived").alias("lastseen"),
        F.count(F.lit(1)).alias("conns"),
        F.max("ipkt").alias("maxpkts"),
        F.avg("ipkt").alias("avgpkts"),
        F.max("ibyt").alias("maxbyts"),
        F.avg("ibyt").alias("avgbyts"),
    )


def expanded_search(flow: DataFrame, ip: str) -> DataFrame:
    """Connection groups of one address."""
    return connection_groups(flow.filter((F.col("sip") == ip) | (F.col("dip") == ip)))


def expanded_search_all(flow: DataFrame, anchors: DataFrame) -> DataFrame:
    """Connection groups of every anchor: (ip_threat, ...).

    A short list of anchors picks its flows before the grouping; for a long one the
    groups are made first.
    """
    anchors = anchors.select("ip_threat").distinct()
    if not is_small(anchors):
        ends = F.explode(F.array_distinct(F.array("srcip", "dstip")))
        return connection_groups(flow).withColumn("ip_threat", ends).join(anchors, "ip_threat", "left_semi")
    ends = F.explode(F.array_distinct(F.array("sip", "dip")))
    rows = flow.withColumn("ip_threat", ends).join(F.broadcast(anchors), "ip_threat", "left_semi")
    return connection_groups(rows, "ip_threat")


def directions(groups: DataFrame) -> DataFrame:
    """Per anchor and address: direction, number of connections, highest bytes and main peer.

    An address that is only a source is outbound, only a destination inbound, both
    two-way (with its figures as a source).
    """
    def role(me, other, name):
        return F.struct(F.col(me).alias("ip"), F.col(other).alias("peer"), F.lit(name).alias("role"))

    rows = groups.withColumn("e", F.explode(F.array(role("srcip", "dstip", "src"), role("dstip", "srcip", "dst"))))
    rows = rows.select("ip_threat", "e.*", "conns", "maxbyts")

    def figures(name):
        mine = F.col("role") == name
        return [
            F.sum(F.when(mine, F.col("conns"))).alias(f"conns_{name}"),
            F.max(F.when(mine, F.struct("maxbyts", "peer"))).alias(f"top_{name}"),
        ]

    per = rows.groupBy("ip_threat", "ip").agg(*figures("src"), *figures("dst"))
    is_src, is_dst = F.col("conns_src").isNotNull(), F.col("conns_dst").isNotNull()
    top = F.coalesce("top_src", "top_dst")
    return per.select(
        "ip_threat", "ip",
        F.when(is_src & is_dst, F.lit(TWO_WAY)).when(is_src, F.lit(OUTBOUND)).otherwise(F.lit(INBOUND)).alias("direction"),
        F.coalesce("conns_src", "conns_dst").alias("conns"),
        top["maxbyts"].alias("maxbytes"),
        top["peer"].alias("peer"),
    )


def top_connections(split: DataFrame, top: int = TOP_RESULTS) -> DataFrame:
    """Per anchor and direction the top addresses by bytes and by connections, merged."""
    keys = ["ip_threat", "direction"]
    by_bytes = first_per_key(split, keys, [F.col("maxbytes").desc(), F.col("ip")], top)
    by_conns = first_per_key(split, keys, [F.col("conns").desc(), F.col("ip")], top)
    return by_bytes.union(by_conns).distinct()


def with_place(tops: DataFrame, context: DataFrame, geo: DataFrame) -> DataFrame:
    """Add the network context and the geography of the address and of its peer.

    The short list of top addresses is kept as a table, because four lookups read it.
    """
    tops = cut_lineage(tops)
    names = context_of(distinct_addresses(tops, "ip"), context).withColumnRenamed("name", "nwloc")
    places = geo_of(distinct_addresses(tops, "ip", "peer"), geo)
    fields = F.struct("latitude", "longitude", "owner", "geo_loc")
    mine = places.select("ip", fields.alias("geo"))
    other = places.select(F.col("ip").alias("peer"), fields.alias("geo_peer"))
    return tops.join(names, "ip", "left").join(mine, "ip", "left").join(other, "peer", "left")


def impact(placed: DataFrame) -> DataFrame:
    """Addresses per anchor, direction and context category."""
    first = F.get(F.split(F.coalesce("nwloc", F.lit("")), r"\."), F.lit(0))
    return placed.groupBy("ip_threat", "direction", context_category(first).alias("context")).agg(
        F.count(F.lit(1)).alias("size")
    )


def progression(placed: DataFrame) -> DataFrame:
    """Addresses per anchor, direction and full context name; unnamed ones are left out."""
    return placed.filter(F.col("nwloc").isNotNull()).groupBy("ip_threat", "direction", F.col("nwloc").alias("name")).agg(
        F.count(F.lit(1)).alias("impact")
    )


def _tree(counts: DataFrame, label: str, number: str, root_number: bool) -> DataFrame:
    leaf = F.struct(F.col(label).alias("name"), F.col(number))
    branch = counts.groupBy("ip_threat", "direction").agg(
        F.array_sort(F.collect_list(leaf)).alias("children"), F.sum(number).alias("n")
    )
    total = F.col("n") if root_number else F.lit(0).cast("bigint")
    node = F.struct(F.col("direction").alias("name"), "children", total.alias(number))
    return branch.groupBy("ip_threat").agg(F.array_sort(F.collect_list(node)).alias("children"), F.sum("n").alias("n"))


def impact_json(placed: DataFrame) -> DataFrame:
    """Impact tree per anchor. Its branches are three directions and four categories."""
    tree = _tree(impact(placed), "context", "size", True)
    return tree.select("ip_threat", F.to_json(F.struct(F.lit("").alias("name"), "children", F.col("n").alias("size"))).alias("json"))


def progression_json(placed: DataFrame) -> DataFrame:
    """Progression tree per anchor; at most 2 x top addresses per direction feed it."""
    tree = _tree(progression(placed), "name", "impact", False)
    return tree.select(
        "ip_threat", F.to_json(F.struct(F.col("ip_threat").alias("name"), "children", F.lit("").alias("time"))).alias("json")
    )


def map_points(placed: DataFrame) -> DataFrame:
    """Map points: side (sourceips or destips), address, location, coordinates and type
    (1 two-way, 2 inbound, 3 outbound). Points without numeric coordinates are left out."""
    kind = F.when(F.col("direction") == TWO_WAY, 1).when(F.col("direction") == INBOUND, 2).otherwise(3)

    def point(side, ip, place):
        return F.struct(
            F.lit(side).alias("side"), F.col(ip).alias("ip"), F.col("geo.owner").alias("location"),
            F.col(f"{place}.longitude").try_cast("double").alias("longitude"),
            F.col(f"{place}.latitude").try_cast("double").alias("latitude"),
        )

    two_way = F.array(point("destips", "ip", "geo"))
    one_way = F.array(point("sourceips", "ip", "geo"), point("destips", "peer", "geo_peer"))
    rows = placed.select(
        "ip_threat", kind.alias("type"), F.explode(F.when(F.col("direction") == TWO_WAY, two_way).otherwise(one_way)).alias("p")
    )
    return rows.select("ip_threat", "type", "p.*").filter("longitude is not null and latitude is not null")


def map_json(placed: DataFrame) -> DataFrame:
    """GeoJSON collection per anchor."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct("location", "ip", "type").alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates")).alias("geometry"),
    )
    rows = map_points(placed)

    def side(name):
        return F.array_sort(
            F.collect_list(F.when(F.col("side") == name, F.struct(F.col("ip").alias("o"), feature.alias("f")))),
        )

    sides = rows.groupBy("ip_threat").agg(side("sourceips").alias("s"), side("destips").alias("d"))
    body = F.struct(
        F.lit("FeatureCollection").alias("type"),
        F.transform("s", lambda x: x["f"]).alias("sourceips"),
        F.transform("d", lambda x: x["f"]).alias("destips"),
    )
    return sides.select("ip_threat", F.to_json(body).alias("json"))


def timeline(flow: DataFrame, tops: DataFrame) -> DataFrame:
    """Timeline rows between the anchors and their top addresses."""
    peers = tops.select("ip_threat", F.col("ip").alias("peer")).distinct()
    return flow_timeline(flow, peers)


def storyboard(flow: DataFrame, anchors: DataFrame, context: DataFrame, geo: DataFrame, top: int = TOP_RESULTS) -> dict[str, DataFrame]:
    """All parts of the storyboards of the anchors."""
    tops = cut_lineage(top_connections(directions(expanded_search_all(flow, anchors)), top))
    placed = cut_lineage(with_place(tops, context, geo))
    return {
        "connections": placed,
        "impact": impact_json(placed),
        "progression": progression_json(placed),
        "map": map_json(placed),
        "timeline": timeline(flow, tops),
    }
