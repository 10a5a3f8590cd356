"""Connection graphs, hierarchies and timelines of result rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.reputation import highest_reputation

LONG_QUERY = 64
MAX_DOUBLE = 1.7976931348623157e308


def _surprise(score: Column) -> Column:
    return -F.log(score)


def flow_nodes(scores: DataFrame) -> DataFrame:
    """(ip, internal flag, hits) over both ends."""
    ends = F.array(
        F.struct(F.col("srcip").alias("ip"), F.col("srcip_internal").alias("internal")),
        F.struct(F.col("dstip").alias("ip"), F.col("dstip_internal").alias("internal")),
    )
    rows = scores.select(F.explode(ends).alias("e")).select("e.*")
    return rows.groupBy("ip").agg(F.max("internal").alias("internal"), F.count(F.lit(1)).alias("hits"))


def flow_links(scores: DataFrame) -> DataFrame:
    """Undirected links with the highest -ln(score)."""
    return scores.groupBy(F.least("srcip", "dstip").alias("source"), F.greatest("srcip", "dstip").alias("target")).agg(
        F.max(_surprise(F.col("ml_score"))).alias("score")
    )


def dns_nodes(scores: DataFrame) -> DataFrame:
    ends = F.array(
        F.struct(F.lit("tld").alias("kind"), F.col("tld").alias("label")),
        F.struct(F.lit("ip_dst").alias("kind"), F.col("ip_dst").alias("label")),
    )
    rows = scores.select(F.explode(ends).alias("e")).select("e.*")
    return rows.groupBy("kind", "label").agg(F.count(F.lit(1)).alias("hits"))


def dns_links(scores: DataFrame) -> DataFrame:
    """Links (tld, client); a very long query gets the highest score there is."""
    score = F.when(F.length("dns_qry_name") > LONG_QUERY, F.lit(MAX_DOUBLE)).otherwise(_surprise(F.col("ml_score")))
    return scores.groupBy("tld", "ip_dst").agg(F.max(score).alias("score"))


def proxy_hierarchy(scores: DataFrame) -> DataFrame:
    """Method, host, path, client tree as one row per node: hits and highest reputation.

    The level is the number of set keys: 0 is the root, 4 a client.
    """
    rows = scores.filter(F.col("host") != "-").withColumn("_rep", highest_reputation(F.col("uri_rep")))
    tree = rows.rollup("reqmethod", "host", "uripath", "clientip")
    level = 4 - (
        F.grouping("reqmethod") + F.grouping("host") + F.grouping("uripath") + F.grouping("clientip")
    ).cast("int")
    return tree.agg(level.alias("level"), F.count(F.lit(1)).alias("hits"), F.max("_rep").alias("rep"))


def _most_frequent(rows: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Most frequent value per key, the smaller value on a tie; counted before it is compared."""
    counts = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by(value, F.struct(F.col("n"), -F.col(value).cast("bigint"))).alias(out)
    return counts.groupBy(*keys).agg(best)


def proxy_client_timeline(timeline: DataFrame) -> DataFrame:
    """Distinct minutes and most frequent response code per client."""
    rows = timeline.select("clientip", F.substring("tstart", 1, 16).alias("minute"), F.col("respcode").cast("int").alias("respcode"))
    minutes = rows.select("clientip", "minute").distinct().groupBy("clientip").agg(F.count(F.lit(1)).alias("minutes"))
    return minutes.join(_most_frequent(rows, ["clientip"], "respcode", "respcode"), "clientip")


def flow_ip_timeline(timeline: DataFrame) -> DataFrame:
    """Per anchor and other address: distinct minutes and most used port."""
    ends = F.array(
        F.struct(F.col("srcip").alias("ip"), F.col("sport").alias("port")),
        F.struct(F.col("dstip").alias("ip"), F.col("dport").alias("port")),
    )
    rows = timeline.select("ip_threat", F.substring("tstart", 1, 16).alias("minute"), F.explode(ends).alias("e"))
    rows = rows.select("ip_threat", "minute", "e.*").filter("ip <> ip_threat")
    keys = ["ip_threat", "ip"]
    minutes = rows.select(*keys, "minute").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("minutes"))
    return minutes.join(_most_frequent(rows, keys, "port", "port"), keys)


def client_dendrogram(dendro: DataFrame) -> DataFrame:
    """Per client and query its distinct answers and the number of leaves."""
    one = dendro.withColumn("answer", F.explode(F.split("dns_a", r"\|")))
    one = one.select("ip_dst", "dns_qry_name", "answer").distinct()
    return one.groupBy("ip_dst", "dns_qry_name").agg(
        F.array_join(F.array_sort(F.collect_list("answer")), ",").alias("answers"), F.count(F.lit(1)).alias("leaves")
    )


def request_graph(requests: DataFrame) -> DataFrame:
    """Distinct edges URI -> content type -> method -> client -> referer; no edge to a '-' referer."""
    def edge(kind, a, b):
        return F.struct(F.lit(kind).alias("kind"), F.col(a).alias("source"), F.col(b).alias("target"))

    edges = F.array(
        edge("uri-type", "fulluri", "resconttype"),
        edge("type-method", "resconttype", "reqmethod"),
        edge("method-client", "reqmethod", "clientip"),
        edge("client-referer", "clientip", "referer"),
    )
    rows = requests.select("fulluri", F.explode(edges).alias("e")).select(F.col("fulluri").alias("root"), "e.*")
    return rows.filter("not (kind = 'client-referer' and target = '-')").distinct()


def chord_matrix(chords: DataFrame) -> DataFrame:
    """Bytes per (source, destination) with row, column and grand totals (null keys)."""
    return chords.cube("srcip", "dstip").agg(F.sum("ibyt").alias("ibyt"))


def rank_within(df: DataFrame, keys, order, name: str) -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
