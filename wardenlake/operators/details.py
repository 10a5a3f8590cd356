"""Raw-record details of suspicious results: edges, chords, dendrograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import is_small, lookup_join, possible_matches
from .records import first_per_key

DETAIL_LIMIT = 250

#: Longest beginning of an asked name by which names are looked up.
ANCHOR = 16


def without_scored_flow(scores: DataFrame, threat: DataFrame) -> DataFrame:
    """Suspicious flows of which neither side equals a scored connection's side.

    The OR of the two matches is two anti joins on equal keys.
    """
    src = threat.select("srcip").distinct()
    dst = threat.select("dstip").distinct()
    return lookup_join(lookup_join(scores, src, "srcip", "left_anti"), dst, "dstip", "left_anti")


def without_scored(scores: DataFrame, threat: DataFrame, key: str) -> DataFrame:
    return lookup_join(scores, threat.select(key).distinct(), key, "left_anti")


def _pair(a: str, b: str):
    return F.least(a, b).alias("ip_low"), F.greatest(a, b).alias("ip_high")


def flow_edges(flow: DataFrame, suspicious: DataFrame) -> DataFrame:
    """Raw flows between the two ends of a suspicious flow, either direction, in its minute."""
    when = F.split("tstart", "[- :]")
    asked = suspicious.select(
        *_pair("srcip", "dstip"),
        *[F.get(when, F.lit(i)).cast("int").alias(c) for i, c in enumerate(("y", "m", "d", "h", "trminute"))],
    )
    asked = cut_lineage(asked.distinct())
    rows = flow.withColumns({"ip_low": F.least("sip", "dip"), "ip_high": F.greatest("sip", "dip")})
    keys = ["ip_low", "ip_high", "y", "m", "d", "h", "trminute"]
    if is_small(asked):
        hits = rows.join(F.broadcast(asked), keys, "left_semi")
    else:  # a key is asked once; a semi join would be pushed below the filter
        hits = possible_matches(rows, asked, keys).join(asked, keys)
    return hits.select(
        F.col("treceived").alias("tstart"), F.col("sip").alias("srcip"), F.col("dip").alias("dstip"), "sport", "dport",
        "proto", F.col("flag").alias("flags"), F.col("stos").alias("tos"), "ibyt", "ipkt", "input", "output", "rip",
        "obyt", "opkt", F.col("h").alias("hh"), F.col("trminute").alias("mn"), "y", "m", "d",
    )


def threat_peers(suspicious: DataFrame) -> DataFrame:
    """(ip_threat, peer) of addresses seen more than once with more than one distinct peer.

    Reduced to distinct pairs with a count first, so a busy address is small
    before its peers are counted.
    """
    both = suspicious.select(
        F.explode(
            F.array(
                F.struct(F.col("srcip").alias("ip_threat"), F.col("dstip").alias("peer")),
                F.struct(F.col("dstip").alias("ip_threat"), F.col("srcip").alias("peer")),
            )
        ).alias("p")
    ).select("p.*")
    pairs = both.groupBy("ip_threat", "peer").agg(F.count(F.lit(1)).alias("n"))
    busy = pairs.groupBy("ip_threat").agg(
        F.sum("n").alias("hits"), F.count(F.lit(1)).alias("peers")
    ).filter("hits > 1 and peers > 1")
    return pairs.join(busy, "ip_threat").select("ip_threat", "peer", "hits", "peers")


def chords(flow: DataFrame, suspicious: DataFrame) -> DataFrame:
    """Traffic between a threat address and its suspicious peers, summed per direction.

    A short list of pairs picks its flows before anything is shuffled. With a long list the flows that may be between
    listed addresses are first summed per pair of addresses, so that a busy pair is one row, and meet the list once for
    both directions.
    """
    peers = threat_peers(suspicious).select("ip_threat", "peer")
    rows = flow.select(F.col("sip").alias("srcip"), F.col("dip").alias("dstip"), "ibyt", "ipkt")
    if not is_small(peers):
        sums = [F.sum("ibyt").alias("ibyt"), F.sum("ipkt").alias("ipkt")]
        return _between(rows, peers, [], sums).select("ip_threat", "srcip", "dstip", "ibyt", "ipkt")
    hits = _either_side(rows, F.broadcast(peers), "ip_threat", "peer")
    return hits.groupBy("ip_threat", "srcip", "dstip").agg(F.sum("ibyt").alias("ibyt"), F.sum("ipkt").alias("ipkt"))


def _between(rows: DataFrame, pairs: DataFrame, keys, figures) -> DataFrame:
    """Figures per (ip_threat, srcip, dstip, *keys) of the rows between the two addresses of a long list of distinct pairs
    (ip_threat, peer).

    Rows that no pair can match stay at home. The others are grouped first, so that a busy pair is few rows, and meet the
    list, which has one row for both directions, once.
    """
    ends = ["ip_low", "ip_high"]
    listed = pairs.where("ip_threat is not null and peer is not null").select(*_pair("ip_threat", "peer"), "ip_threat")
    listed = cut_lineage(listed.groupBy(*ends).agg(F.collect_set("ip_threat").alias("threats")))
    rows = rows.where("srcip is not null and dstip is not null").withColumns(dict(zip(ends, _pair("srcip", "dstip"))))
    rows = possible_matches(rows, listed, ends)
    groups = rows.groupBy(*ends, "srcip", "dstip", *keys).agg(*figures)
    return groups.join(listed, ends).withColumn("ip_threat", F.explode("threats")).drop(*ends, "threats")


def _either_side(totals: DataFrame, pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (srcip, dstip) matched with pairs (a, b) in either direction, each once."""
    turned = F.array_distinct(
        F.array(
            F.struct(F.col("srcip").alias(a), F.col("dstip").alias(b)),
            F.struct(F.col("dstip").alias(a), F.col("srcip").alias(b)),
        )
    )
    rows = totals.withColumn("_t", F.explode(turned)).select("*", f"_t.{a}", f"_t.{b}").drop("_t")
    return rows.join(pairs, [a, b])


def pair_totals(flow: DataFrame) -> DataFrame:
    """Bytes and packets per (source, destination)."""
    return flow.groupBy(F.col("sip").alias("srcip"), F.col("dip").alias("dstip")).agg(
        F.sum("ibyt").alias("ibyt"), F.sum("ipkt").alias("ipkt")
    )


def _anchor_length(length):
    """Largest power of two up to ``length``, at most ``ANCHOR``; zero for an empty name."""
    return F.when(length > 0, F.least(F.lit(ANCHOR), F.pow(F.lit(2), F.floor(F.log2(length))).cast("int"))).otherwise(F.lit(0))


def _names_with(names: DataFrame, asked: DataFrame) -> DataFrame:
    """(day, hour, name, asked name) where the name contains the asked name.

    They meet by equality on the beginning of the asked name, cut to a few lengths: each distinct name gives its substrings of
    those lengths, and only substrings that begin an asked name go on to meet it in its hour, where the whole name decides.
    """
    when = ["y", "m", "d", "h"]
    asked = asked.where(F.col("asked").isNotNull())
    asked = asked.withColumn("anchor", F.substring("asked", F.lit(1), _anchor_length(F.length("asked"))))
    anchors = cut_lineage(asked.select("anchor").distinct())
    lengths = sorted(r[0] for r in anchors.select(F.length("anchor")).distinct().collect())  # one per power of two
    names = names.join(asked.select(*when).distinct(), when, "left_semi")
    pieces = F.flatten(
        F.transform(
            F.array(*[F.lit(n) for n in lengths]).cast("array<int>"),
            lambda n: F.when(
                F.length("dns_qry_name") >= n,
                F.transform(
                    F.sequence(F.lit(1), F.length("dns_qry_name") - n + 1),
                    lambda i: F.substring(F.col("dns_qry_name"), i, n),
                ),
            ).otherwise(F.array().cast("array<string>")),
        )
    )
    cut = names.withColumn("anchor", F.explode(F.array_distinct(pieces)))
    cut = lookup_join(cut, anchors, "anchor", "left_semi")
    # The substrings look small to the planner; only a measured side may be broadcast.
    met = cut.join(F.broadcast(asked) if is_small(asked) else asked.hint("merge"), [*when, "anchor"])
    return met.where(F.contains("dns_qry_name", "asked")).select(*when, "dns_qry_name", "asked")


def dns_edges(dns: DataFrame, suspicious: DataFrame, limit: int = DETAIL_LIMIT) -> DataFrame:
    """Raw DNS replies whose name contains a suspicious name, in the same hour; the
    first ``limit`` per suspicious name and hour.

    Of every name of an hour only the first ``limit`` replies can be among them, so the others go before the replies meet
    the suspicious names.
    """
    asked = cut_lineage(suspicious.select("y", "m", "d", "h", F.col("dns_qry_name").alias("asked")).distinct())
    when = ["y", "m", "d", "h"]
    matches = cut_lineage(_names_with(dns.select(*when, "dns_qry_name").distinct(), asked))
    order = [F.col(c) for c in (
        "unix_tstamp", "ip_dst", "dns_qry_name", "frame_len", "dns_qry_type", "dns_qry_rcode", "dns_qry_class", "dns_a", "ip_src")]
    name = [*when, "dns_qry_name"]
    rows = first_per_key(lookup_join(dns, matches.select(*name).distinct(), name, "left_semi"), name, order, limit)
    rows = rows.join(matches, name)
    top = first_per_key(rows, ["y", "m", "d", "h", "asked"], order, limit)
    return top.select(
        "asked", "unix_tstamp", "frame_len", "ip_dst", "ip_src", "dns_qry_name", "dns_qry_class", "dns_qry_type",
        "dns_qry_rcode", "dns_a", F.col("h").alias("hh"), "y", "m", "d",
    )


def proxy_edges(proxy: DataFrame, suspicious: DataFrame, limit: int = DETAIL_LIMIT) -> DataFrame:
    """Raw requests of a suspicious (URI, client) in the same hour, the first ``limit`` of each."""
    keys = ["y", "m", "d", "h", "fulluri", "clientip"]
    rows = lookup_join(proxy, suspicious.select(*keys).distinct(), keys, "left_semi")
    order = [F.col(c) for c in ("p_time", "reqmethod", "useragent", "respcode", "referer", "scbytes", "csbytes", "webcat", "uriport", "serverip", "resconttype")]
    top = first_per_key(rows, keys, order, limit)
    return top.select(
        F.col("p_date").alias("tdate"), F.col("p_time").alias("time"), "clientip", "host", "webcat", "respcode", "reqmethod",
        "useragent", "resconttype", "referer", "uriport", "serverip", "scbytes", "csbytes", "fulluri", F.col("h").alias("hh"),
        "y", "m", "d",
    )


def dns_dendrogram(dns: DataFrame, suspicious: DataFrame, limit: int = DETAIL_LIMIT) -> DataFrame:
    """Distinct (time, answer, query, client) among the first ``limit`` replies of each
    suspicious client and day."""
    keys = ["y", "m", "d", "ip_dst"]
    rows = lookup_join(dns, suspicious.select(*keys).distinct(), keys, "left_semi")
    top = first_per_key(rows, keys, [F.col(c) for c in ("unix_tstamp", "dns_qry_name", "dns_a")], limit)
    return top.select("unix_tstamp", "dns_a", "dns_qry_name", "ip_dst", "y", "m", "d").distinct()


def flow_timeline(flow: DataFrame, anchors: DataFrame, limit: int = 1000) -> DataFrame:
    """First and last time of each distinct connection between an anchor and its listed
    peers (ip_threat, peer); the first ``limit`` per anchor by start."""
    keys = ["srcip", "dstip", "proto", "sport", "dport", "ipkt", "ibyt"]
    span = F.min("treceived").alias("tstart"), F.max("treceived").alias("tend")
    rows = flow.withColumnsRenamed({"sip": "srcip", "dip": "dstip"}).select(*keys, "treceived")
    if is_small(anchors):
        hits = _either_side(rows, F.broadcast(anchors), "ip_threat", "peer").groupBy("ip_threat", *keys).agg(*span)
    else:
        hits = _between(rows, anchors, keys[2:], span)
    order = [F.col(c) for c in ("tstart", "tend", "srcip", "dstip", "proto", "sport", "dport", "ipkt", "ibyt")]
    top = first_per_key(hits, ["ip_threat"], order, limit)
    return top.select("ip_threat", "tstart", "tend", "srcip", "dstip", "proto", "sport", "dport", "ipkt", "ibyt")
