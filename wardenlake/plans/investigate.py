"""Questions an analyst asks of the result tables, one function each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.texts import escaped_newlines, request_key
from ..operators.details import without_scored, without_scored_flow
from ..operators.records import between_days, on_day, search_equal, search_flow, search_text

LIST_LIMIT = 250
FLOW_KEYS = ("tstart", "srcip", "dstip", "sport", "dport", "proto", "ipkt", "ibyt")
DNS_KEYS = ("unix_tstamp", "ip_dst", "dns_qry_name", "dns_qry_type", "dns_qry_rcode", "frame_len")
PROXY_KEYS = ("tdate", "time", "clientip", "fulluri", "reqmethod", "respcode", "referer", "duration", "scbytes", "csbytes")


def _listed(rows: DataFrame, keys, limit: int) -> DataFrame:
    return rows.orderBy("ml_score", *keys).limit(limit)


def _scored(threat: DataFrame, day, scope: str) -> DataFrame:
    if scope not in ("all", "day"):
        raise ValueError(f"unknown scope {scope!r}")
    return on_day(threat, day) if scope == "day" else threat


def flow_suspicious(scores, threat, day=None, ip=None, limit: int = LIST_LIMIT, scored_scope: str = "all") -> DataFrame:
    """Suspicious flows that no analyst has scored yet, lowest score first.

    A connection scored on any day is hidden on every day, unless the scope is 'day'.
    """
    rows = without_scored_flow(on_day(scores, day), _scored(threat, day, scored_scope))
    return _listed(search_flow(rows, ip), FLOW_KEYS, limit)


def dns_suspicious(scores, threat, day=None, ip=None, query=None, limit: int = LIST_LIMIT, scored_scope: str = "all") -> DataFrame:
    rows = without_scored(on_day(scores, day), _scored(threat, day, scored_scope), "dns_qry_name")
    rows = search_equal(rows, ip_dst=ip)
    return _listed(search_text(rows, "dns_qry_name", query), DNS_KEYS, limit)


def proxy_suspicious(scores, threat, day=None, uri=None, ip=None, limit: int = LIST_LIMIT, scored_scope: str = "all") -> DataFrame:
    rows = without_scored(on_day(scores, day), _scored(threat, day, scored_scope), "fulluri")
    rows = search_equal(rows, clientip=ip)
    return _listed(search_text(rows, "fulluri", uri), PROXY_KEYS, limit)


def flow_details(edges, src: str, dst: str, day=None, hour=None, minute=None) -> DataFrame:
    """Edge rows between two addresses in either direction, by time."""
    a, b = F.col("srcip"), F.col("dstip")
    rows = on_day(edges, day).filter(((a == src) & (b == dst)) | ((a == dst) & (b == src)))
    return search_equal(rows, hh=hour, mn=minute).orderBy("tstart")


def of_anchor(table, column: str, value: str, day=None) -> DataFrame:
    """Rows of a derived table of one anchor: chords, timelines, dendrograms."""
    return search_equal(on_day(table, day), **{column: value})


def dns_progression(dendro, ip=None, query=None, day=None) -> DataFrame:
    """Threat dendrogram of an anchor: its queries for an address, its clients for a name."""
    if not ip and not query:
        raise ValueError("an address or a query name is needed")
    other = "dns_qry_name" if ip else "ip_dst"
    return of_anchor(dendro, "anchor", query or ip, day).select("anchor", "total", other)


def comments(storyboard, day=None) -> DataFrame:
    return on_day(storyboard, day).withColumn("text", escaped_newlines(F.col("text")))


def ingest_summary(per_minute, first, last) -> DataFrame:
    """Totals per minute in a range of days, compared as dates."""
    return between_days(per_minute, first, last).select("tdate", "total").orderBy("tdate")


def dns_expanded(dns, ip=None, query=None, day=None, limit: int = 20) -> DataFrame:
    """Most frequent counterparts of a client or of a query name."""
    if not ip and not query:
        raise ValueError("an address or a query name is needed")
    rows = search_equal(on_day(dns, day), **({"ip_dst": ip} if ip else {"dns_qry_name": query}))
    counts = rows.groupBy("dns_qry_name", "ip_dst").agg(F.count(F.lit(1)).alias("total"))
    return counts.orderBy(F.col("total").desc(), "dns_qry_name", "ip_dst").limit(limit)


def proxy_expanded(proxy, uri: str, day=None) -> DataFrame:
    """Requests of a URI and requests that it referred to, by time."""
    rows = on_day(proxy, day).filter((F.col("fulluri") == uri) | (F.col("referer") == uri))
    return rows.select(
        "p_date", "p_time", "clientip", "username", "duration", "fulluri", "webcat", "respcode", "reqmethod", "useragent",
        "resconttype", "referer", "uriport", "serverip", "scbytes", "csbytes",
    ).orderBy("p_time")


def score_flow(scores, severity: int, day=None, **selector) -> tuple[DataFrame, DataFrame]:
    """Severity rows and feedback rows of the flows a selector picks
    (any of srcip, dstip, sport, dport)."""
    if not any(v is not None for v in selector.values()):
        raise ValueError("a selector is needed")
    rows = search_equal(on_day(scores, day), **selector)
    sev = F.lit(severity)
    threat = rows.select("tstart", "srcip", "dstip", "sport", "dport", sev.alias("severity"), "y", "m", "d")
    feedback = rows.select(
        sev.alias("sev"), "tstart", F.col("srcip").alias("sip"), F.col("dstip").alias("dip"), "sport", "dport", "ipkt", "ibyt"
    )
    return threat, feedback


def score_dns(scores, ip=None, name=None, ip_sev: int = 0, dns_sev: int = 0, day=None) -> tuple[DataFrame, DataFrame]:
    """Severity rows and feedback rows of the replies to a client or for a name."""
    if not ip and not name:
        raise ValueError("an address or a query name is needed")
    by_ip = (F.col("ip_dst") == ip) if ip else F.lit(False)
    by_name = (F.col("dns_qry_name") == name) if name else F.lit(False)
    rows = on_day(scores, day).filter(by_ip | by_name)
    threat = rows.select(
        "unix_tstamp", "ip_dst", "dns_qry_name",
        F.when(by_ip, F.lit(ip_sev)).otherwise(0).alias("ip_sev"),
        F.when(by_name, F.lit(dns_sev)).otherwise(0).alias("dns_sev"),
        "y", "m", "d",
    )
    feedback = rows.select(
        "frame_time", "frame_len", "ip_dst", "dns_qry_name", "dns_qry_class", "dns_qry_type", "dns_qry_rcode",
        F.col("ml_score").alias("score"), "tld", "query_rep", "hh", F.lit(ip_sev).alias("ip_sev"), F.lit(dns_sev).alias("dns_sev"),
        "dns_qry_class_name", "dns_qry_type_name", "dns_qry_rcode_name", "network_context", "unix_tstamp",
    )
    return threat, feedback


def score_proxy(scores, uri: str, severity: int, day=None) -> tuple[DataFrame, DataFrame]:
    """Severity rows and feedback rows of the requests of a URI."""
    rows = search_equal(on_day(scores, day), fulluri=uri)
    threat = rows.select("tdate", "fulluri", F.lit(severity).alias("uri_sev"), "y", "m", "d")
    feedback = rows.select(
        F.col("tdate").alias("p_date"), F.col("time").alias("p_time"), "clientip", "host", "reqmethod", "useragent",
        "resconttype", "duration", "username", "webcat", "referer", "respcode", "uriport", "uripath", "uriquery", "serverip",
        "scbytes", "csbytes", "fulluri", "word", F.col("ml_score").alias("score"), "uri_rep", F.lit(severity).alias("uri_sev"),
        "respcode_name", "network_context",
        request_key(F.col("clientip"), F.col("fulluri"), F.col("time")).alias("hash"),
    )
    return threat, feedback


def upsert(old: DataFrame, new: DataFrame, keys) -> DataFrame:
    """New rows plus the old rows whose key they do not replace."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return new.unionByName(old.join(new.select(*keys).distinct(), keys, "left_anti"))


def without_day(table: DataFrame, day) -> DataFrame:
    """The table without one day (reset of scored connections)."""
    return table.filter(~((F.col("y") == day.year) & (F.col("m") == day.month) & (F.col("d") == day.day)))


def dns_threat_rows(expanded: DataFrame, anchor: str) -> DataFrame:
    """Threat dendrogram rows of an anchor from its expanded search."""
    return expanded.select(F.lit(anchor).alias("anchor"), "total", "dns_qry_name", "ip_dst")


def proxy_counters(expanded: DataFrame, uri: str) -> DataFrame:
    """Counts of clients, methods, content types, referers and referred URIs, as (kind, value, n).

    All five counts come from one pass; only the requests of the URI itself count a
    referer, only the others a referred URI.
    """
    own = F.col("fulluri") == uri

    def item(kind, value):
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"))

    items = F.array(
        item("clientip", F.col("clientip")),
        item("reqmethod", F.col("reqmethod")),
        item("resconttype", F.col("resconttype")),
        F.when(own, item("referer", F.col("referer"))).otherwise(item("referred", F.col("fulluri"))),
    )
    rows = expanded.select(F.explode(items).alias("i")).select("i.*")
    return rows.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))


def top_clients(expanded: DataFrame, top: int) -> DataFrame:
    """Most frequent clients of an expanded search."""
    counts = expanded.groupBy("clientip").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), "clientip").limit(top)


def proxy_timeline(proxy: DataFrame, uri: str, clients: DataFrame, names: DataFrame | None = None, day=None) -> DataFrame:
    """Spans of the requests of a URI by its top clients."""
    rows = search_equal(on_day(proxy, day), fulluri=uri).join(clients.select("clientip"), "clientip", "left_semi")
    spans = rows.groupBy("clientip", "p_time", "respcode", "p_date").agg(F.sum("duration").alias("duration"))
    at = F.concat_ws(" ", "p_date", "p_time")
    out = spans.select(
        F.lit(uri).alias("p_threat"), at.alias("tstart"), at.alias("tend"), "duration", "clientip", "respcode"
    )
    if names is None:
        return out
    side = names.select(F.col("k").alias("respcode"), F.col("name").alias("respcode_name"))
    return out.join(side, "respcode", "left").withColumn("respcode_name", F.coalesce("respcode_name", F.lit("")))


def proxy_progression(expanded: DataFrame, uri: str) -> DataFrame:
    """Distinct requests of a URI and the URIs that it referred to, one row each."""
    own = F.col("fulluri") == uri
    request = ("clientip", "referer", "reqmethod", "resconttype")
    return expanded.select(
        F.when(own, F.lit("requests")).otherwise(F.lit("referer_for")).alias("kind"),
        *[F.when(own, F.col(c)).alias(c) for c in request],
        F.when(~own, F.col("fulluri")).alias("referred"),
    ).distinct()


def proxy_progression_json(expanded: DataFrame, uri: str) -> DataFrame:
    """The progression as JSON lines, one per request or referred URI: a busy URI has
    as many lines as it needs and no task holds them all."""
    rows = proxy_progression(expanded, uri)
    body = F.struct(F.lit(uri).alias("fulluri"), "kind", "clientip", "referer", "reqmethod", "resconttype", "referred")
    return rows.select("kind", F.to_json(body).alias("json"))
