"""Daily analytics of scored results: enrichment plus detail tables.

The top list of a day is short and is read by every enrichment and detail join,
so it is kept as a table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timestamps import frame_clock
from ..operators import details, enrich, summaries
from ..operators.records import most_suspicious, ranked
from ..session import cut_lineage
from .investigate import DNS_KEYS, FLOW_KEYS, PROXY_KEYS


@dataclass
class Lookups:
    """Lookup tables of an installation; a missing one leaves its columns empty."""

    internal: DataFrame | None = None
    geo: DataFrame | None = None
    names: DataFrame | None = None
    suffixes: DataFrame | None = None
    classes: DataFrame | None = None
    types: DataFrame | None = None
    rcodes: DataFrame | None = None
    http_codes: DataFrame | None = None
    reputation: list[DataFrame] = field(default_factory=list)


def _empty(df: DataFrame, value, *columns: str) -> DataFrame:
    return df.withColumns({c: F.lit(value) for c in columns})


def flow_scores(results: DataFrame, lookups: Lookups, limit: int) -> DataFrame:
    """Top flows with rank, internal flags, geography and reputation."""
    rows = cut_lineage(ranked(most_suspicious(results, limit, "ml_score", FLOW_KEYS), "ml_score", FLOW_KEYS))
    sides = {"srcip": "srcip_internal", "dstip": "dstip_internal"}
    rows = enrich.with_internal_flags(rows, lookups.internal, sides) if lookups.internal is not None else _empty(rows, 0, *sides.values())
    places = {"srcip": ("src_geoloc", "src_domain"), "dstip": ("dst_geoloc", "dst_domain")}
    if lookups.geo is not None:
        rows = enrich.with_geo(rows, lookups.geo, places)
    else:
        rows = _empty(rows, "", *[c for pair in places.values() for c in pair])
    for column, out in (("srcip", "src_rep"), ("dstip", "dst_rep")):
        rows = enrich.with_reputation(rows, column, lookups.reputation, out) if lookups.reputation else _empty(rows, "", out)
    return rows


def flow_day(flow: DataFrame, results: DataFrame, lookups: Lookups, limit: int) -> dict[str, DataFrame]:
    """Derived flow tables of the records and results of a day (or of many)."""
    scores = cut_lineage(flow_scores(results, lookups, limit))
    return {
        "flow_scores": scores,
        "flow_edge": details.flow_edges(flow, scores),
        "flow_chords": details.chords(flow, scores),
        "flow_ingest_summary": summaries.flow_per_minute(flow),
    }


def _dns_names(rows: DataFrame, lookups: Lookups) -> DataFrame:
    pairs = (
        ("dns_qry_class", "dns_qry_class_name", lookups.classes, ("decimal_key", "hex_key")),
        ("dns_qry_type", "dns_qry_type_name", lookups.types, ("k",)),
        ("dns_qry_rcode", "dns_qry_rcode_name", lookups.rcodes, ("k",)),
    )
    for column, out, table, keys in pairs:
        if table is None:
            rows = _empty(rows, "", out)
        else:
            rows = enrich.with_code_name(rows, enrich.code_names(table, *keys), column, out)
    return rows


def dns_scores(results: DataFrame, lookups: Lookups, limit: int) -> DataFrame:
    """Top DNS replies with registered domain, reputation, hour, code names and context."""
    rows = cut_lineage(most_suspicious(results, limit, "ml_score", DNS_KEYS))
    rows = enrich.with_registered_domain(rows, lookups.suffixes) if lookups.suffixes is not None else _empty(rows, "", "tld")
    rows = enrich.with_reputation(rows, "dns_qry_name", lookups.reputation, "query_rep") if lookups.reputation else _empty(rows, "", "query_rep")
    rows = rows.withColumn("hh", F.get(F.split(frame_clock(F.col("frame_time")), ":"), F.lit(0)))
    rows = _dns_names(rows, lookups)
    if lookups.names is None:
        return _empty(rows, "", "network_context")
    return enrich.with_client_name(rows, lookups.names, "ip_dst")


def dns_day(dns: DataFrame, results: DataFrame, lookups: Lookups, limit: int) -> dict[str, DataFrame]:
    scores = cut_lineage(dns_scores(results, lookups, limit))
    edges = _dns_names(details.dns_edges(dns, scores), lookups)
    if lookups.names is not None:
        edges = enrich.with_client_name(edges, lookups.names, "ip_dst")
    return {
        "dns_scores": scores,
        "dns_edge": edges,
        "dns_dendro": details.dns_dendrogram(dns, scores),
        "dns_ingest_summary": summaries.dns_per_minute(dns),
    }


def proxy_scores(results: DataFrame, lookups: Lookups, limit: int) -> DataFrame:
    """Top requests with URI reputation, response name and client context."""
    rows = cut_lineage(most_suspicious(results, limit, "ml_score", PROXY_KEYS))
    rows = enrich.with_reputation(rows, "fulluri", lookups.reputation, "uri_rep") if lookups.reputation else _empty(rows, "", "uri_rep")
    rows = _response_names(rows, lookups)
    if lookups.names is None:
        return _empty(rows, "", "network_context")
    return enrich.with_client_name(rows, lookups.names, "clientip")


def _response_names(rows: DataFrame, lookups: Lookups) -> DataFrame:
    if lookups.http_codes is None:
        return _empty(rows, "", "respcode_name")
    return enrich.with_code_name(rows, enrich.code_names(lookups.http_codes, "k"), "respcode", "respcode_name")


def proxy_day(proxy: DataFrame, results: DataFrame, lookups: Lookups, limit: int) -> dict[str, DataFrame]:
    scores = cut_lineage(proxy_scores(results, lookups, limit))
    return {
        "proxy_scores": scores,
        "proxy_edge": _response_names(details.proxy_edges(proxy, scores), lookups),
        "proxy_ingest_summary": summaries.proxy_per_minute(proxy),
    }
