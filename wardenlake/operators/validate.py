"""Clean, invalid and scored record filters of the three sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.addresses import is_ipv4
from ..functions.words import SCORE_ERROR

# Defaults for missing optional columns.
DNS_DEFAULTS = {"dns_qry_class": "unknown", "dns_qry_type": -1, "dns_qry_rcode": -1}
PROXY_DEFAULTS = {"useragent": "-", "resconttype": "-"}

_BLANKS = ("", "-")


def _holds(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def _all(conds) -> Column:
    out = None
    for c in conds:
        out = c if out is None else out & c
    return out


def _any(conds) -> Column:
    out = None
    for c in conds:
        out = c if out is None else out | c
    return out


def _flow_time_ok() -> Column:
    return _all([
        F.col("trhour").between(0, 23),
        F.col("trminute").between(0, 59),
        F.col("trsec").between(0, 59),
    ])


def flow_is_clean() -> Column:
    known = [F.col(c).isNotNull() for c in ("treceived", "sip", "dip")]
    counts = [F.col(c) >= 0 for c in ("sport", "dport", "ibyt", "ipkt")]
    return _flow_time_ok() & _all(known + counts)


def flow_is_invalid_strict() -> Column:
    """The literal predicate: the time test guards only the missing timestamp, so a
    row whose only defect is an impossible hour is neither clean nor invalid."""
    missing = [F.col(c).isNull() for c in ("sip", "dip")]
    bad_counts = [F.col(c).isNull() | (F.col(c) < 0) for c in ("sport", "dport", "ibyt", "ipkt")]
    return (_flow_time_ok() & F.col("treceived").isNull()) | _any(missing + bad_counts)


def clean_flow(df: DataFrame) -> DataFrame:
    return df.filter(flow_is_clean())


def invalid_flow(df: DataFrame, strict_reference: bool = False) -> DataFrame:
    cond = flow_is_invalid_strict() if strict_reference else ~_holds(flow_is_clean())
    return df.filter(cond)


def _filled(name: str, *extra: str) -> Column:
    return F.col(name).isNotNull() & ~F.col(name).isin(*_BLANKS, *extra)


def dns_is_clean() -> Column:
    described = (
        _filled("dns_qry_class") | F.col("dns_qry_type").isNotNull() | (F.col("dns_qry_rcode") >= 0)
    )
    return _all([
        _filled("frame_time"),
        F.col("unix_tstamp") >= 0,
        F.col("frame_len") >= 0,
        _filled("dns_qry_name", "(empty)"),
        _filled("ip_dst"),
        described,
    ])


def dns_is_invalid_strict() -> Column:
    """The literal predicate: a negative time or length is neither clean nor invalid."""
    def blank(name, *extra):
        return F.col(name).isNull() | F.col(name).isin(*_BLANKS, *extra)

    undescribed = (
        blank("dns_qry_class") & F.col("dns_qry_type").isNull() & F.col("dns_qry_rcode").isNull()
    )
    return _any([
        blank("frame_time"),
        F.col("unix_tstamp").isNull(),
        F.col("frame_len").isNull(),
        blank("dns_qry_name", "(empty)"),
        blank("ip_dst"),
        undescribed,
    ])


def clean_dns(df: DataFrame) -> DataFrame:
    return df.filter(dns_is_clean())


def invalid_dns(df: DataFrame, strict_reference: bool = False) -> DataFrame:
    cond = dns_is_invalid_strict() if strict_reference else ~_holds(dns_is_clean())
    return df.filter(cond)


def proxy_is_clean() -> Column:
    return _all([F.col(c).isNotNull() for c in ("p_date", "p_time", "clientip", "host", "fulluri")])


def clean_proxy(df: DataFrame) -> DataFrame:
    return df.filter(proxy_is_clean())


def invalid_proxy(df: DataFrame) -> DataFrame:
    return df.filter(~proxy_is_clean())


def fill_dns(df: DataFrame) -> DataFrame:
    return df.fillna(DNS_DEFAULTS)


def fill_proxy(df: DataFrame) -> DataFrame:
    return df.fillna(PROXY_DEFAULTS)


def model_input(df: DataFrame, source: str) -> DataFrame:
    """Clean records of a source with the contract columns and defaults."""
    if source == "flow":
        return clean_flow(df).select(*schemas.FLOW_IN)
    if source == "dns":
        return fill_dns(clean_dns(df).select(*schemas.DNS_IN))
    if source == "proxy":
        return fill_proxy(clean_proxy(df).select(*schemas.PROXY_IN))
    raise ValueError(f"unknown source {source!r}")


def invalid_records(df: DataFrame, source: str) -> DataFrame:
    if source == "flow":
        return invalid_flow(df).select(*schemas.FLOW_IN)
    if source == "dns":
        return invalid_dns(df).select(*schemas.DNS_IN)
    if source == "proxy":
        return invalid_proxy(df).select(*schemas.PROXY_IN)
    raise ValueError(f"unknown source {source!r}")


def scored_below(df: DataFrame, threshold: float, score: str = "score") -> DataFrame:
    """Records at or below the threshold without the error score."""
    return df.filter((F.col(score) <= threshold) & (F.col(score) > SCORE_ERROR))


def valid_addresses(df: DataFrame, *columns: str) -> DataFrame:
    return df.filter(_all([is_ipv4(F.col(c)) for c in columns]))
