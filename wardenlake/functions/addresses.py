"""IPv4 text, numbers and range texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IPV4_PATTERN = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def is_ipv4(ip: Column) -> Column:
    return F.coalesce(ip.rlike(IPV4_PATTERN), F.lit(False))


def ip_to_long(ip: Column) -> Column:
    """Dotted text to a number; null if the text is no address."""
    ip = F.trim(ip)
    total = None
    for i, weight in enumerate((16777216, 65536, 256, 1)):
        term = F.get(F.split(ip, r"\."), F.lit(i)).try_cast("bigint") * F.lit(weight).cast("bigint")
        total = term if total is None else total + term
    return F.when(is_ipv4(ip), total)


def range_bounds(text: Column) -> Column:
    """Struct (lo, hi) of a CIDR text, a dash range or a single address."""
    slash = F.split(text, "/")
    dash = F.split(text, "-")
    cidr_lo = ip_to_long(F.get(slash, F.lit(0)))
    bits = F.get(slash, F.lit(1)).try_cast("int")
    cidr_hi = cidr_lo + F.pow(F.lit(2.0), F.lit(32) - bits).cast("bigint") - 1
    single = ip_to_long(text)
    lo = F.when(text.contains("/"), cidr_lo).when(
        text.contains("-"), ip_to_long(F.get(dash, F.lit(0)))
    ).otherwise(single)
    hi = F.when(text.contains("/"), cidr_hi).when(
        text.contains("-"), ip_to_long(F.get(dash, F.lit(1)))
    ).otherwise(single)
    return F.struct(lo.alias("lo"), hi.alias("hi"))


def context_category(name: Column) -> Column:
    """Category of a network-context name; the default is DMZ."""
    name = F.coalesce(name, F.lit(""))
    out = None
    for mark in ("VPN", "DMZ", "Proxy", "FW"):
        out = F.when(name.contains(mark), F.lit(mark)) if out is None else out.when(name.contains(mark), F.lit(mark))
    return out.otherwise(F.lit("DMZ"))
