"""Behaviour words: one discrete word per record and address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import bin_index, ceil_log2, log_base_int, stable_entropy
from .timestamps import frame_clock, hour_of

WORD_ERROR = "word_error"
SCORE_ERROR = -1.0

# Port codes of flows between two low or two high ports.
LOW_TO_LOW = 111111
HIGH_TO_HIGH = 333333
LAST_LOW_PORT = 1024


def _join_or_error(*parts: Column) -> Column:
    """Underscore-joined text; any null part makes it the error word."""
    pieces = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit("_"))
        pieces.append(part.cast("string"))
    return F.coalesce(F.concat(*pieces), F.lit(WORD_ERROR))


def flow_words(hour="trhour", sport="sport", dport="dport", proto="proto", ibyt="ibyt", ipkt="ipkt") -> Column:
    """Struct (src_word, dst_word) of a flow.

    The port part is the port that identifies the service; the side that owns
    that port gets the ``-1_`` mark.
    """
    s, d = F.col(sport), F.col(dport)
    service = (
        F.when((s == 0) & (d == 0), F.lit(0))
        .when(d == 0, s)
        .when(s == 0, d)
        .when((s <= LAST_LOW_PORT) & (d <= LAST_LOW_PORT), F.lit(LOW_TO_LOW))
        .when(s <= LAST_LOW_PORT, s)
        .when(d <= LAST_LOW_PORT, d)
        .otherwise(F.lit(HIGH_TO_HIGH))
    )
    src_owns = ((d == 0) & (s > 0)) | ((s > 0) & (s <= LAST_LOW_PORT) & (d > LAST_LOW_PORT))
    dst_owns = ((s == 0) & (d > 0)) | ((d > 0) & (d <= LAST_LOW_PORT) & (s > LAST_LOW_PORT))
    base = _join_or_error(
        service,
        F.coalesce(F.col(proto), F.lit("null")),
        F.col(hour),
        ceil_log2(F.col(ibyt) + 1),
        ceil_log2(F.col(ipkt) + 1),
    )
    # A null port leaves both marks unknown: that record is an error word.
    base = F.when(s.isNotNull() & d.isNotNull(), base).otherwise(F.lit(WORD_ERROR))

    def mark(owns: Column) -> Column:
        return F.when((base != WORD_ERROR) & owns, F.concat(F.lit("-1_"), base)).otherwise(base)

    return F.struct(mark(src_owns).alias("src_word"), mark(dst_owns).alias("dst_word"))


def dns_word(
    info: Column,
    frame_time="frame_time",
    frame_len="frame_len",
    qry_type="dns_qry_type",
    rcode="dns_qry_rcode",
) -> Column:
    """Word of a DNS reply; ``info`` is the struct of ``domains.domain_info``."""
    return _join_or_error(
        info["top_domain"],
        log_base_int(F.col(frame_len), 2),
        hour_of(frame_clock(F.col(frame_time))),
        log_base_int(info["subdomain_length"], 2),
        bin_index(info["subdomain_entropy"]),
        log_base_int(info["num_periods"], 2),
        F.col(qry_type),
        F.col(rcode),
    )


def proxy_word(
    host_class: Column,
    agent_count: Column,
    p_time="p_time",
    method="reqmethod",
    uri="fulluri",
    content_type="resconttype",
    respcode="respcode",
) -> Column:
    """Word of a proxy request."""
    content = F.col(content_type)
    major = F.when(content.rlike("^/+$"), F.lit("unknown_content_type")).otherwise(
        F.get(F.split(content, "/"), F.lit(0))
    )
    return _join_or_error(
        host_class,
        hour_of(F.col(p_time)),
        F.coalesce(F.col(method), F.lit("null")),
        bin_index(stable_entropy(F.col(uri))),
        major,
        log_base_int(agent_count, 2),
        log_base_int(F.length(F.col(uri)), 2),
        F.coalesce(F.col(respcode), F.lit("unknown_response_code")),
    )
