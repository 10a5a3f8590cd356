"""Filters, projections and set operations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from .. import schemas
from ..functions import addresses, numeric
from ..operators import corpus, records, validate
from .registry import query

_CLEAN_FLOW = """trhour between 0 and 23 and trminute between 0 and 59 and trsec between 0 and 59 and treceived is not null
 and sip is not null and dip is not null and sport >= 0 and dport >= 0 and ibyt >= 0 and ipkt >= 0"""

_CLEAN_DNS = """frame_time is not null and frame_time <> '' and frame_time <> '-' and unix_tstamp >= 0 and frame_len >= 0
 and dns_qry_name is not null and dns_qry_name not in ('', '-', '(empty)') and ip_dst is not null and ip_dst not in ('', '-')
 and ((dns_qry_class is not null and dns_qry_class not in ('', '-')) or dns_qry_type is not null or dns_qry_rcode >= 0)"""

_CLEAN_PROXY = "p_date is not null and p_time is not null and clientip is not null and host is not null and fulluri is not null"

_FLOW_COLS = ", ".join(schemas.FLOW_IN)
_DNS_COLS = ", ".join(schemas.DNS_IN)
_PROXY_COLS = ", ".join(schemas.PROXY_IN)


@query("flt1_clean_flow", ["v_flow_dirty"], f"select {_FLOW_COLS} from v_flow_dirty where {_CLEAN_FLOW}")
def _(d):
    return validate.clean_flow(d.view("v_flow_dirty")).select(*schemas.FLOW_IN)


@query("flt2_invalid_flow", ["v_flow_dirty"], f"select {_FLOW_COLS} from v_flow_dirty where not coalesce({_CLEAN_FLOW}, false)")
def _(d):
    return validate.invalid_records(d.view("v_flow_dirty"), "flow")


@query("flt2_invalid_flow_literal", ["v_flow_dirty"], f"""
select {_FLOW_COLS} from v_flow_dirty where (trhour between 0 and 23 and trminute between 0 and 59 and trsec between 0 and 59
 and treceived is null) or sip is null or dip is null or sport is null or sport < 0 or dport is null or dport < 0
 or ibyt is null or ibyt < 0 or ipkt is null or ipkt < 0""")
def _(d):
    return validate.invalid_flow(d.view("v_flow_dirty"), strict_reference=True).select(*schemas.FLOW_IN)


@query("flt3_clean_dns", ["v_dns_dirty"], f"select {_DNS_COLS} from v_dns_dirty where {_CLEAN_DNS}")
def _(d):
    return validate.clean_dns(d.view("v_dns_dirty")).select(*schemas.DNS_IN)


@query("flt4_invalid_dns", ["v_dns_dirty"], f"select {_DNS_COLS} from v_dns_dirty where not coalesce({_CLEAN_DNS}, false)")
def _(d):
    return validate.invalid_records(d.view("v_dns_dirty"), "dns")


@query("flt4_invalid_dns_literal", ["v_dns_dirty"], f"""
select {_DNS_COLS} from v_dns_dirty where frame_time is null or frame_time in ('', '-') or unix_tstamp is null or frame_len is null
 or dns_qry_name is null or dns_qry_name in ('', '-', '(empty)') or ip_dst is null or ip_dst in ('', '-')
 or ((dns_qry_class is null or dns_qry_class in ('', '-')) and dns_qry_type is null and dns_qry_rcode is null)""")
def _(d):
    return validate.invalid_dns(d.view("v_dns_dirty"), strict_reference=True).select(*schemas.DNS_IN)


@query("flt5_clean_proxy", ["v_proxy_dirty"], f"select {_PROXY_COLS} from v_proxy_dirty where {_CLEAN_PROXY}")
def _(d):
    return validate.clean_proxy(d.view("v_proxy_dirty")).select(*schemas.PROXY_IN)


@query("flt6_invalid_proxy", ["v_proxy_dirty"], f"select {_PROXY_COLS} from v_proxy_dirty where not ({_CLEAN_PROXY})")
def _(d):
    return validate.invalid_records(d.view("v_proxy_dirty"), "proxy")


@query("flt7_scored_flow", ["v_flow"], "select treceived, sip, dip, ml_score as score from v_flow where ml_score <= 0.2 and ml_score > -1")
def _(d):
    scored = d.view("v_flow").select("treceived", "sip", "dip", F.col("ml_score").alias("score"))
    return validate.scored_below(scored, 0.2)


@query("flt7_scored_dns", ["v_dns"], "select unix_tstamp, ip_dst, dns_qry_name, ml_score as score from v_dns where ml_score <= 0.2 and ml_score > -1")
def _(d):
    return validate.scored_below(d.view("v_dns").select("unix_tstamp", "ip_dst", "dns_qry_name", F.col("ml_score").alias("score")), 0.2)


@query("flt7_scored_proxy", ["v_proxy"], "select p_date, p_time, clientip, fulluri, ml_score as score from v_proxy where ml_score <= 0.2 and ml_score > -1")
def _(d):
    return validate.scored_below(d.view("v_proxy").select("p_date", "p_time", "clientip", "fulluri", F.col("ml_score").alias("score")), 0.2)


@query("flt8_fill_dns", ["v_dns_dirty"], f"""
select frame_time, unix_tstamp, frame_len, ip_dst, dns_qry_name, coalesce(dns_qry_class, 'unknown') as dns_qry_class,
 coalesce(dns_qry_type, -1) as dns_qry_type, coalesce(dns_qry_rcode, -1) as dns_qry_rcode from v_dns_dirty where {_CLEAN_DNS}""")
def _(d):
    return validate.model_input(d.view("v_dns_dirty"), "dns")


@query("flt8_fill_proxy", ["v_proxy_dirty"], f"""
select {_PROXY_COLS.replace('useragent', "coalesce(useragent, '-') as useragent").replace('resconttype', "coalesce(resconttype, '-') as resconttype")}
from v_proxy_dirty where {_CLEAN_PROXY}""")
def _(d):
    return validate.model_input(d.view("v_proxy_dirty"), "proxy")


@query("flt9_flow_out_columns", ["v_flow"], f"select {_FLOW_COLS}, ml_score as score from v_flow")
def _(d):
    return d.view("v_flow").withColumnRenamed("ml_score", "score").select(*schemas.FLOW_OUT)


@query("flt9_dns_out_columns", ["v_dns"], f"select {_DNS_COLS}, ml_score as score from v_dns")
def _(d):
    return d.view("v_dns").withColumnRenamed("ml_score", "score").select(*schemas.DNS_OUT)


@query("flt10_flow_dialect", ["v_flow"], """
select treceived, tryear, trmonth, trday, trhour, trminute, trsec, cast(tdur as float) as tdur, sip, dip, sport, dport, proto, flag,
 cast(ipkt as float) as ipkt, cast(ibyt as float) as ibyt, cast(0 as float) as opkt, cast(0 as float) as obyt from v_flow""")
def _(d):
    other = d.view("v_flow").select(
        F.col("treceived").alias("ts"), F.col("tdur").alias("td"), F.col("sip").alias("sa"), F.col("dip").alias("da"),
        F.col("sport").alias("sp"), F.col("dport").alias("dp"), F.col("proto").alias("pr"), F.col("flag").alias("flg"), "ipkt", "ibyt",
    )
    return records.normalise_flow_dialect(other)


@query("flt11_drop_incomplete", ["v_flow_dirty"], "select * from v_flow_dirty where " + " and ".join(f"{c} is not null" for c in schemas.FLOW_IN))
def _(d):
    return records.drop_incomplete(d.view("v_flow_dirty"))


@query("flt12_classifier_input", ["v_flow_dirty"], """
select * from v_flow_dirty where sip is not null and dip is not null and tdur is not null and sport is not null and dport is not null
 and proto is not null and ipkt is not null and ibyt is not null""")
def _(d):
    return records.drop_incomplete(d.view("v_flow_dirty"), ["sip", "dip", "tdur", "sport", "dport", "proto", "ipkt", "ibyt"])


@query("flt14_low_risk_flow", ["v_flow_feedback"], "select * from v_flow_feedback where sev = 3")
def _(d):
    return records.search_equal(d.view("v_flow_feedback"), sev=3)


@query("flt14_low_risk_dns", ["v_dns_feedback"], "select dns_qry_name, ip_dst, unix_tstamp from v_dns_feedback where dns_sev = 3")
def _(d):
    return records.search_equal(d.view("v_dns_feedback"), dns_sev=3).select("dns_qry_name", "ip_dst", "unix_tstamp")


@query("flt14_low_risk_proxy", ["v_proxy_feedback"], "select fulluri, clientip, p_date, p_time from v_proxy_feedback where uri_sev = 3")
def _(d):
    return records.search_equal(d.view("v_proxy_feedback"), uri_sev=3).select("fulluri", "clientip", "p_date", "p_time")


@query("flt18_search_flow", ["v_flow_scores"], "select * from v_flow_scores where srcip = '10.0.0.7' or dstip = '10.0.0.7'")
def _(d):
    return records.search_flow(d.view("v_flow_scores"), "10.0.0.7")


@query("flt18_search_dns", ["v_dns_scores"], "select * from v_dns_scores where contains(dns_qry_name, 'amazon')")
def _(d):
    return records.search_text(d.view("v_dns_scores"), "dns_qry_name", "amazon")


@query("flt18_search_proxy", ["v_proxy_scores"], "select * from v_proxy_scores where contains(fulluri, 'example.net') and clientip = '10.2.0.8'")
def _(d):
    return records.search_equal(records.search_text(d.view("v_proxy_scores"), "fulluri", "example.net"), clientip="10.2.0.8")


@query("flt19_select_connection", ["v_flow_scores"], "select * from v_flow_scores where srcip = '10.0.0.9' and dport = 22")
def _(d):
    return records.search_equal(d.view("v_flow_scores"), srcip="10.0.0.9", dstip=None, sport=None, dport=22)


@query("flt21_notebook_filter", ["v_flow_scores"], """
select srcip, dstip, dport, ml_score from v_flow_scores where proto in ('TCP', 'UDP') and dport in (22, 443) order by ml_score""")
def _(d):
    rows = d.view("v_flow_scores").filter(F.col("proto").isin("TCP", "UDP") & F.col("dport").isin(22, 443))
    return rows.select("srcip", "dstip", "dport", "ml_score").orderBy("ml_score")


@query("flt22_high_risk_addresses", ["v_flow_threat"], """
select distinct ip from (select srcip as ip from v_flow_threat where severity = 1 union all select dstip from v_flow_threat where severity = 1) t""")
def _(d):
    return records.high_risk_addresses(d.view("v_flow_threat")).orderBy("ip")


@query("flt22_high_risk_uris", ["v_proxy_threat"], "select distinct fulluri from v_proxy_threat where uri_sev = 1")
def _(d):
    return records.search_equal(d.view("v_proxy_threat"), uri_sev=1).select("fulluri").distinct().orderBy("fulluri")


@query("flt23_replace_value", ["v_flow"], "select treceived, sip, case when proto = 'ICMP' then 'icmp6' else proto end as proto from v_flow")
def _(d):
    return d.view("v_flow").select("treceived", "sip", records.replace_value(F.col("proto"), "ICMP", "icmp6").alias("proto"))


@query("flt24_ratio", ["v_flow"], "select treceived, sip, dip, round(ibyt / cast(nullif(ipkt, 0) as double), 6) as bpp from v_flow")
def _(d):
    return d.view("v_flow").select("treceived", "sip", "dip", F.round(records.ratio(F.col("ibyt"), F.col("ipkt")), 6).alias("bpp"))


@query("flt25_watchlist_label", ["v_flow", "v_flow_threat"], """
select treceived, f.sip, f.dip, case when sip in (select srcip from v_flow_threat where severity = 1)
 or dip in (select srcip from v_flow_threat where severity = 1) then 'WANNACRY' else 'BENIGN' end as label from v_flow f""")
def _(d):
    watch = d.view("v_flow_threat").filter("severity = 1").select(F.col("srcip").alias("ip"))
    return records.label_by_watchlist(d.view("v_flow").select("treceived", "sip", "dip"), watch).select("treceived", "sip", "dip", "label")


@query("flt26_analyst_columns", ["v_flow_scores"], "select tstart, srcip, dstip, sport, dport, proto, ipkt, ibyt, opkt, obyt, ml_score from v_flow_scores")
def _(d):
    return d.view("v_flow_scores").select("tstart", "srcip", "dstip", "sport", "dport", "proto", "ipkt", "ibyt", "opkt", "obyt", "ml_score")


@query("flt27_feedback_columns", ["v_flow_feedback"], """
select cast(substr(tstart, 12, 2) as int) as trhour, cast(substr(tstart, 15, 2) as int) as trminute, cast(substr(tstart, 18, 2) as int) as trsec,
 sip, dip, sport, dport, ipkt, ibyt from v_flow_feedback where sev = 3""")
def _(d):
    from ..sources.feedback import flow_feedback_columns

    return flow_feedback_columns(d.view("v_flow_feedback"))


@query("src2_day_partition", ["v_dns"], "select * from v_dns where y = 2024 and m = 1 and d = 15")
def _(d):
    return records.on_day(d.view("v_dns"), date(2024, 1, 15))


@query("src15_top_domain_labels", ["v_top_domains"], "select distinct split_part(domain, '.', 1) as domain from v_top_domains")
def _(d):
    return corpus.top_domain_labels(d.view("v_top_domains"))


@query("set1_training_union", ["v_flow", "v_flow_feedback"], """
select trhour, sip, dip, sport, dport, proto, ibyt, ipkt, cast(1 as bigint) as weight from v_flow
union all
select cast(substr(f.tstart, 12, 2) as int), f.sip, f.dip, f.sport, f.dport, p.proto, f.ibyt, f.ipkt, cast(10 as bigint)
from v_flow_feedback f left join (select treceived, sip, dip, sport, dport, min(proto) as proto from v_flow group by 1, 2, 3, 4, 5) p
 on p.treceived = f.tstart and p.sip = f.sip and p.dip = f.dip and p.sport = f.sport and p.dport = f.dport where f.sev = 3""")
def _(d):
    from ..sources.feedback import flow_feedback

    flow = d.view("v_flow")
    return corpus.flow_training(flow, flow_feedback(d.view("v_flow_feedback"), flow.withColumnRenamed("treceived", "tstart")), 10)


@query("set2_repeat_feedback", ["v_flow_feedback"], "select f.* from v_flow_feedback f, range(5) where sev = 3")
def _(d):
    return corpus.repeat_rows(d.view("v_flow_feedback").filter("sev = 3"), 5)


@query("set5_distinct_threats", ["v_labelled"], """
select sa, pr, tr, da, sp, dp, "Class" from (select *, row_number() over (partition by sa, pr order by tr, da, sp, dp, ipkt, ibyt) as rn
 from v_labelled where "Class" <> 'background') t where rn = 1""")
def _(d):
    from ..operators.classify import distinct_threats

    threats = d.view("v_labelled").filter("Class <> 'background'")
    return distinct_threats(threats, ["tr", "da", "sp", "dp", "ipkt", "ibyt"]).select("sa", "pr", "tr", "da", "sp", "dp", "Class")


@query("set6_distinct_names", ["v_dns"], "select distinct dns_qry_name from v_dns")
def _(d):
    return d.view("v_dns").select("dns_qry_name").distinct()


@query("fn36_cast_value", ["v_proxy"], """
select respcode, uripath, try_cast(case when regexp_full_match(respcode, '\\s*[-+]?[0-9]+\\s*') then respcode end as bigint) as code_int,
 try_cast(csbytes as varchar) as csbytes, case when try_cast(uripath as double) is null then uripath end as path_text from v_proxy""")
def _(d):
    rows = d.view("v_proxy")
    code, path = numeric.cast_number(F.col("respcode")), numeric.cast_number(F.col("uripath"))
    return rows.select("respcode", "uripath", code["as_int"].alias("code_int"), F.col("csbytes").cast("string").alias("csbytes"), path["as_text"].alias("path_text"))


@query("fn37_valid_addresses", ["v_flow_dirty"], """
select sip, dip, treceived from v_flow_dirty where regexp_full_match(sip, '((25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(\\.|$)){4}')
 and regexp_full_match(dip, '((25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(\\.|$)){4}')""")
def _(d):
    return validate.valid_addresses(d.view("v_flow_dirty"), "sip", "dip").select("sip", "dip", "treceived")


@query("fn13_ip_to_number", ["v_flow"], """
select sip, cast(split_part(sip, '.', 1) as bigint) * 16777216 + cast(split_part(sip, '.', 2) as bigint) * 65536
 + cast(split_part(sip, '.', 3) as bigint) * 256 + cast(split_part(sip, '.', 4) as bigint) as ip_num from v_flow""")
def _(d):
    return d.view("v_flow").select("sip", addresses.ip_to_long(F.col("sip")).alias("ip_num"))
