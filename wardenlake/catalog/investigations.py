"""Analyst questions, scoring, storyboards and the daily jobs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import corpus, details, enrich, summaries
from ..plans import daily, day_run, investigate, storyboard
from ..session import work_path
from .aggregates import _TOP_SQL, _internal_scores, _tops, first_uri
from .enrichment import CONTEXT_SQL, GEO_SQL, REP_SQL, TLD_SQL, anchors, feeds, ip_num_sql
from .registry import query
from .words import proxy_word_sql

_IP = "10.0.0.7"
_CLIENT = "10.1.0.8"


@query("inv1_flow_suspicious", ["v_flow_scores", "v_flow_threat"], """
select fs.* from v_flow_scores fs where not exists (select 1 from v_flow_threat ft where ft.srcip = fs.srcip or ft.dstip = fs.dstip)
order by ml_score, tstart, srcip, dstip, sport, dport, proto, ipkt, ibyt limit 250""")
def _(d):
    return investigate.flow_suspicious(d.view("v_flow_scores"), d.view("v_flow_threat"))


@query("inv1_flow_suspicious_ip", ["v_flow_scores"], f"""
select * from v_flow_scores where (srcip = '{_IP}' or dstip = '{_IP}') order by ml_score, tstart, srcip, dstip, sport, dport, proto, ipkt, ibyt limit 250""")
def _(d):
    nothing = d.view("v_flow_threat").filter(F.lit(False))
    return investigate.flow_suspicious(d.view("v_flow_scores"), nothing, ip=_IP)


@query("inv2_flow_details", ["v_flow"], """
, p as (select min(sip || ' ' || dip) as k from v_flow)
select treceived as tstart, sip as srcip, dip as dstip, sport, dport, ibyt, ipkt from v_flow, p
where (sip = split_part(k, ' ', 1) and dip = split_part(k, ' ', 2)) or (dip = split_part(k, ' ', 1) and sip = split_part(k, ' ', 2))""")
def _(d):
    flow = d.view("v_flow")
    src, dst = flow.agg(F.min(F.concat_ws(" ", "sip", "dip"))).first()[0].split(" ")
    edges = flow.withColumnsRenamed({"treceived": "tstart", "sip": "srcip", "dip": "dstip", "h": "hh", "trminute": "mn"})
    return investigate.flow_details(edges, src, dst).select("tstart", "srcip", "dstip", "sport", "dport", "ibyt", "ipkt")


@query("inv3_chords_of", ["v_flow"], f"select sip as srcip, dip as dstip, cast(sum(ibyt) as bigint) as ibyt, cast(sum(ipkt) as bigint) as ipkt from v_flow where sip = '{_IP}' group by 1, 2")
def _(d):
    return investigate.of_anchor(details.pair_totals(d.view("v_flow")), "srcip", _IP)


@query("inv3_scored_connections", ["v_flow_threat"], "select tstart, srcip, dstip, sport, dport, severity from v_flow_threat")
def _(d):
    return d.view("v_flow_threat").select("tstart", "srcip", "dstip", "sport", "dport", "severity")


@query("inv3_flow_comments", ["v_storyboard"], "select ip_threat, title, replace(text, chr(10), '\\n') as text, y, m, d from v_storyboard")
def _(d):
    return investigate.comments(d.view("v_storyboard"))


@query("inv4_flow_ingest_summary", ["v_flow"], """
select substr(treceived, 1, 16) as tdate, count(*) as total from v_flow where make_date(y, m, d) between date '1996-11-20' and date '1999-02-10' group by 1""")
def _(d):
    rows = summaries.flow_per_minute(d.view("v_flow"))
    day = F.split(F.substring("tdate", 1, 10), "-")
    rows = rows.withColumns({c: F.get(day, F.lit(i)).cast("int") for i, c in enumerate("ymd")})
    return investigate.ingest_summary(rows, date(1996, 11, 20), date(1999, 2, 10))


@query("inv4_dns_ingest_summary", ["v_dns"], """
select strftime(make_timestamp(unix_tstamp * 1000000), '%Y-%m-%d %H:%M') as tdate, count(*) as total from v_dns where make_date(y, m, d) between date '2023-12-05' and date '2024-01-20' group by 1""")
def _(d):
    rows = summaries.dns_per_minute(d.view("v_dns"))
    day = F.split(F.substring("tdate", 1, 10), "-")
    rows = rows.withColumns({c: F.get(day, F.lit(i)).cast("int") for i, c in enumerate("ymd")})
    return investigate.ingest_summary(rows, date(2023, 12, 5), date(2024, 1, 20))


@query("inv4_proxy_ingest_summary", ["v_proxy"], """
select p_date || ' ' || substr(p_time, 1, 5) as tdate, count(*) as total from v_proxy where make_date(y, m, d) between date '2023-12-20' and date '2024-01-11' group by 1""")
def _(d):
    rows = summaries.proxy_per_minute(d.view("v_proxy"))
    day = F.split(F.substring("tdate", 1, 10), "-")
    rows = rows.withColumns({c: F.get(day, F.lit(i)).cast("int") for i, c in enumerate("ymd")})
    return investigate.ingest_summary(rows, date(2023, 12, 20), date(2024, 1, 11))


@query("inv5_flow_severity", ["v_flow_scores"], f"""
select tstart, srcip, dstip, sport, dport, cast(3 as int) as severity, y, m, d from v_flow_scores where srcip = '{_IP}' and dport = 443""")
def _(d):
    return investigate.score_flow(d.view("v_flow_scores"), 3, srcip=_IP, dport=443)[0]


@query("inv5_flow_feedback", ["v_flow_scores"], f"""
select cast(3 as int) as sev, tstart, srcip as sip, dstip as dip, sport, dport, ipkt, ibyt from v_flow_scores where dstip = '{_IP}'""")
def _(d):
    return investigate.score_flow(d.view("v_flow_scores"), 3, dstip=_IP)[1]


@query("inv6_flow_expanded", ["v_flow"], f"""
select sip as srcip, dip as dstip, sport, dport, min(treceived) as firstseen, max(treceived) as lastseen, count(*) as conns,
 max(ipkt) as maxpkts, round(avg(ipkt), 6) as avgpkts, max(ibyt) as maxbyts, round(avg(ibyt), 6) as avgbyts from v_flow where sip = '{_IP}' or dip = '{_IP}' group by 1, 2, 3, 4""")
def _(d):
    rows = storyboard.expanded_search(d.view("v_flow"), _IP)
    return rows.withColumns({"avgpkts": F.round("avgpkts", 6), "avgbyts": F.round("avgbyts", 6)})


def _placed(d):
    return storyboard.with_place(_tops(d), d.view("v_context"), d.view("v_geo"))


@query("inv7_storyboard_places", ["v_flow", "v_flow_threat", "v_context", "v_geo"], "," + _TOP_SQL
       + ", ips as (select ip from tops union select peer from tops)," + CONTEXT_SQL + "," + GEO_SQL + """
select t.ip_threat, t.ip, t.direction, t.conns, t.maxbytes, t.peer, ctx.name as nwloc, a.geo_loc as geo_loc, b.geo_loc as peer_geo_loc
from tops t left join ctx using (ip) left join geo a on a.ip = t.ip left join geo b on b.ip = t.peer""")
def _(d):
    return _placed(d).select(
        "ip_threat", "ip", "direction", "conns", "maxbytes", "peer", "nwloc", F.col("geo.geo_loc").alias("geo_loc"),
        F.col("geo_peer.geo_loc").alias("peer_geo_loc"),
    )


@query("fn39_map_points", ["v_flow", "v_flow_threat", "v_geo"], "," + _TOP_SQL + ", ips as (select ip from tops union select peer from tops)," + GEO_SQL + """
select t.ip_threat, cast(case direction when 'two way' then 1 when 'Inbound Only' then 2 else 3 end as int) as type, case direction when 'two way' then 'destips' else 'sourceips' end as side,
 t.ip, a.owner as location, cast(a.longitude as double) as longitude, cast(a.latitude as double) as latitude from tops t join geo a on a.ip = t.ip
union all
select t.ip_threat, cast(case direction when 'Inbound Only' then 2 else 3 end as int), 'destips', t.peer, a.owner, cast(b.longitude as double), cast(b.latitude as double)
 from tops t left join geo a on a.ip = t.ip join geo b on b.ip = t.peer where direction <> 'two way'""")
def _(d):
    return storyboard.map_points(_placed(d))


@query("fn39_map_json")
def _(d):
    return storyboard.map_json(_placed(d))


@query("fn39_impact_json")
def _(d):
    return storyboard.impact_json(_placed(d))


@query("fn39_progression_json")
def _(d):
    return storyboard.progression_json(_placed(d))


@query("inv8_dns_suspicious", ["v_dns_scores", "v_dns_threat"], """
select s.* from v_dns_scores s where not exists (select 1 from v_dns_threat t where t.dns_qry_name = s.dns_qry_name) and contains(dns_qry_name, 'example') = false
 and contains(dns_qry_name, 'news') order by ml_score, unix_tstamp, ip_dst, dns_qry_name, dns_qry_type, dns_qry_rcode, frame_len limit 250""")
def _(d):
    return investigate.dns_suspicious(d.view("v_dns_scores"), d.view("v_dns_threat"), query="news")


@query("inv9_dns_details", ["v_dns"], "select unix_tstamp, frame_len, ip_dst, ip_src, dns_qry_name, dns_a from v_dns where dns_qry_name = 'www.news3.com.mx' and h = 9")
def _(d):
    rows = investigate.of_anchor(d.view("v_dns").filter("h = 9"), "dns_qry_name", "www.news3.com.mx")
    return rows.select("unix_tstamp", "frame_len", "ip_dst", "ip_src", "dns_qry_name", "dns_a")


@query("inv9_dns_client_details", ["v_dns"], f"select ip_dst, dns_a, dns_qry_name from v_dns where ip_dst = '{_CLIENT}'")
def _(d):
    return investigate.of_anchor(d.view("v_dns"), "ip_dst", _CLIENT).select("ip_dst", "dns_a", "dns_qry_name")


@query("inv10_dns_progression", ["v_dns"], f"""
select '{_CLIENT}' as anchor, count(*) as total, dns_qry_name from v_dns where ip_dst = '{_CLIENT}' group by dns_qry_name order by total desc, dns_qry_name limit 20""")
def _(d):
    dendro = investigate.dns_threat_rows(investigate.dns_expanded(d.view("v_dns"), ip=_CLIENT), _CLIENT)
    return investigate.dns_progression(dendro, ip=_CLIENT)


def _dns_scores_full(d):
    """All scored replies with the analyst columns."""
    rows = enrich.with_registered_domain(d.view("v_dns_scores"), d.view("v_suffixes"))
    rows = enrich.with_reputation(rows, "dns_qry_name", feeds(d), "query_rep").withColumn("hh", F.lpad(F.col("h").cast("string"), 2, "0"))
    rows = daily._dns_names(rows, _lookups(d))
    return enrich.with_client_name(rows, d.view("v_client_names"), "ip_dst")


def _lookups(d):
    return daily.Lookups(
        internal=d.view("v_internal"), geo=d.view("v_geo"), names=d.view("v_client_names"), suffixes=d.view("v_suffixes"),
        classes=d.view("v_iana_class"), types=d.view("v_iana_type"), rcodes=d.view("v_iana_rcode"), http_codes=d.view("v_http_code"),
        reputation=feeds(d),
    )


_DNS_FULL_VIEWS = ["v_dns", "v_dns_scores", "v_suffixes", "v_rep_scores", "v_rep_status", "v_iana_class", "v_iana_type", "v_iana_rcode", "v_client_names"]
_DNS_FULL_SQL = "," + TLD_SQL + "," + REP_SQL + """,
dfull as (select s.*, tld.tld, coalesce(rep.rep, '') as query_rep, lpad(cast(s.h as varchar), 2, '0') as hh, coalesce(c.name, 'Unknown (' || dns_qry_class || ')') as dns_qry_class_name,
 coalesce(t.name, 'Unknown (' || dns_qry_type || ')') as dns_qry_type_name, coalesce(r.name, 'Unknown (' || dns_qry_rcode || ')') as dns_qry_rcode_name, coalesce(n.name, '') as network_context
from SCORES s left join tld using (dns_qry_name) left join rep on rep.k = s.dns_qry_name left join v_iana_class c on dns_qry_class in (c.decimal_key, c.hex_key)
 left join v_iana_type t on t.k = cast(dns_qry_type as varchar) left join v_iana_rcode r on r.k = cast(dns_qry_rcode as varchar)
 left join (select ip, min(name) as name from v_client_names group by ip) n on n.ip = s.ip_dst)
"""


@query("inv11_dns_severity", ["v_dns_scores"], f"""
select unix_tstamp, ip_dst, dns_qry_name, cast(case when ip_dst = '{_CLIENT}' then 1 else 0 end as int) as ip_sev,
 cast(case when dns_qry_name = 'www.news3.com.mx' then 2 else 0 end as int) as dns_sev, y, m, d from v_dns_scores where ip_dst = '{_CLIENT}' or dns_qry_name = 'www.news3.com.mx'""")
def _(d):
    return investigate.score_dns(_dns_scores_full(d), ip=_CLIENT, name="www.news3.com.mx", ip_sev=1, dns_sev=2)[0]


@query("inv11_dns_feedback", _DNS_FULL_VIEWS, _DNS_FULL_SQL.replace("SCORES", "v_dns_scores") + f"""
select frame_time, frame_len, ip_dst, dns_qry_name, dns_qry_class, dns_qry_type, dns_qry_rcode, ml_score as score, tld, query_rep, hh, cast(1 as int) as ip_sev, cast(3 as int) as dns_sev,
 dns_qry_class_name, dns_qry_type_name, dns_qry_rcode_name, network_context, unix_tstamp from dfull where ip_dst = '{_CLIENT}'""")
def _(d):
    return investigate.score_dns(_dns_scores_full(d), ip=_CLIENT, ip_sev=1, dns_sev=3)[1]


@query("inv12_dns_expanded", ["v_dns"], """
select dns_qry_name, ip_dst, count(*) as total from v_dns where dns_qry_name = 'www.news3.com.mx' group by 1, 2 order by total desc, dns_qry_name, ip_dst limit 20""")
def _(d):
    return investigate.dns_expanded(d.view("v_dns"), query="www.news3.com.mx")


@query("inv13_dns_threat_rows", ["v_dns"], """
select 'www.news3.com.mx' as anchor, count(*) as total, dns_qry_name, ip_dst from v_dns where dns_qry_name = 'www.news3.com.mx' group by dns_qry_name, ip_dst order by total desc, dns_qry_name, ip_dst limit 20""")
def _(d):
    return investigate.dns_threat_rows(investigate.dns_expanded(d.view("v_dns"), query="www.news3.com.mx"), "www.news3.com.mx")


@query("inv13_dns_scored_list", ["v_dns_threat"], "select unix_tstamp, ip_dst, dns_qry_name, ip_sev, dns_sev from v_dns_threat where make_date(y, m, d) = date '2024-01-10'")
def _(d):
    from ..operators.records import on_day

    return on_day(d.view("v_dns_threat"), date(2024, 1, 10)).select("unix_tstamp", "ip_dst", "dns_qry_name", "ip_sev", "dns_sev")


@query("inv14_proxy_suspicious", ["v_proxy_scores", "v_proxy_threat"], """
select s.* from v_proxy_scores s where not exists (select 1 from v_proxy_threat t where t.fulluri = s.fulluri)
order by ml_score, tdate, time, clientip, fulluri, reqmethod, respcode, referer, duration, scbytes, csbytes limit 250""")
def _(d):
    return investigate.proxy_suspicious(d.view("v_proxy_scores"), d.view("v_proxy_threat"))


@query("inv14_proxy_details", ["v_proxy"], "select p_date, p_time, clientip, fulluri from v_proxy where fulluri = (select min(fulluri) from v_proxy) and clientip = '10.2.0.0'")
def _(d):
    rows = investigate.of_anchor(d.view("v_proxy"), "fulluri", first_uri(d)).filter("clientip = '10.2.0.0'")
    return rows.select("p_date", "p_time", "clientip", "fulluri")


@query("inv15_proxy_severity", ["v_proxy_scores"], "select tdate, fulluri, cast(1 as int) as uri_sev, y, m, d from v_proxy_scores where fulluri = (select min(fulluri) from v_proxy_scores)")
def _(d):
    return investigate.score_proxy(d.view("v_proxy_scores").withColumns({c: F.lit("") for c in ("word", "uri_rep", "respcode_name", "network_context")}), first_uri(d), 1)[0]


@query("inv15_proxy_feedback", ["v_proxy", "v_top_domains", "v_client_names", "v_http_code"], proxy_word_sql().strip() + """
select p_date, p_time, clientip, host, reqmethod, useragent, resconttype, duration, username, webcat, referer, respcode, uriport, uripath, uriquery, serverip, scbytes, csbytes,
 fulluri, word, ml_score as score, '' as uri_rep, cast(2 as int) as uri_sev, coalesce(c.name, 'Unknown (' || respcode || ')') as respcode_name, coalesce(n.name, '') as network_context,
 md5(clientip || fulluri) || substr(p_time, 1, 2) as hash from pw left join v_http_code c on c.k = respcode left join (select ip, min(name) as name from v_client_names group by ip) n on n.ip = clientip
where fulluri = (select min(fulluri) from v_proxy)""")
def _(d):
    rows = d.view("v_proxy")
    scores = corpus.with_proxy_word(rows, d.view("v_top_domains"), corpus.agent_counts(rows)).withColumnsRenamed({"p_date": "tdate", "p_time": "time"})
    scores = scores.withColumn("uri_rep", F.lit(""))
    scores = enrich.with_code_name(scores, enrich.code_names(d.view("v_http_code"), "k"), "respcode", "respcode_name")
    scores = enrich.with_client_name(scores, d.view("v_client_names"), "clientip")
    return investigate.score_proxy(scores, first_uri(d), 2)[1]


@query("inv16_proxy_expanded", ["v_proxy"], """
, u as (select min(fulluri) as uri from v_proxy)
select p_date, p_time, clientip, username, duration, fulluri, webcat, respcode, reqmethod, useragent, resconttype, referer, uriport, serverip, scbytes, csbytes from v_proxy, u where fulluri = uri or referer = uri""")
def _(d):
    return investigate.proxy_expanded(d.view("v_proxy"), first_uri(d))


@query("inv17_proxy_progression_json")
def _(d):
    uri = first_uri(d)
    return investigate.proxy_progression_json(investigate.proxy_expanded(d.view("v_proxy"), uri), uri)


@query("inv17_proxy_progression", ["v_proxy"], """
, u as (select min(fulluri) as uri from v_proxy), e as (select * from v_proxy, u where fulluri = uri or referer = uri)
select distinct case when fulluri = uri then 'requests' else 'referer_for' end as kind, case when fulluri = uri then clientip end as clientip, case when fulluri = uri then referer end as referer,
 case when fulluri = uri then reqmethod end as reqmethod, case when fulluri = uri then resconttype end as resconttype, case when fulluri <> uri then fulluri end as referred from e""")
def _(d):
    uri = first_uri(d)
    return investigate.proxy_progression(investigate.proxy_expanded(d.view("v_proxy"), uri), uri)


@query("inv18_proxy_scored_list", ["v_proxy_threat"], "select tdate, fulluri, uri_sev from v_proxy_threat")
def _(d):
    return d.view("v_proxy_threat").select("tdate", "fulluri", "uri_sev")


@query("snk11_reset_day", ["v_dns_threat"], "select * from v_dns_threat where make_date(y, m, d) <> date '2024-01-10'")
def _(d):
    return investigate.without_day(d.view("v_dns_threat"), date(2024, 1, 10))


_OA_VIEWS = ["v_flow", "v_flow_scores", "v_internal", "v_geo", "v_rep_scores", "v_rep_status"]
_OA_LIMIT = 2000
_OA_FLOW_SQL = f""",
base as (select *, cast(row_number() over (order by ml_score, tstart, srcip, dstip, sport, dport, proto, ipkt, ibyt) - 1 as int) as rank from (select * from v_flow_scores
 order by ml_score, tstart, srcip, dstip, sport, dport, proto, ipkt, ibyt limit {_OA_LIMIT}) t),
ips as (select srcip as ip from base union select dstip from base), {GEO_SQL}, {REP_SQL},
ir as (select {ip_num_sql('lo_ip')} as lo, {ip_num_sql('hi_ip')} as hi from v_internal),
inn as (select ip from ips where exists (select 1 from ir where {ip_num_sql('ip')} between lo and hi))
select b.*, cast(case when srcip in (select ip from inn) then 1 else 0 end as int) as srcip_internal, cast(case when dstip in (select ip from inn) then 1 else 0 end as int) as dstip_internal,
 coalesce(a.geo_loc, '') as src_geoloc, coalesce(a.domain, '') as src_domain, coalesce(g.geo_loc, '') as dst_geoloc, coalesce(g.domain, '') as dst_domain,
 coalesce(r.rep, '') as src_rep, coalesce(q.rep, '') as dst_rep from base b left join geo a on a.ip = srcip left join geo g on g.ip = dstip left join rep r on r.k = srcip left join rep q on q.k = dstip"""


@query("oa1_flow_scores", _OA_VIEWS, _OA_FLOW_SQL)
def _(d):
    return daily.flow_scores(d.view("v_flow_scores"), _lookups(d), _OA_LIMIT)


@query("oa1_written_flow_scores", _OA_VIEWS, _OA_FLOW_SQL.replace("select b.*,", "select b.* exclude (y, m, d),"))
def _(d):
    """The daily job, run twice over all flows as those of one day, and its scores read back."""
    root, day = work_path(d.spark, "oa"), date(2024, 1, 31)
    for _turn in range(2):
        day_run.run("flow", d.view("v_flow"), d.view("v_flow_scores"), _lookups(d), root, day, _OA_LIMIT, whole=True)
    return d.spark.read.parquet(f"{root}/flow_scores").drop("y", "m", "d")


@query("oa1_flow_chords")
def _(d):
    return daily.flow_day(d.view("v_flow"), d.view("v_flow_scores"), _lookups(d), _OA_LIMIT)["flow_chords"]


@query("oa2_dns_scores", _DNS_FULL_VIEWS, _DNS_FULL_SQL.replace("SCORES", f"""(select * from v_dns_scores order by ml_score, unix_tstamp, ip_dst, dns_qry_name, dns_qry_type, dns_qry_rcode, frame_len limit {_OA_LIMIT})""")
       + "select * from dfull")
def _(d):
    return daily.dns_scores(d.view("v_dns_scores"), _lookups(d), _OA_LIMIT)


@query("oa2_dns_edges")
def _(d):
    return daily.dns_day(d.view("v_dns"), d.view("v_dns_scores"), _lookups(d), _OA_LIMIT)["dns_edge"]


@query("oa3_proxy_scores", ["v_proxy_scores", "v_http_code", "v_client_names"], f"""
, b as (select * from v_proxy_scores order by ml_score, tdate, time, clientip, fulluri, reqmethod, respcode, referer, duration, scbytes, csbytes limit {_OA_LIMIT})
select b.*, '' as uri_rep, coalesce(c.name, 'Unknown (' || respcode || ')') as respcode_name, coalesce(n.name, '') as network_context from b left join v_http_code c on c.k = respcode
 left join (select ip, min(name) as name from v_client_names group by ip) n on n.ip = clientip""")
def _(d):
    return daily.proxy_scores(d.view("v_proxy_scores"), _lookups(d), _OA_LIMIT)


@query("oa3_proxy_edges")
def _(d):
    return daily.proxy_day(d.view("v_proxy"), d.view("v_proxy_scores"), _lookups(d), _OA_LIMIT)["proxy_edge"]
