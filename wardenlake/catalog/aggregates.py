"""Aggregations, windows, top lists and graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import flowfeatures as ff
from ..operators import details, enrich, graphs, records, summaries
from ..plans import investigate, storyboard
from .enrichment import ANCHORS_SQL, CONTEXT_SQL, REP_SQL, TLD_SQL, anchors, feeds
from .registry import query

_FEATURES = ("tdur", "ipkt", "ibyt", "nconnections")


@query("agg10_flow_per_minute", ["v_flow"], """
select substr(treceived, 1, 16) as tdate, count(*) as total from v_flow where unix_tstamp is not null and sip is not null and sport is not null
 and dip is not null and dport is not null and ibyt is not null and ipkt is not null and tryear = y group by 1""")
def _(d):
    return summaries.flow_per_minute(d.view("v_flow"))


@query("agg11_dns_per_minute", ["v_dns"], "select strftime(make_timestamp(unix_tstamp * 1000000), '%Y-%m-%d %H:%M') as tdate, count(*) as total from v_dns group by 1")
def _(d):
    return summaries.dns_per_minute(d.view("v_dns"))


@query("agg12_proxy_per_minute", ["v_proxy"], "select p_date || ' ' || substr(p_time, 1, 5) as tdate, count(*) as total from v_proxy group by 1")
def _(d):
    return summaries.proxy_per_minute(d.view("v_proxy"))


_GROUPS = """select sip as srcip, dip as dstip, sport, dport, min(treceived) as firstseen, max(treceived) as lastseen, count(*) as conns,
 max(ipkt) as maxpkts, avg(ipkt) as avgpkts, max(ibyt) as maxbyts, avg(ibyt) as avgbyts from v_flow"""


@query("agg13_connection_groups", ["v_flow"], f"select * replace (round(avgpkts, 6) as avgpkts, round(avgbyts, 6) as avgbyts) from ({_GROUPS} group by 1, 2, 3, 4) t")
def _(d):
    rows = storyboard.connection_groups(d.view("v_flow"))
    return rows.withColumns({"avgpkts": F.round("avgpkts", 6), "avgbyts": F.round("avgbyts", 6)})


@query("agg14_dns_counterparts", ["v_dns"], """
select dns_qry_name, ip_dst, count(*) as total from v_dns where ip_dst = '10.1.0.8' group by 1, 2 order by total desc, dns_qry_name, ip_dst limit 20""")
def _(d):
    return investigate.dns_expanded(d.view("v_dns"), ip="10.1.0.8")


@query("agg15_pair_totals", ["v_flow"], "select sip as srcip, dip as dstip, cast(sum(ibyt) as bigint) as ibyt, cast(sum(ipkt) as bigint) as ipkt from v_flow group by 1, 2")
def _(d):
    return details.pair_totals(d.view("v_flow"))


@query("agg16_chord_matrix", ["v_flow"], """
select sip as srcip, dip as dstip, cast(sum(ibyt) as bigint) as ibyt from v_flow group by cube (sip, dip)""")
def _(d):
    return graphs.chord_matrix(details.pair_totals(d.view("v_flow")))


@query("agg17_dns_dendrogram", ["v_dns", "v_dns_scores"], """
, s as (select distinct y, m, d, ip_dst from v_dns_scores where ml_score <= 0.1),
j as (select f.*, row_number() over (partition by y, m, d, ip_dst order by unix_tstamp, dns_qry_name, dns_a) as rn from v_dns f semi join s using (y, m, d, ip_dst))
select distinct unix_tstamp, dns_a, dns_qry_name, ip_dst, y, m, d from j where rn <= 250""")
def _(d):
    return details.dns_dendrogram(d.view("v_dns"), d.view("v_dns_scores").filter("ml_score <= 0.1"))


_SPLIT_SQL = f"""{ANCHORS_SQL},
g as ({_GROUPS} group by 1, 2, 3, 4),
x as (select a.ip_threat, g.* from g join anchors a on a.ip_threat in (g.srcip, g.dstip)),
r as (select ip_threat, srcip as ip, dstip as peer, 's' as role, conns, maxbyts from x union all select ip_threat, dstip, srcip, 'd', conns, maxbyts from x),
p as (select ip_threat, ip, cast(sum(conns) filter (role = 's') as bigint) as cs, cast(sum(conns) filter (role = 'd') as bigint) as cd,
 max(struct_pack(a := maxbyts, b := peer)) filter (role = 's') as ts, max(struct_pack(a := maxbyts, b := peer)) filter (role = 'd') as td from r group by 1, 2),
split as (select ip_threat, ip, case when cs is not null and cd is not null then 'two way' when cs is not null then 'Outbound Only' else 'Inbound Only' end as direction,
 coalesce(cs, cd) as conns, coalesce(ts, td).a as maxbytes, coalesce(ts, td).b as peer from p)
"""

_TOP_SQL = _SPLIT_SQL + """,
tops as (select ip_threat, ip, direction, conns, maxbytes, peer from (select *, row_number() over (partition by ip_threat, direction order by maxbytes desc, ip) as a,
 row_number() over (partition by ip_threat, direction order by conns desc, ip) as b from split) t where a <= 20 or b <= 20)
"""


@query("set4_directions", ["v_flow", "v_flow_threat"], "," + _SPLIT_SQL + "select * from split")
def _(d):
    return storyboard.directions(storyboard.expanded_search_all(d.view("v_flow"), anchors(d)))


def _tops(d):
    return storyboard.top_connections(storyboard.directions(storyboard.expanded_search_all(d.view("v_flow"), anchors(d))))


@query("win4_top_per_direction", ["v_flow", "v_flow_threat"], "," + _TOP_SQL + "select * from tops")
def _(d):
    return _tops(d)


@query("agg18_flow_timeline", ["v_flow", "v_flow_threat"], "," + _TOP_SQL + """,
q as (select sip, dip, proto, sport, dport, ipkt, ibyt, min(treceived) as tstart, max(treceived) as tend from v_flow group by 1, 2, 3, 4, 5, 6, 7),
j as (select t.ip_threat, q.*, row_number() over (partition by t.ip_threat order by tstart, tend, sip, dip, proto, sport, dport, ipkt, ibyt) as rn
 from q join (select distinct ip_threat, ip from tops) t on (q.sip = t.ip_threat and q.dip = t.ip) or (q.sip = t.ip and q.dip = t.ip_threat))
select ip_threat, tstart, tend, sip as srcip, dip as dstip, proto, sport, dport, ipkt, ibyt from j where rn <= 1000""")
def _(d):
    return storyboard.timeline(d.view("v_flow"), _tops(d))


_PLACED_SQL = "," + _TOP_SQL + ", ips as (select distinct ip from tops)," + CONTEXT_SQL


@query("agg21_impact", ["v_flow", "v_flow_threat", "v_context"], _PLACED_SQL + """
, c as (select ip_threat, direction, split_part(coalesce(ctx.name, ''), '.', 1) as f from tops left join ctx using (ip))
select ip_threat, direction, case when contains(f, 'VPN') then 'VPN' when contains(f, 'DMZ') then 'DMZ' when contains(f, 'Proxy') then 'Proxy'
 when contains(f, 'FW') then 'FW' else 'DMZ' end as context, count(*) as size from c group by 1, 2, 3""")
def _(d):
    return storyboard.impact(storyboard.with_place(_tops(d), d.view("v_context"), d.view("v_geo")))


@query("agg22_progression", ["v_flow", "v_flow_threat", "v_context"], _PLACED_SQL + "select ip_threat, direction, name, count(*) as impact from tops join ctx using (ip) group by 1, 2, 3")
def _(d):
    return storyboard.progression(storyboard.with_place(_tops(d), d.view("v_context"), d.view("v_geo")))


_URI = "ththre.example.com/fr/825?page=2&ref=x"


def _expanded_all(d):
    return d.view("v_proxy")


@query("agg19_proxy_timeline", ["v_proxy", "v_http_code"], """
, u as (select min(fulluri) as uri from v_proxy), e as (select * from v_proxy, u where fulluri = uri or referer = uri),
c as (select clientip from (select clientip, count(*) as n from e group by 1) t order by n desc, clientip limit 20)
select uri as p_threat, p_date || ' ' || p_time as tstart, p_date || ' ' || p_time as tend, cast(sum(duration) as bigint) as duration, clientip, respcode,
 coalesce(max(h.name), '') as respcode_name from v_proxy join u on fulluri = uri left join v_http_code h on h.k = respcode where clientip in (select clientip from c)
 group by clientip, p_time, respcode, p_date, uri""")
def _(d):
    proxy, uri = d.view("v_proxy"), first_uri(d)
    clients = investigate.top_clients(investigate.proxy_expanded(proxy, uri), 20)
    return investigate.proxy_timeline(proxy, uri, clients, enrich.code_names(d.view("v_http_code"), "k"))


def first_uri(d) -> str:
    """The URI the proxy investigations ask for (the first in text order)."""
    return d.view("v_proxy").agg(F.min("fulluri")).first()[0]


@query("agg20_proxy_counters", ["v_proxy"], """
, u as (select min(fulluri) as uri from v_proxy), e as (select * from v_proxy, u where fulluri = uri or referer = uri),
i as (select 'clientip' as kind, clientip as value from e union all select 'reqmethod', reqmethod from e union all select 'resconttype', resconttype from e
 union all select 'referer', referer from e where fulluri = uri union all select 'referred', fulluri from e where fulluri <> uri)
select kind, value, count(*) as n from i group by 1, 2""")
def _(d):
    uri = first_uri(d)
    return investigate.proxy_counters(investigate.proxy_expanded(d.view("v_proxy"), uri), uri)


@query("agg23_flow_sums", ["v_flow_scores"], "select srcip, dstip, cast(sum(ibyt) as bigint) as ibyt, cast(sum(ipkt) as bigint) as ipkt, count(*) as n from v_flow_scores group by 1, 2")
def _(d):
    return d.view("v_flow_scores").groupBy("srcip", "dstip").agg(F.sum("ibyt").alias("ibyt"), F.sum("ipkt").alias("ipkt"), F.count(F.lit(1)).alias("n"))


@query("agg23_dns_counts", ["v_dns_scores", "v_dns", "v_suffixes"], "," + TLD_SQL + "select ip_dst, tld.tld, count(*) as n from v_dns_scores join tld using (dns_qry_name) group by 1, 2")
def _(d):
    return enrich.with_registered_domain(d.view("v_dns_scores"), d.view("v_suffixes")).groupBy("ip_dst", "tld").agg(F.count(F.lit(1)).alias("n"))


@query("agg23_proxy_counts", ["v_proxy_scores"], "select clientip, host, count(*) as n from v_proxy_scores group by 1, 2")
def _(d):
    return d.view("v_proxy_scores").groupBy("clientip", "host").agg(F.count(F.lit(1)).alias("n"))


@query("agg24_per_month", ["v_flow"], "select substr(treceived, 1, 7) as month, count(*) as total from v_flow group by rollup (substr(treceived, 1, 7))")
def _(d):
    return summaries.per_month(summaries.flow_per_minute(d.view("v_flow")))


@query("agg25_confusion", ["v_labelled", "v_flow"], """
, c as (select cast(count(*) filter (sp = 0 and "Class" <> 'background') as bigint) as tp, cast(count(*) filter (sp = 0 and "Class" = 'background') as bigint) as fp,
 cast(count(*) filter (sp <> 0 and "Class" <> 'background') as bigint) as fn, cast(count(*) filter (sp <> 0 and "Class" = 'background') as bigint) as tn from v_labelled)
select tp, fp, fn, tn, (tp + tn) / cast(tp + fp + fn + tn as double) as accuracy, tp / cast(tp + fp as double) as precision, tp / cast(tp + fn as double) as recall,
 (tp + fn) / cast(tp + fp + fn + tn as double) as contamination from c""")
def _(d):
    return summaries.confusion(d.view("v_labelled"), F.col("sp") == 0, F.col("Class") != "background")


def _internal_scores(d):
    return enrich.with_internal_flags(d.view("v_flow_scores"), d.view("v_internal"), {"srcip": "srcip_internal", "dstip": "dstip_internal"})


@query("agg29_flow_nodes", ["v_flow_scores", "v_internal"], """
, e as (select srcip as ip from v_flow_scores union all select dstip from v_flow_scores),
r as (select cast(split_part(lo_ip, '.', 3) as int) * 256 + cast(split_part(lo_ip, '.', 4) as int) as lo, cast(split_part(hi_ip, '.', 3) as int) * 256 + cast(split_part(hi_ip, '.', 4) as int) as hi from v_internal),
n as (select ip, count(*) as hits, cast(split_part(ip, '.', 3) as int) * 256 + cast(split_part(ip, '.', 4) as int) as k from e group by ip)
select ip, cast(case when exists (select 1 from r where k between lo and hi) then 1 else 0 end as int) as internal, hits from n""")
def _(d):
    return graphs.flow_nodes(_internal_scores(d))


@query("agg29_flow_links", ["v_flow_scores"], "select least(srcip, dstip) as source, greatest(srcip, dstip) as target, round(max(-ln(ml_score)), 9) as score from v_flow_scores group by 1, 2")
def _(d):
    return graphs.flow_links(d.view("v_flow_scores")).withColumn("score", F.round("score", 9))


@query("agg30_dns_nodes", ["v_dns", "v_dns_scores", "v_suffixes"], "," + TLD_SQL + """, e as (select 'tld' as kind, tld.tld as label from v_dns_scores join tld using (dns_qry_name)
 union all select 'ip_dst', ip_dst from v_dns_scores) select kind, label, count(*) as hits from e group by 1, 2""")
def _(d):
    return graphs.dns_nodes(enrich.with_registered_domain(d.view("v_dns_scores"), d.view("v_suffixes")))


@query("agg30_dns_links", ["v_dns", "v_dns_scores", "v_suffixes"], "," + TLD_SQL + """
select tld.tld, ip_dst, count(*) filter (length(dns_qry_name) > 64) > 0 as is_long, round(max(case when length(dns_qry_name) > 64 then 0.0 else -ln(ml_score) end), 9) as score
from v_dns_scores join tld using (dns_qry_name) group by 1, 2""")
def _(d):
    rows = enrich.with_registered_domain(d.view("v_dns_scores"), d.view("v_suffixes"))
    links = graphs.dns_links(rows)
    is_long = F.col("score") == graphs.MAX_DOUBLE
    short = graphs.dns_links(rows.filter(F.length("dns_qry_name") <= graphs.LONG_QUERY)).withColumnRenamed("score", "short")
    both = links.alias("a").join(short.alias("b"), F.expr("a.tld <=> b.tld and a.ip_dst = b.ip_dst"), "left")
    return both.select("a.tld", "a.ip_dst", is_long.alias("is_long"), F.round(F.coalesce("short", F.lit(0.0)), 9).alias("score"))


_PROXY_REP = "case when respcode = '404' then 'gti:High:3::fb:UNKNOWN:-1' when respcode = '302' then 'gti:Minimal:1' else '' end"


@query("agg31_proxy_hierarchy", ["v_proxy_scores"], """
, s as (select *, case respcode when '404' then 3 when '302' then 1 else -1 end as r from v_proxy_scores where host <> '-')
select reqmethod, host, uripath, clientip, cast(4 - (grouping(reqmethod) + grouping(host) + grouping(uripath) + grouping(clientip)) as int) as level, count(*) as hits, cast(max(r) as int) as rep
from s group by rollup (reqmethod, host, uripath, clientip)""")
def _(d):
    return graphs.proxy_hierarchy(d.view("v_proxy_scores").withColumn("uri_rep", F.expr(_PROXY_REP)))


@query("agg32_proxy_client_timeline", ["v_proxy"], """
, t as (select clientip, p_date || ' ' || substr(p_time, 1, 5) as mi, cast(respcode as int) as rc from v_proxy),
c as (select clientip, rc, row_number() over (partition by clientip order by count(*) desc, rc) as rn from t group by 1, 2)
select t.clientip, count(distinct mi) as minutes, max(c.rc) as respcode from t join c on c.clientip = t.clientip and c.rn = 1 group by 1""")
def _(d):
    rows = d.view("v_proxy").select("clientip", F.concat_ws(" ", "p_date", "p_time").alias("tstart"), "respcode")
    return graphs.proxy_client_timeline(rows)


@query("agg33_flow_ip_timeline", ["v_flow", "v_flow_threat"], "," + _TOP_SQL + """,
q as (select sip, dip, proto, sport, dport, ipkt, ibyt, min(treceived) as tstart, max(treceived) as tend from v_flow group by 1, 2, 3, 4, 5, 6, 7),
j as (select t.ip_threat, q.*, row_number() over (partition by t.ip_threat order by tstart, tend, sip, dip, proto, sport, dport, ipkt, ibyt) as rn
 from q join (select distinct ip_threat, ip from tops) t on (q.sip = t.ip_threat and q.dip = t.ip) or (q.sip = t.ip and q.dip = t.ip_threat)),
e as (select ip_threat, sip as ip, sport as port, substr(tstart, 1, 16) as mi from j where rn <= 1000 union all select ip_threat, dip, dport, substr(tstart, 1, 16) from j where rn <= 1000),
k as (select * from e where ip <> ip_threat),
c as (select ip_threat, ip, port, row_number() over (partition by ip_threat, ip order by count(*) desc, port) as rn from k group by 1, 2, 3)
select k.ip_threat, k.ip, count(distinct mi) as minutes, max(c.port) as port from k join c on c.ip_threat = k.ip_threat and c.ip = k.ip and c.rn = 1 group by 1, 2""")
def _(d):
    return graphs.flow_ip_timeline(storyboard.timeline(d.view("v_flow"), _tops(d)))


@query("agg34_client_dendrogram", ["v_dns", "v_dns_scores"], """
, s as (select distinct y, m, d, ip_dst from v_dns_scores where ml_score <= 0.1),
j as (select f.*, row_number() over (partition by y, m, d, ip_dst order by unix_tstamp, dns_qry_name, dns_a) as rn from v_dns f semi join s using (y, m, d, ip_dst)),
a as (select distinct ip_dst, dns_qry_name, unnest(string_split(dns_a, '|')) as answer from j where rn <= 250)
select ip_dst, dns_qry_name, string_agg(answer, ',' order by answer) as answers, count(*) as leaves from a group by 1, 2""")
def _(d):
    return graphs.client_dendrogram(details.dns_dendrogram(d.view("v_dns"), d.view("v_dns_scores").filter("ml_score <= 0.1")))


@query("agg35_request_graph", ["v_proxy"], """
select distinct fulluri as root, 'uri-type' as kind, fulluri as source, resconttype as target from v_proxy
union select fulluri, 'type-method', resconttype, reqmethod from v_proxy union select fulluri, 'method-client', reqmethod, clientip from v_proxy
union select fulluri, 'client-referer', clientip, referer from v_proxy where referer <> '-'""")
def _(d):
    return graphs.request_graph(d.view("v_proxy"))


@query("win1_rank", ["v_flow_scores"], """
, t as (select * from v_flow_scores order by ml_score, tstart, srcip, dstip, sport, dport, proto, ipkt, ibyt limit 500)
select tstart, srcip, dstip, ml_score, cast(row_number() over (order by ml_score, tstart, srcip, dstip, sport, dport, proto, ipkt, ibyt) - 1 as int) as rank from t""")
def _(d):
    top = records.most_suspicious(d.view("v_flow_scores"), 500, "ml_score", investigate.FLOW_KEYS)
    return records.ranked(top, "ml_score", investigate.FLOW_KEYS).select("tstart", "srcip", "dstip", "ml_score", "rank")


@query("win3_first_per_key", ["v_flow"], """
select sip, treceived, dip, sport, dport from (select *, row_number() over (partition by sip order by treceived, dip, sport, dport, ipkt, ibyt) as rn from v_flow) t where rn <= 250""")
def _(d):
    order = [F.col(c) for c in ("treceived", "dip", "sport", "dport", "ipkt", "ibyt")]
    return records.first_per_key(d.view("v_flow"), ["sip"], order, 250).select("sip", "treceived", "dip", "sport", "dport")


@query("win5_first_last_seen", ["v_flow"], "select sip, min(treceived) as firstseen, max(treceived) as lastseen from v_flow group by sip")
def _(d):
    return d.view("v_flow").groupBy("sip").agg(F.min("treceived").alias("firstseen"), F.max("treceived").alias("lastseen"))


@query("topk1_most_suspicious_flow", ["v_flow_scores"], """
select tstart, srcip, dstip, sport, dport, proto, ml_score from v_flow_scores order by ml_score, tstart, srcip, dstip, sport, dport, proto, ipkt, ibyt limit 1000""")
def _(d):
    top = records.most_suspicious(d.view("v_flow_scores"), 1000, "ml_score", investigate.FLOW_KEYS)
    return top.select("tstart", "srcip", "dstip", "sport", "dport", "proto", "ml_score")


@query("topk1_most_suspicious_dns", ["v_dns_scores"], """
select unix_tstamp, ip_dst, dns_qry_name, ml_score from v_dns_scores order by ml_score, unix_tstamp, ip_dst, dns_qry_name, dns_qry_type, dns_qry_rcode, frame_len limit 1000""")
def _(d):
    return records.most_suspicious(d.view("v_dns_scores"), 1000, "ml_score", investigate.DNS_KEYS).select("unix_tstamp", "ip_dst", "dns_qry_name", "ml_score")


@query("topk1_most_suspicious_proxy", ["v_proxy_scores"], """
select tdate, time, clientip, fulluri, ml_score from v_proxy_scores order by ml_score, tdate, time, clientip, fulluri, reqmethod, respcode, referer, duration, scbytes, csbytes limit 1000""")
def _(d):
    return records.most_suspicious(d.view("v_proxy_scores"), 1000, "ml_score", investigate.PROXY_KEYS).select("tdate", "time", "clientip", "fulluri", "ml_score")


@query("topk4_top_clients", ["v_proxy"], "select clientip, count(*) as n from v_proxy group by 1 order by n desc, clientip limit 20")
def _(d):
    return investigate.top_clients(d.view("v_proxy"), 20)


@query("topk5_ordered_requests", ["v_proxy"], "select p_date, p_time, clientip, fulluri from v_proxy order by p_date, p_time")
def _(d):
    return d.view("v_proxy").select("p_date", "p_time", "clientip", "fulluri").orderBy("p_date", "p_time")
