"""Lookup, range and detail joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import reputation
from ..operators import corpus, details, enrich, indexing, records
from ..operators.ranges import distinct_addresses
from ..plans import investigate, storyboard
from .registry import query
from .words import flow_word_sql


def ip_num_sql(c: str) -> str:
    return (
        f"(cast(split_part({c}, '.', 1) as bigint) * 16777216 + cast(split_part({c}, '.', 2) as bigint) * 65536"
        f" + cast(split_part({c}, '.', 3) as bigint) * 256 + cast(split_part({c}, '.', 4) as bigint))"
    )


# Range texts as numbers, and the narrowest range of each address of a table ``ips``.
CONTEXT_SQL = f"""
cr0 as (select name, range_text, split_part(split_part(range_text, '/', 1), '-', 1) as a,
 case when contains(range_text, '-') then split_part(range_text, '-', 2) else split_part(range_text, '/', 1) end as z from v_context),
cr as (select name, {ip_num_sql('a')} as lo, case when contains(range_text, '/')
 then {ip_num_sql('a')} + cast(pow(2, 32 - cast(split_part(range_text, '/', 2) as int)) as bigint) - 1 else {ip_num_sql('z')} end as hi from cr0),
ctx as (select ip, name from (select i.ip, cr.name, row_number() over (partition by i.ip order by cr.hi - cr.lo, cr.lo, cr.name) as rn
 from ips i join cr on {ip_num_sql('i.ip')} between cr.lo and cr.hi) t where rn = 1)
"""

GEO_SQL = f"""
gips as (select ip, {ip_num_sql('ip')} as ip_num from ips),
geo as (select g.ip, v.state, v.city, v.latitude, v.longitude, v.owner, v.domain, v.state || ';' || v.city || ' ' || v.owner as geo_loc
 from gips g asof join v_geo v on g.ip_num >= v.range_start)
"""

BOTH_IPS = "ips as (select sip as ip from v_flow union select dip from v_flow)"


@query("jn5_document_join", ["v_flow"], flow_word_sql("v_flow").strip() + """
select doc, word, count(*) as count from (select sip as doc, src_word as word from fw union all select dip, dst_word from fw) t group by doc, word""")
def _(d):
    pairs = corpus.flow_corpus(d.view("v_flow"))
    docs = indexing.dense_index(pairs, "doc", "doc_id")
    coded = pairs.join(docs, "doc").select("doc_id", "word", "count")
    return coded.join(docs, "doc_id").select("doc", "word", "count")


@query("win2_dense_index", ["v_flow"], flow_word_sql("v_flow").strip() + """
select count(distinct word) as words, cast(0 as bigint) as low, count(distinct word) - 1 as high, count(distinct word) as numbers
from (select src_word as word from fw union all select dst_word from fw) t""")
def _(d):
    words = indexing.dense_index(corpus.flow_corpus(d.view("v_flow")), "word")
    return words.agg(
        F.count("word").alias("words"), F.min("idx").alias("low"), F.max("idx").alias("high"), F.countDistinct("idx").alias("numbers")
    )


@query("jn8_unscored_flow", ["v_flow_scores", "v_flow_threat"], """
select fs.tstart, fs.srcip, fs.dstip, fs.ml_score from v_flow_scores fs
where not exists (select 1 from v_flow_threat ft where ft.srcip = fs.srcip or ft.dstip = fs.dstip)""")
def _(d):
    return details.without_scored_flow(d.view("v_flow_scores"), d.view("v_flow_threat")).select("tstart", "srcip", "dstip", "ml_score")


@query("jn9_unscored_dns", ["v_dns_scores", "v_dns_threat"], """
select s.unix_tstamp, s.ip_dst, s.dns_qry_name, s.ml_score from v_dns_scores s where not exists (select 1 from v_dns_threat t where t.dns_qry_name = s.dns_qry_name)""")
def _(d):
    return details.without_scored(d.view("v_dns_scores"), d.view("v_dns_threat"), "dns_qry_name").select("unix_tstamp", "ip_dst", "dns_qry_name", "ml_score")


@query("jn10_unscored_proxy", ["v_proxy_scores", "v_proxy_threat"], """
select s.tdate, s.time, s.clientip, s.fulluri, s.ml_score from v_proxy_scores s where not exists (select 1 from v_proxy_threat t where t.fulluri = s.fulluri)""")
def _(d):
    return details.without_scored(d.view("v_proxy_scores"), d.view("v_proxy_threat"), "fulluri").select("tdate", "time", "clientip", "fulluri", "ml_score")


def _suspicious(d, view, top=0.1):
    return d.view(view).filter(F.col("ml_score") <= top)


@query("jn11_flow_edges", ["v_flow", "v_flow_scores"], """
, s as (select distinct srcip, dstip, y, m, d, cast(substr(tstart, 12, 2) as int) as h, cast(substr(tstart, 15, 2) as int) as mi from v_flow_scores where ml_score <= 0.1)
select treceived as tstart, sip as srcip, dip as dstip, sport, dport, proto, flag as flags, stos as tos, ibyt, ipkt, input, output, rip, obyt, opkt,
 h as hh, trminute as mn, y, m, d from v_flow f
where exists (select 1 from s where s.y = f.y and s.m = f.m and s.d = f.d and s.h = f.h and s.mi = f.trminute
 and ((s.srcip = f.sip and s.dstip = f.dip) or (s.srcip = f.dip and s.dstip = f.sip)))""")
def _(d):
    return details.flow_edges(d.view("v_flow"), _suspicious(d, "v_flow_scores"))


_DNS_EDGE_SQL = """
, s as (select distinct y, m, d, h, dns_qry_name as asked from v_dns_scores where ml_score <= 0.1),
j as (select s.asked, f.*, row_number() over (partition by f.y, f.m, f.d, f.h, s.asked order by unix_tstamp, ip_dst, dns_qry_name, frame_len, dns_qry_type,
 dns_qry_rcode, dns_qry_class, dns_a, ip_src) as rn from v_dns f join s on s.y = f.y and s.m = f.m and s.d = f.d and s.h = f.h and contains(f.dns_qry_name, s.asked))
select asked, unix_tstamp, frame_len, ip_dst, ip_src, dns_qry_name, dns_qry_class, dns_qry_type, dns_qry_rcode, dns_a, h as hh, y, m, d from j where rn <= 250"""


@query("jn12_dns_edges", ["v_dns", "v_dns_scores"], _DNS_EDGE_SQL)
def _(d):
    return details.dns_edges(d.view("v_dns"), _suspicious(d, "v_dns_scores"))


@query("jn12_dns_edges_long_list", ["v_dns", "v_dns_scores"], _DNS_EDGE_SQL)
def _(d):
    return details.dns_edges(d.view("v_dns"), _suspicious(d, "v_dns_scores"))


@query("jn13_proxy_edges", ["v_proxy", "v_proxy_scores"], """
, s as (select distinct y, m, d, h, fulluri, clientip from v_proxy_scores where ml_score <= 0.1),
j as (select f.*, row_number() over (partition by f.y, f.m, f.d, f.h, f.fulluri, f.clientip order by p_time, reqmethod, useragent, respcode, referer, scbytes,
 csbytes, webcat, uriport, serverip, resconttype) as rn from v_proxy f join s on s.y = f.y and s.m = f.m and s.d = f.d and s.h = f.h and s.fulluri = f.fulluri and s.clientip = f.clientip)
select p_date as tdate, p_time as time, clientip, host, webcat, respcode, reqmethod, useragent, resconttype, referer, uriport, serverip, scbytes, csbytes, fulluri,
 h as hh, y, m, d from j where rn <= 250""")
def _(d):
    return details.proxy_edges(d.view("v_proxy"), _suspicious(d, "v_proxy_scores"))


PEERS_SQL = """
s as (select srcip, dstip from v_flow_scores where ml_score <= 0.1),
both_sides as (select srcip as ip_threat, dstip as peer from s union all select dstip, srcip from s),
peers as (select ip_threat, count(*) as hits, count(distinct peer) as peers from both_sides group by ip_threat having count(*) > 1 and count(distinct peer) > 1)
"""


@query("jn14_chords", ["v_flow", "v_flow_scores"], "," + PEERS_SQL + """,
pr as (select distinct b.ip_threat, b.peer from both_sides b join peers using (ip_threat))
select pr.ip_threat, f.sip as srcip, f.dip as dstip, cast(sum(f.ibyt) as bigint) as ibyt, cast(sum(f.ipkt) as bigint) as ipkt
from v_flow f join pr on (f.sip = pr.ip_threat and f.dip = pr.peer) or (f.sip = pr.peer and f.dip = pr.ip_threat) group by 1, 2, 3""")
def _(d):
    return details.chords(d.view("v_flow"), _suspicious(d, "v_flow_scores"))


@query("agg27_threat_peers", ["v_flow_scores"], "," + PEERS_SQL + "select ip_threat, cast(hits as bigint) as hits, peers from peers")
def _(d):
    return details.threat_peers(_suspicious(d, "v_flow_scores")).select("ip_threat", "hits", "peers").distinct()


@query("jn15_geo_lookup", ["v_flow", "v_geo"], f", {BOTH_IPS}, {GEO_SQL} select * from geo")
def _(d):
    return enrich.geo_of(distinct_addresses(d.view("v_flow"), "sip", "dip"), d.view("v_geo"))


@query("jn15_flow_geo", ["v_flow", "v_geo"], f""", {BOTH_IPS}, {GEO_SQL}
select f.treceived, f.sip, f.dip, coalesce(a.geo_loc, '') as src_geoloc, coalesce(b.geo_loc, '') as dst_geoloc, coalesce(a.domain, '') as src_domain,
 coalesce(b.domain, '') as dst_domain from v_flow f left join geo a on a.ip = f.sip left join geo b on b.ip = f.dip""")
def _(d):
    rows = d.view("v_flow").select("treceived", "sip", "dip")
    return enrich.with_geo(rows, d.view("v_geo"), {"sip": ("src_geoloc", "src_domain"), "dip": ("dst_geoloc", "dst_domain")})


@query("jn16_internal_flags", ["v_flow", "v_internal"], f"""
, r as (select {ip_num_sql('lo_ip')} as lo, {ip_num_sql('hi_ip')} as hi from v_internal),
ips as (select sip as ip from v_flow union select dip from v_flow),
i as (select ip from ips where exists (select 1 from r where {ip_num_sql('ip')} between r.lo and r.hi))
select treceived, sip, dip, cast(case when sip in (select ip from i) then 1 else 0 end as int) as src_internal, cast(case when dip in (select ip from i) then 1 else 0 end as int) as dst_internal from v_flow""")
def _(d):
    rows = d.view("v_flow").select("treceived", "sip", "dip")
    return enrich.with_internal_flags(rows, d.view("v_internal"), {"sip": "src_internal", "dip": "dst_internal"})


@query("jn17_network_context", ["v_flow", "v_context"], f", {BOTH_IPS}, {CONTEXT_SQL} select f.treceived, f.sip, ctx.name as network_context from v_flow f left join ctx on ctx.ip = f.sip")
def _(d):
    return enrich.with_context(d.view("v_flow").select("treceived", "sip"), d.view("v_context"), "sip")


@query("jn18_client_name", ["v_dns", "v_client_names"], """
select unix_tstamp, ip_dst, coalesce(n.name, '') as network_context from v_dns left join (select ip, min(name) as name from v_client_names group by ip) n on n.ip = ip_dst""")
def _(d):
    return enrich.with_client_name(d.view("v_dns").select("unix_tstamp", "ip_dst"), d.view("v_client_names"), "ip_dst")


@query("jn19_dns_code_names", ["v_dns", "v_iana_class", "v_iana_type", "v_iana_rcode"], """
select unix_tstamp, dns_qry_class, dns_qry_type, dns_qry_rcode, coalesce(c.name, 'Unknown (' || dns_qry_class || ')') as class_name,
 coalesce(t.name, 'Unknown (' || dns_qry_type || ')') as type_name, coalesce(r.name, 'Unknown (' || dns_qry_rcode || ')') as rcode_name
from v_dns left join v_iana_class c on dns_qry_class in (c.decimal_key, c.hex_key) left join v_iana_type t on t.k = cast(dns_qry_type as varchar)
 left join v_iana_rcode r on r.k = cast(dns_qry_rcode as varchar)""")
def _(d):
    rows = d.view("v_dns").select("unix_tstamp", "dns_qry_class", "dns_qry_type", "dns_qry_rcode")
    rows = enrich.with_code_name(rows, enrich.code_names(d.view("v_iana_class"), "decimal_key", "hex_key"), "dns_qry_class", "class_name")
    rows = enrich.with_code_name(rows, enrich.code_names(d.view("v_iana_type"), "k"), "dns_qry_type", "type_name")
    return enrich.with_code_name(rows, enrich.code_names(d.view("v_iana_rcode"), "k"), "dns_qry_rcode", "rcode_name")


@query("jn19_http_code_names", ["v_proxy", "v_http_code"], """
select p_date, p_time, fulluri, respcode, coalesce(c.name, 'Unknown (' || respcode || ')') as respcode_name from v_proxy left join v_http_code c on c.k = respcode""")
def _(d):
    rows = d.view("v_proxy").select("p_date", "p_time", "fulluri", "respcode")
    return enrich.with_code_name(rows, enrich.code_names(d.view("v_http_code"), "k"), "respcode", "respcode_name")


def feeds(d):
    return [
        d.view("v_rep_scores").select("k", reputation.score_label(F.col("score")).alias("label")),
        d.view("v_rep_status").select("k", reputation.status_label(F.col("status")).alias("label")),
    ]


REP_SQL = """
r1 as (select k, max('gti:' || case when score < 15 then 'Minimal:1' when score < 30 then 'Unverified:-1' when score < 50 then 'Medium:2' else 'High:3' end) as label from v_rep_scores group by k),
r2 as (select k, max('fb:' || status || ':' || case status when 'NON_MALICIOUS' then '0' when 'SUSPICIOUS' then '2' when 'MALICIOUS' then '3' else '-1' end) as label from v_rep_status group by k),
rep as (select coalesce(r1.k, r2.k) as k, concat_ws('::', r1.label, r2.label) as rep from r1 full join r2 on r1.k = r2.k)
"""


@query("jn20_reputation", ["v_flow", "v_rep_scores", "v_rep_status"], "," + REP_SQL + """
select treceived, sip, dip, coalesce(a.rep, '') as src_rep, coalesce(b.rep, '') as dst_rep from v_flow left join rep a on a.k = sip left join rep b on b.k = dip""")
def _(d):
    rows = d.view("v_flow").select("treceived", "sip", "dip")
    both = feeds(d)
    return enrich.with_reputation(enrich.with_reputation(rows, "sip", both, "src_rep"), "dip", both, "dst_rep")


ANCHORS_SQL = "anchors as (select distinct ip as ip_threat from (select srcip as ip from v_flow_threat where severity = 1 union all select dstip from v_flow_threat where severity = 1) t)"


def anchors(d):
    return records.high_risk_addresses(d.view("v_flow_threat")).withColumnRenamed("ip", "ip_threat")


TLD_SQL = """
nm as (select distinct dns_qry_name, string_split(rtrim(dns_qry_name, '.'), '.') as l from v_dns),
tails as (select dns_qry_name, l, i, array_to_string(l[i:len(l)], '.') as tail from nm, lateral (select unnest(range(1, len(l) + 1)) as i) u),
hit as (select dns_qry_name, l, min(i) as i from tails join v_suffixes on suffix = tail group by 1, 2),
tld as (select nm.dns_qry_name, case when hit.i > 1 then array_to_string(nm.l[hit.i - 1:len(nm.l)], '.') end as tld from nm left join hit using (dns_qry_name))
"""


@query("fn18_registered_domain", ["v_dns", "v_suffixes"], "," + TLD_SQL + "select v_dns.unix_tstamp, v_dns.dns_qry_name, tld.tld from v_dns join tld using (dns_qry_name)")
def _(d):
    return enrich.with_registered_domain(d.view("v_dns").select("unix_tstamp", "dns_qry_name"), d.view("v_suffixes")).select("unix_tstamp", "dns_qry_name", "tld")


@query("jn21_timeline_flows", ["v_flow", "v_flow_threat"], f""", {ANCHORS_SQL},
x as (select distinct a.ip_threat, case when f.sip = a.ip_threat then f.dip else f.sip end as peer from v_flow f join anchors a on f.sip = a.ip_threat or f.dip = a.ip_threat where f.dport = 22),
g as (select sip, dip, proto, sport, dport, ipkt, ibyt, min(treceived) as tstart, max(treceived) as tend from v_flow group by 1, 2, 3, 4, 5, 6, 7),
j as (select x.ip_threat, g.*, row_number() over (partition by x.ip_threat order by tstart, tend, sip, dip, proto, sport, dport, ipkt, ibyt) as rn
 from g join x on (g.sip = x.ip_threat and g.dip = x.peer) or (g.sip = x.peer and g.dip = x.ip_threat))
select ip_threat, tstart, tend, sip as srcip, dip as dstip, proto, sport, dport, ipkt, ibyt from j where rn <= 1000""")
def _(d):
    flow = d.view("v_flow")
    ssh = storyboard.expanded_search_all(flow.filter("dport = 22"), anchors(d))
    peers = ssh.select("ip_threat", F.when(F.col("srcip") == F.col("ip_threat"), F.col("dstip")).otherwise(F.col("srcip")).alias("peer")).distinct()
    return details.flow_timeline(flow, peers)


@query("jn22_legacy_code_names", ["v_proxy_scores", "v_http_code"], """
select s.tdate, s.time, s.fulluri, s.respcode, coalesce(c.name, '') as respcode_name from v_proxy_scores s left join v_http_code c on c.k = s.respcode""")
def _(d):
    rows = d.view("v_proxy_scores").select("tdate", "time", "fulluri", "respcode")
    names = enrich.code_names(d.view("v_http_code"), "k").select(F.col("k").alias("respcode"), F.col("name").alias("respcode_name"))
    return rows.join(names, "respcode", "left").withColumn("respcode_name", F.coalesce("respcode_name", F.lit("")))


@query("snk12_upsert_comments", ["v_storyboard", "v_flow_threat"], """
, n as (select srcip as ip_threat, max('severity ' || severity) as title, 'new text' as text, max(y) as y, max(m) as m, max(d) as d from v_flow_threat group by srcip)
select * from n union all select * from v_storyboard where ip_threat not in (select ip_threat from n)""")
def _(d):
    new = d.view("v_flow_threat").groupBy(F.col("srcip").alias("ip_threat")).agg(
        F.max(F.concat(F.lit("severity "), F.col("severity").cast("string"))).alias("title"), F.lit("new text").alias("text"),
        F.max("y").alias("y"), F.max("m").alias("m"), F.max("d").alias("d"),
    )
    return investigate.upsert(d.view("v_storyboard"), new, "ip_threat")
