"""Scalar functions, behaviour words and corpora."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..functions import addresses, domains, numeric, reputation, texts, timestamps
from ..operators import corpus, validate
from .registry import query

_TLDS = "('com', 'org', 'net', 'int', 'edu', 'gov', 'mil')"


def entropy_sql(s: str) -> str:
    p = f"((length({s}) - length(replace({s}, x, ''))) / cast(length({s}) as double))"
    return (
        f"(case when length({s}) = 0 then 0.0e0 else round(list_sum([-{p} * log10({p}) / log10(2.0e0)"
        f" for x in list_sort(list_distinct(string_split({s}, '')))]), 12) end)"
    )


def bin_sql(e: str) -> str:
    cuts = " ".join(f"when {e} <= {c!r}e0 then {i}" for i, c in enumerate(numeric.ENTROPY_CUTS[:-1]))
    return f"(case {cuts} else {len(numeric.ENTROPY_CUTS) - 1} end)"


def log2_sql(x: str) -> str:
    return f"(case when {x} <= 0 then 0 else cast(trunc(log10(cast({x} as double)) / log10(2.0e0)) as int) end)"


def ceil2_sql(x: str) -> str:
    return f"cast(ceil(log10(cast({x} as double)) / log10(2.0e0)) as int)"


def domain_sql(src: str, name: str) -> str:
    """Chain of table expressions that ends in ``parts`` (domain, subdomain, n labels, in_top)."""
    return f""",
p1 as (select *, string_split(rtrim({name}, '.'), '.') as l from {src}),
p2 as (select *, len(l) as n, regexp_full_match(l[-1], '[a-z][a-z]|krd') and not regexp_full_match(l[-1], 'aa|q[m-z]|x[a-z]|zz') as cc from p1),
p3 as (select *, case when cc then l[1:n - 1] else l end as l1,
 n >= 2 and not (n > 2 and l[-1] = 'arpa' and l[-2] = 'in-addr') and (cc or l[-1] in {_TLDS}) as known from p2),
p4 as (select *, case when len(l1) > 0 and l1[-1] in {_TLDS} then l1[1:len(l1) - 1] else l1 end as l2 from p3),
p5 as (select *, case when known and len(l2) > 0 then l2[-1] else 'None' end as domain,
 case when known and len(l2) > 1 then array_to_string(l2[1:len(l2) - 1], '.') else 'None' end as subdomain from p4),
parts as (select p5.*, t.domain is not null as in_top from p5
 left join (select distinct split_part(domain, '.', 1) as domain from v_top_domains) t on t.domain = p5.domain)
"""


_INFO = f"""
info as (select *, case when domain = 'corpnet' then 2 when in_top then 1 else 0 end as top_domain,
 case when subdomain <> 'None' then length(subdomain) else 0 end as subdomain_length,
 case when subdomain <> 'None' then {entropy_sql('subdomain')} else 0.0e0 end as subdomain_entropy from parts)
"""

_FLOW_WORD = f"""
fw0 as (select *, case when sport = 0 and dport = 0 then 0 when dport = 0 then sport when sport = 0 then dport
 when sport <= 1024 and dport <= 1024 then 111111 when sport <= 1024 then sport when dport <= 1024 then dport else 333333 end as service,
 (dport = 0 and sport > 0) or (sport > 0 and sport <= 1024 and dport > 1024) as src_owns,
 (sport = 0 and dport > 0) or (dport > 0 and dport <= 1024 and sport > 1024) as dst_owns from SRC),
fw1 as (select *, concat_ws('_', service, proto, trhour, {ceil2_sql('ibyt + 1')}, {ceil2_sql('ipkt + 1')}) as base from fw0),
fw as (select *, case when src_owns then '-1_' || base else base end as src_word, case when dst_owns then '-1_' || base else base end as dst_word from fw1)
"""


def flow_word_sql(src: str) -> str:
    return "," + _FLOW_WORD.replace("SRC", src)


def dns_word_sql(src: str = "v_dns") -> str:
    return domain_sql(src, "dns_qry_name") + "," + _INFO + f""",
dw as (select *, concat_ws('_', top_domain, {log2_sql('frame_len')}, cast(split_part(regexp_split_to_array(frame_time, ' +')[4], ':', 1) as int),
 {log2_sql('subdomain_length')}, {bin_sql('subdomain_entropy')}, {log2_sql('n')}, dns_qry_type, dns_qry_rcode) as word from info)
"""


def proxy_word_sql(src: str = "v_proxy") -> str:
    return domain_sql(src, "host") + f""",
ac as (select useragent, count(*) as agent_count from {src} group by useragent),
pw as (select p.*, concat_ws('_', case when domain = 'corpnet' then 2 when in_top then 1 else 0 end, cast(split_part(p_time, ':', 1) as int), reqmethod,
 {bin_sql(entropy_sql('fulluri'))}, split_part(resconttype, '/', 1), {log2_sql('agent_count')}, {log2_sql('length(fulluri)')},
 coalesce(respcode, 'unknown_response_code')) as word from parts p join ac using (useragent))
"""


@query("fn1_log_base", ["v_flow"], f"select ibyt, ipkt, {log2_sql('ibyt')} as b2, case when ipkt <= 0 then 0 else cast(trunc(log10(cast(ipkt as double)) / log10(3.0e0)) as int) end as b3 from v_flow")
def _(d):
    return d.view("v_flow").select("ibyt", "ipkt", numeric.log_base_int(F.col("ibyt"), 2).alias("b2"), numeric.log_base_int(F.col("ipkt"), 3).alias("b3"))


@query("fn2_ceil_log2", ["v_flow"], f"select ibyt, {ceil2_sql('ibyt + 1')} as b from v_flow")
def _(d):
    return d.view("v_flow").select("ibyt", numeric.ceil_log2(F.col("ibyt") + 1).alias("b"))


@query("fn3_fn4_entropy_bin", ["v_flow"], f"select tdur, {bin_sql('tdur')} as b from v_flow")
def _(d):
    return d.view("v_flow").select("tdur", numeric.bin_index(F.col("tdur")).alias("b"))


@query("fn5_entropy_names", ["v_dns"], f"select dns_qry_name, round({entropy_sql('dns_qry_name')}, 9) as entropy from v_dns")
def _(d):
    return d.view("v_dns").select("dns_qry_name", F.round(numeric.shannon_entropy(F.col("dns_qry_name")), 9).alias("entropy"))


@query("fn5_entropy_documents", [], f"select doc_id, round({entropy_sql('text')}, 6) as entropy from documents")
def _(d):
    return d.table("documents").select("doc_id", F.round(numeric.shannon_entropy(F.col("text")), 6).alias("entropy"))


@query("fn6_time_of_day", ["v_proxy"], """
select p_time, cast(split_part(p_time, ':', 1) as int) as hour, cast(split_part(p_time, ':', 1) as int) * 3600.0e0
 + cast(split_part(p_time, ':', 2) as int) * 60 + cast(split_part(p_time, ':', 3) as int) as seconds from v_proxy""")
def _(d):
    t = F.col("p_time")
    return d.view("v_proxy").select("p_time", timestamps.hour_of(t).alias("hour"), timestamps.seconds_of_day(t).alias("seconds"))


@query("fn7_domain_parts", ["v_dns", "v_top_domains"], "WITHOUT")
def _(d):
    rows = d.view("v_dns").select("dns_qry_name", domains.domain_parts(F.col("dns_qry_name")).alias("p"))
    return rows.select("dns_qry_name", "p.domain", "p.subdomain")


@query("fn7_host_domains", ["v_proxy", "v_top_domains"], "WITHOUT")
def _(d):
    rows = d.view("v_proxy").select("host", domains.domain_parts(F.col("host")).alias("p"))
    return rows.select("host", "p.domain", "p.subdomain")


@query("fn8_domain_info", ["v_dns", "v_top_domains"], "WITHOUT")
def _(d):
    rows = corpus.with_domain_info(d.view("v_dns").select("dns_qry_name"), d.view("v_top_domains"), "corpnet")
    return rows.select(
        "dns_qry_name", "info.domain", "info.top_domain", "info.subdomain", "info.subdomain_length",
        F.round("info.subdomain_entropy", 9).alias("subdomain_entropy"), "info.num_periods",
    )


@query("fn9_host_class", ["v_proxy", "v_top_domains"], "WITHOUT")
def _(d):
    return corpus.with_host_class(d.view("v_proxy").select("host", "fulluri"), d.view("v_top_domains"), ("corpnet",)).select("host", "fulluri", "host_class")


@query("fn10_flow_words", ["v_flow"], "WITHOUT")
def _(d):
    return corpus.with_flow_words(d.view("v_flow")).select("treceived", "sip", "dip", "src_word", "dst_word")


@query("fn11_dns_words", ["v_dns", "v_top_domains"], "WITHOUT")
def _(d):
    return corpus.with_dns_word(d.view("v_dns"), d.view("v_top_domains"), "corpnet").select("unix_tstamp", "ip_dst", "dns_qry_name", "word")


@query("fn12_proxy_words", ["v_proxy", "v_top_domains"], "WITHOUT")
def _(d):
    rows = d.view("v_proxy")
    return corpus.with_proxy_word(rows, d.view("v_top_domains"), corpus.agent_counts(rows)).select("p_date", "p_time", "clientip", "fulluri", "word")


@query("agg1_flow_corpus", ["v_flow"], "WITHOUT")
def _(d):
    return corpus.flow_corpus(validate.clean_flow(d.view("v_flow")))


@query("set3_source_destination_union", ["v_flow"], "WITHOUT")
def _(d):
    words = corpus.with_flow_words(d.view("v_flow"))
    both = words.select(F.col("sip").alias("doc"), F.col("src_word").alias("word")).unionAll(words.select("dip", "dst_word"))
    return both.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("agg2_dns_corpus", ["v_dns", "v_top_domains"], "WITHOUT")
def _(d):
    return corpus.client_corpus(corpus.with_dns_word(d.view("v_dns"), d.view("v_top_domains"), "corpnet"), "ip_dst")


@query("agg2_proxy_corpus", ["v_proxy", "v_top_domains"], "WITHOUT")
def _(d):
    rows = d.view("v_proxy")
    return corpus.client_corpus(corpus.with_proxy_word(rows, d.view("v_top_domains"), corpus.agent_counts(rows)), "clientip")


@query("agg3_agent_counts", ["v_proxy"], "select useragent, count(*) as agent_count from v_proxy group by useragent")
def _(d):
    return corpus.agent_counts(d.view("v_proxy"))


@query("agg28_corpus_size", ["v_flow"], "WITHOUT")
def _(d):
    return corpus.corpus_size(corpus.flow_corpus(d.view("v_flow")))


@query("flt13_word_errors", ["v_dns_dirty", "v_top_domains"], "WITHOUT")
def _(d):
    return corpus.drop_word_errors(corpus.with_dns_word(d.view("v_dns_dirty"), d.view("v_top_domains"), "corpnet")).select("frame_time", "dns_qry_name", "word")


@query("fn14_range_bounds", ["v_context"], """
, b as (select range_text, name, case when contains(range_text, '/') then split_part(range_text, '/', 1)
 when contains(range_text, '-') then split_part(range_text, '-', 1) else range_text end as a,
 case when contains(range_text, '-') then split_part(range_text, '-', 2) else range_text end as z from v_context),
n as (select *, cast(split_part(a, '.', 1) as bigint) * 16777216 + cast(split_part(a, '.', 2) as bigint) * 65536 + cast(split_part(a, '.', 3) as bigint) * 256 + cast(split_part(a, '.', 4) as bigint) as lo,
 case when not contains(range_text, '/') then cast(split_part(z, '.', 1) as bigint) * 16777216 + cast(split_part(z, '.', 2) as bigint) * 65536 + cast(split_part(z, '.', 3) as bigint) * 256 + cast(split_part(z, '.', 4) as bigint) end as hi0 from b)
select range_text, name, lo, case when contains(range_text, '/') then lo + cast(pow(2, 32 - cast(split_part(range_text, '/', 2) as int)) as bigint) - 1 else hi0 end as hi from n""")
def _(d):
    return d.view("v_context").select("range_text", "name", addresses.range_bounds(F.col("range_text")).alias("r")).select("range_text", "name", "r.lo", "r.hi")


_CATEGORY = "case when contains(name, 'VPN') then 'VPN' when contains(name, 'DMZ') then 'DMZ' when contains(name, 'Proxy') then 'Proxy' when contains(name, 'FW') then 'FW' else 'DMZ' end"


@query("fn15_context_category", ["v_context"], f"select name, {_CATEGORY} as category from v_context")
def _(d):
    return d.view("v_context").select("name", addresses.context_category(F.col("name")).alias("category"))


@query("fn16_reputation_label", ["v_rep_scores"], """
select k, score, case when score < 15 then 'gti:Minimal:1' when score < 30 then 'gti:Unverified:-1' when score < 50 then 'gti:Medium:2' else 'gti:High:3' end
 || case when score % 2 = 0 then ':Spam|Risk;Phish|Security' else '' end as label from v_rep_scores""")
def _(d):
    cats = F.when(F.col("score") % 2 == 0, F.array(F.lit("Spam|Risk"), F.lit("Phish|Security")))
    label = reputation.with_categories(reputation.score_label(F.col("score")), cats)
    return d.view("v_rep_scores").select("k", "score", label.alias("label"))


@query("fn17_status_label", ["v_rep_status"], """
select k, 'fb:' || status || ':' || case status when 'NON_MALICIOUS' then '0' when 'SUSPICIOUS' then '2' when 'MALICIOUS' then '3' else '-1' end as label from v_rep_status""")
def _(d):
    return d.view("v_rep_status").select("k", reputation.status_label(F.col("status")).alias("label"))


@query("fn19_frame_hour", ["v_dns"], "select frame_time, split_part(regexp_split_to_array(frame_time, ' +')[4], ':', 1) as hh from v_dns")
def _(d):
    clock = timestamps.frame_clock(F.col("frame_time"))
    return d.view("v_dns").select("frame_time", F.get(F.split(clock, ":"), F.lit(0)).alias("hh"))


@query("fn33_unix_text", ["v_flow"], """
select unix_tstamp, strftime(make_timestamp(unix_tstamp * 1000000), '%Y-%m-%d %H:%M:%S') as text, cast(epoch(cast(treceived as timestamp)) as bigint) as back from v_flow""")
def _(d):
    return d.view("v_flow").select(
        "unix_tstamp", timestamps.unix_to_text(F.col("unix_tstamp")).alias("text"), timestamps.text_to_unix(F.col("treceived")).alias("back")
    )


@query("fn34_request_key", ["v_proxy"], "select clientip, fulluri, md5(clientip || fulluri) || split_part(p_time, ':', 1) as hash from v_proxy")
def _(d):
    return d.view("v_proxy").select("clientip", "fulluri", texts.request_key(F.col("clientip"), F.col("fulluri"), F.col("p_time")).alias("hash"))


@query("fn35_minute_key", ["v_flow"], "select treceived, substr(treceived, 1, 16) as minute from v_flow")
def _(d):
    day = timestamps.day_text(F.col("y"), F.col("m"), F.col("d"))
    return d.view("v_flow").select("treceived", timestamps.minute_key(day, F.col("trhour"), F.col("trminute")).alias("minute"))


@query("fn40_escape_newlines", ["v_storyboard"], "select ip_threat, title, replace(text, chr(10), '\\n') as text from v_storyboard")
def _(d):
    return d.view("v_storyboard").select("ip_threat", "title", texts.escaped_newlines(F.col("text")).alias("text"))


@query("fn41_highest_reputation", ["v_rep_scores", "v_rep_status"], """
, l as (select s.k, s.score, t.status from v_rep_scores s left join (select k, min(status) as status from v_rep_status group by k) t using (k)),
v as (select k, case when score < 15 then 1 when score < 30 then -1 when score < 50 then 2 else 3 end as a,
 case status when 'NON_MALICIOUS' then 0 when 'SUSPICIOUS' then 2 when 'MALICIOUS' then 3 when 'UNKNOWN' then -1 end as b from l)
select k, greatest(a, coalesce(b, -1), -1) as highest from v""")
def _(d):
    first = d.view("v_rep_scores").select("k", reputation.score_label(F.col("score")).alias("a"))
    second = d.view("v_rep_status").groupBy("k").agg(F.min(reputation.status_label(F.col("status"))).alias("b"))
    text = F.concat_ws("::", "a", "b")
    return first.join(second, "k", "left").select("k", reputation.highest_reputation(text).alias("highest"))


@query("fn42_answers", ["v_dns"], "select unix_tstamp, dns_qry_name, unnest(string_split(dns_a, '|')) as answer from v_dns")
def _(d):
    return d.view("v_dns").select("unix_tstamp", "dns_qry_name", F.explode(F.split("dns_a", r"\|")).alias("answer"))


@query("fn43_minute_to_time", ["v_flow_dirty"], """
select substr(treceived, 1, 16) as minute, cast(epoch(try_cast(substr(treceived, 1, 16) || ':00' as timestamp)) as bigint) as unix,
 coalesce(ipkt, 0) as ipkt, coalesce(ibyt, 0) as ibyt from v_flow_dirty""")
def _(d):
    minute = F.substring("treceived", 1, 16)
    return d.view("v_flow_dirty").select(
        minute.alias("minute"), F.unix_seconds(timestamps.minute_to_timestamp(minute)).alias("unix"),
        F.coalesce("ipkt", F.lit(0)).alias("ipkt"), F.coalesce("ibyt", F.lit(0)).alias("ibyt"),
    )


# SQL texts that build on the chains above.
_CHAINED = {
    "fn7_domain_parts": domain_sql("v_dns", "dns_qry_name") + "select dns_qry_name, domain, subdomain from parts",
    "fn7_host_domains": domain_sql("v_proxy", "host") + "select host, domain, subdomain from parts",
    "fn8_domain_info": domain_sql("v_dns", "dns_qry_name") + "," + _INFO
    + "select dns_qry_name, domain, top_domain, subdomain, cast(subdomain_length as int) as subdomain_length, round(subdomain_entropy, 9) as subdomain_entropy, cast(n as int) as num_periods from info",
    "fn9_host_class": domain_sql("v_proxy", "host") + "select host, fulluri, case when domain = 'corpnet' then 2 when in_top then 1 else 0 end as host_class from parts",
    "fn10_flow_words": flow_word_sql("v_flow") + "select treceived, sip, dip, src_word, dst_word from fw",
    "fn11_dns_words": dns_word_sql() + "select unix_tstamp, ip_dst, dns_qry_name, word from dw",
    "fn12_proxy_words": proxy_word_sql() + "select p_date, p_time, clientip, fulluri, word from pw",
    "agg1_flow_corpus": flow_word_sql("v_flow")
    + "select doc, word, count(*) as count from (select sip as doc, src_word as word from fw union all select dip, dst_word from fw) t group by doc, word",
    "set3_source_destination_union": flow_word_sql("v_flow")
    + "select word, count(*) as n from (select sip as doc, src_word as word from fw union all select dip, dst_word from fw) t group by word",
    "agg2_dns_corpus": dns_word_sql() + "select ip_dst as doc, word, count(*) as count from dw group by ip_dst, word",
    "agg2_proxy_corpus": proxy_word_sql() + "select clientip as doc, word, count(*) as count from pw group by clientip, word",
    "agg28_corpus_size": flow_word_sql("v_flow")
    + "select count(distinct doc) as documents, count(distinct word) as words, count(*) as tokens from (select sip as doc, src_word as word from fw union all select dip, dst_word from fw) t",
    "flt13_word_errors": """, ok as (select * from v_dns_dirty where frame_time is not null and frame_time <> '-' and frame_len is not null
 and dns_qry_name is not null and dns_qry_type is not null and dns_qry_rcode is not null)""" + dns_word_sql("ok") + "select frame_time, dns_qry_name, word from dw",
}


def _finish() -> None:
    from . import registry

    for name, body in _CHAINED.items():
        registry._ORACLE[name] = registry._ORACLE[name].replace("WITHOUT", body.strip())


_finish()


@query("flt9_proxy_out_columns", ["v_proxy", "v_top_domains"], proxy_word_sql("v_proxy") + f"select {', '.join(schemas.PROXY_IN)}, word, ml_score as score from pw")
def _(d):
    rows = d.view("v_proxy")
    words = corpus.with_proxy_word(rows, d.view("v_top_domains"), corpus.agent_counts(rows), ("corpnet",))
    return words.withColumnRenamed("ml_score", "score").select(*schemas.PROXY_OUT)
