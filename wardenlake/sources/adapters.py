"""Log-shaped views over the star-schema test tables.

Each view is a projection written once in the SQL subset that Spark and DuckDB
share; ``view_sql`` gives the text for either engine. Nothing is filtered or
sampled: every row of the base table becomes one record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Text that differs between the engines: name -> (Spark, DuckDB).
_MACROS = {
    "EPOCH": (
        "cast(timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', {x}) as bigint)",
        "cast(floor(epoch({x})) as bigint)",
    ),
}

_P2 = "lpad(cast({0} as string), 2, '0')"


def p2(x: str) -> str:
    return _P2.format(x)


_IP = "concat('{net}.', cast(cast(floor({k} / 256) as bigint) % 256 as string), '.', cast({k} % 256 as string))"


def ip(net: str, key: str) -> str:
    return _IP.format(net=net, k=key)


_VIEWS: dict[str, str] = {}

_VIEWS["v_flow"] = f"""
select concat(day, ' ', {p2('trhour')}, ':', {p2('trminute')}, ':', {p2('trsec')}) as treceived,
       EPOCH(l_shipdate) + trhour * 3600 + trminute * 60 + trsec as unix_tstamp,
       y as tryear, m as trmonth, d as trday, trhour, trminute, trsec, tdur, sip, dip,
       sport, dport, proto, flag, fwd, stos, ipkt, ibyt, opkt, obyt, input, output,
       sas, das, dtos, dir, rip, y, m, d, trhour as h, ml_score
from (
  select l_shipdate,
         concat(cast(year(l_shipdate) as string), '-', {p2('month(l_shipdate)')}, '-', {p2('day(l_shipdate)')}) as day,
         cast(year(l_shipdate) as int) as y, cast(month(l_shipdate) as int) as m, cast(day(l_shipdate) as int) as d,
         cast(l_orderkey % 24 as int) as trhour,
         cast((l_orderkey + 7 * l_linenumber) % 60 as int) as trminute,
         cast(l_partkey % 60 as int) as trsec,
         l_discount * 10 as tdur,
         {ip('10.0', 'l_suppkey')} as sip,
         {ip('10.0', 'l_partkey')} as dip,
         cast(case l_linenumber % 6 when 0 then 0 when 1 then 80 when 2 then 2000 + l_partkey % 5000
              when 3 then 443 when 4 then 3000 + l_orderkey % 5000 else 0 end as int) as sport,
         cast(case (l_orderkey + l_linenumber) % 5 when 0 then 0 when 1 then 443
              when 2 then 5000 + l_suppkey % 100 when 3 then 22 else 8080 end as int) as dport,
         case l_returnflag when 'A' then 'TCP' when 'N' then 'UDP' else 'ICMP' end as proto,
         case when l_linestatus = 'O' and l_linenumber % 7 = 0 then 'XAP.SF'
              when l_linenumber % 4 = 0 then '.A..SF' when l_linenumber % 4 = 1 then '.AP.S.'
              when l_linenumber % 4 = 2 then '...R..' else 'UAPRSF' end as flag,
         cast(0 as int) as fwd, cast(l_linenumber % 3 as int) as stos,
         cast(l_quantity as bigint) as ipkt, cast(floor(l_extendedprice) as bigint) as ibyt,
         cast(round(l_tax * 100) as bigint) as opkt, cast(0 as bigint) as obyt,
         cast(1 as int) as input, cast(2 as int) as output, cast(0 as int) as sas, cast(0 as int) as das,
         cast(0 as int) as dtos, cast(0 as int) as dir, '192.168.1.1' as rip,
         ((l_orderkey * 31 + l_linenumber * 17 + l_partkey * 13) % 997 + 1) / 1000.0e0 as ml_score
  from {{lineitem}}
) t
"""

# The same flows with one defect in some of them (a changed value, no row is left out).
_VIEWS["v_flow_dirty"] = """
select case when k = 1 then null else treceived end as treceived, tryear, trmonth, trday,
       case when k = 2 then cast(24 as int) else trhour end as trhour,
       case when k = 3 then cast(60 as int) when k = 12 then null else trminute end as trminute,
       case when k = 4 then cast(61 as int) else trsec end as trsec, tdur,
       case when k = 5 then null else sip end as sip, case when k = 6 then null else dip end as dip,
       case when k = 7 then null when k = 11 then cast(-1 as int) else sport end as sport,
       case when k = 8 then null else dport end as dport, proto, flag,
       case when k = 9 then null else ipkt end as ipkt, case when k = 10 then null else ibyt end as ibyt,
       case when k = 13 then null else opkt end as opkt, obyt
from (select *, trsec as k from ({v_flow}) f) t
"""

_MONTHS = " ".join(
    f"when {i} then '{name}'"
    for i, name in enumerate("Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split(), start=1)
)

_VIEWS["v_dns"] = f"""
select concat(case mo {_MONTHS} end, '  ', cast(d as string), ' ', cast(y as string), ' ', clock, '.000000000 UTC') as frame_time,
       unix_tstamp, frame_len, {ip('10.1', 'user_id')} as ip_dst,
       concat('10.9.0.', cast(user_id % 4 as string)) as ip_src,
       case (user_id + k) % 9
         when 0 then concat(event_type, '.shop', cast(k % 10 as string), '.com')
         when 1 then concat('www.news', cast(k % 5 as string), '.com.mx')
         when 2 then concat(event_type, cast(k as string), '.amazon.co.uk')
         when 3 then concat(cast(k as string), '.', cast(user_id % 256 as string), '.0.10.in-addr.arpa')
         when 4 then concat('host', cast(k as string), '.lan')
         when 5 then concat(repeat('ab', cast(k % 50 as int)), 'x.', event_type, '.panasonic.jp')
         when 6 then concat('forrealz', cast(k % 3 as string), '.net')
         when 7 then concat(event_type, '.corpnet.org')
         else concat('cdn', cast(k as string), '.news', cast(k % 5 as string), '.com.mx.') end as dns_qry_name,
       case k % 7 when 0 then '0x00000003' when 1 then '0x00000009' else '0x00000001' end as dns_qry_class,
       cast(k % 20 as int) as dns_qry_type, cast(k % 6 as int) as dns_qry_rcode,
       concat({ip('172.16', 'k')}, '|', {ip('172.17', 'user_id')}) as dns_a,
       y, mo as m, d, h,
       ((user_id * 31 + k * 17 + frame_len) % 997 + 1) / 1000.0e0 as ml_score
from (
  select user_id, event_type, EPOCH(ts) as unix_tstamp, cast(floor(value) as int) as frame_len,
         cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k,
         cast(year(ts) as int) as y, cast(month(ts) as int) as mo, cast(day(ts) as int) as d, cast(hour(ts) as int) as h,
         concat({p2('hour(ts)')}, ':', {p2('minute(ts)')}, ':', {p2('cast(floor(second(ts)) as int)')}) as clock
  from {{events}}
) t
"""

_VIEWS["v_dns_dirty"] = """
select case when k = 1 then null when k = 2 then '-' else frame_time end as frame_time,
       case when k = 3 then null when k = 4 then cast(-5 as bigint) else unix_tstamp end as unix_tstamp,
       case when k = 5 then null else frame_len end as frame_len,
       case when k = 6 then '' when k = 7 then null else ip_dst end as ip_dst,
       case when k = 8 then '(empty)' when k = 9 then '-' when k = 10 then null else dns_qry_name end as dns_qry_name,
       case when k = 11 then null when k = 12 then '-' when k = 14 then null else dns_qry_class end as dns_qry_class,
       case when k = 11 then null when k = 13 then null else dns_qry_type end as dns_qry_type,
       case when k = 11 then null when k = 13 then null else dns_qry_rcode end as dns_qry_rcode
from (select *, frame_len % 31 as k from ({v_dns}) f) t
"""

_URL = "regexp_replace(p.url, '^https?://', '')"

_VIEWS["v_proxy"] = f"""
select concat(cast(y as string), '-', {p2('mo')}, '-', {p2('d')}) as p_date,
       clock as p_time, {ip('10.2', 'user_id')} as clientip,
       regexp_extract(uri, '^([^/]+)', 1) as host,
       case event_type when 'view' then 'GET' when 'click' then 'GET' when 'purchase' then 'POST'
            when 'signup' then 'PUT' else 'HEAD' end as reqmethod,
       concat('agent/', cast(user_id % 7 as string)) as useragent,
       case event_type when 'view' then 'text/html' when 'click' then 'image/png' when 'purchase' then 'application/json'
            when 'signup' then 'text/css' else '-' end as resconttype,
       cast(floor(value) as int) as duration, concat('user', cast(user_id as string)) as username,
       case k % 4 when 0 then 'News' when 1 then 'Shopping' when 2 then 'Business' else '-' end as webcat,
       case when k % 3 = 0 then '-' else referer end as referer,
       case k % 5 when 0 then '200' when 1 then '302' when 2 then '404' when 3 then '500' else '599' end as respcode,
       case when k % 2 = 0 then '80' else '443' end as uriport,
       regexp_extract(uri, '^[^/]+([^?#]*)', 1) as uripath,
       regexp_extract(uri, '([?][^#]*)', 1) as uriquery,
       {ip('172.18', 'k')} as serverip,
       cast(floor(value * 100) as int) as scbytes, cast(k * 11 as int) as csbytes, uri as fulluri,
       unix_tstamp, y, mo as m, d, h,
       ((user_id * 31 + k * 17 + event_id * 7) % 997 + 1) / 1000.0e0 as ml_score
from (
  select e.event_id, e.user_id, e.event_type, e.value, EPOCH(e.ts) as unix_tstamp,
         cast(regexp_extract(e.props, '([0-9]+)', 1) as bigint) as k,
         cast(year(e.ts) as int) as y, cast(month(e.ts) as int) as mo, cast(day(e.ts) as int) as d,
         cast(hour(e.ts) as int) as h,
         concat({p2('hour(e.ts)')}, ':', {p2('minute(e.ts)')}, ':', {p2('cast(floor(second(e.ts)) as int)')}) as clock,
         {_URL} as uri, regexp_replace(r.url, '^https?://', '') as referer
  from (select *, event_id % (select count(*) from {{pages}}) as pg,
               (event_id * 7 + 3) % (select count(*) from {{pages}}) as rf from {{events}}) e
  join {{pages}} p on p.page_id = e.pg
  join {{pages}} r on r.page_id = e.rf
) t
"""

_VIEWS["v_proxy_dirty"] = """
select case when k = 1 then null else p_date end as p_date, case when k = 2 then null else p_time end as p_time,
       case when k = 3 then null else clientip end as clientip, case when k = 4 then null else host end as host,
       reqmethod, case when k = 6 then null else useragent end as useragent,
       case when k = 7 then null else resconttype end as resconttype, duration, username, webcat, referer, respcode,
       uriport, uripath, uriquery, serverip, scbytes, csbytes, case when k = 5 then null else fulluri end as fulluri
from (select *, duration % 31 as k from ({v_proxy}) f) t
"""

_VIEWS["v_flow_scores"] = """
select treceived as tstart, sip as srcip, dip as dstip, sport, dport, proto, ipkt, ibyt, opkt, obyt, ml_score, y, m, d
from ({v_flow}) f
"""

_VIEWS["v_dns_scores"] = """
select frame_time, unix_tstamp, frame_len, ip_dst, dns_qry_name, dns_qry_class, dns_qry_type, dns_qry_rcode,
       ml_score, y, m, d, h from ({v_dns}) f
"""

_VIEWS["v_proxy_scores"] = """
select p_date as tdate, p_time as time, clientip, host, reqmethod, useragent, resconttype, duration, username, webcat,
       referer, respcode, uriport, uripath, uriquery, serverip, scbytes, csbytes, fulluri, ml_score, y, m, d, h
from ({v_proxy}) f
"""

# Connections an analyst has scored already; severity 1 is high, 3 is low.
_VIEWS["v_flow_threat"] = f"""
select concat('2001-01-', {p2('s_suppkey % 28 + 1')}, ' 12:00:00') as tstart,
       {ip('10.0', 's_suppkey')} as srcip, {ip('10.0', 's_suppkey * 11 + 3')} as dstip,
       cast(443 as int) as sport, cast(22 as int) as dport, cast(s_suppkey % 3 + 1 as int) as severity,
       cast(2001 as int) as y, cast(1 as int) as m, cast(s_suppkey % 28 + 1 as int) as d
from {{supplier}} where s_acctbal < 2000
"""

_VIEWS["v_dns_threat"] = """
select unix_tstamp, ip_dst, dns_qry_name, cast(frame_len % 3 + 1 as int) as ip_sev, cast(dns_qry_rcode % 3 + 1 as int) as dns_sev, y, m, d
from ({v_dns}) f where dns_qry_type = 4
"""

_VIEWS["v_proxy_threat"] = """
select p_date as tdate, fulluri, cast(duration % 3 + 1 as int) as uri_sev, y, m, d from ({v_proxy}) f
where uriquery <> '' and respcode = '404'
"""

_VIEWS["v_storyboard"] = f"""
select {ip('10.0', 's_suppkey')} as ip_threat, s_name as title, concat(s_name, chr(10), 'seen twice') as text,
       cast(2001 as int) as y, cast(1 as int) as m, cast(s_suppkey % 28 + 1 as int) as d
from {{supplier}}
"""

# Geography by range start, one range per part key; ten columns as in the lookup file.
_VIEWS["v_geo"] = """
select cast(167772160 + p_partkey * 37 as bigint) as range_start, cast(167772160 + p_partkey * 37 + 36 as bigint) as range_end,
       n.n_name as country_code, n.n_name as country, concat('state', cast(p_size as string)) as state, p_brand as city,
       cast(p_size * 1.5e0 as string) as latitude, cast(-p_size * 2.5e0 as string) as longitude, p_name as owner,
       concat(p_type, '.example') as domain
from {part} join {nation} n on n.n_nationkey = p_partkey % 25
"""

# Ranges of the internal network and named network context: CIDR, dash range, single address.
_VIEWS["v_internal"] = """
select concat('10.0.', cast(n_nationkey * 3 as string), '.0') as lo_ip, concat('10.0.', cast(n_nationkey * 3 as string), '.', cast(40 + n_nationkey * 8 as string)) as hi_ip
from {nation}
"""

_VIEWS["v_context"] = """
select concat('10.0.', cast(n_nationkey as string), '.0/24') as range_text,
       concat(case n_regionkey when 0 then 'VPN' when 1 then 'DMZ' when 2 then 'Proxy' when 3 then 'FW' else 'Lab' end, '.', n_name) as name from {nation}
union all
select concat('10.0.', cast(r_regionkey as string), '.16-10.0.', cast(r_regionkey as string), '.90'), concat('FW.', r_name) from {region}
union all
select concat('10.0.', cast(r_regionkey as string), '.', cast(r_regionkey * 9 + 5 as string)), concat('Proxy.', r_name) from {region}
union all
select '10.0.0.0/16', 'VPN.all' from {region} where r_regionkey = 0
"""

_VIEWS["v_client_names"] = f"""
select {ip('10.1', 'c_custkey')} as ip, c_name as name from {{customer}} where c_acctbal > 0
union all
select {ip('10.2', 'c_custkey')} as ip, c_name as name from {{customer}} where c_acctbal > 0
"""

# Reputation feed of two services: numeric scores for the first, a status for the second.
_VIEWS["v_rep_scores"] = f"""
select {ip('10.0', 's_suppkey')} as k, cast(s_suppkey % 70 as int) as score from {{supplier}}
union all
select concat('shop', cast(n_nationkey as string), '.com'), cast(n_nationkey * 3 as int) from {{nation}}
"""

_VIEWS["v_rep_status"] = f"""
select {ip('10.0', 's_suppkey')} as k,
       case s_nationkey % 4 when 0 then 'UNKNOWN' when 1 then 'NON_MALICIOUS' when 2 then 'SUSPICIOUS' else 'MALICIOUS' end as status
from {{supplier}} where s_acctbal > 1000
"""

_VIEWS["v_top_domains"] = """
select cast(r_regionkey + 1 as int) as rank, concat('shop', cast(r_regionkey as string), '.com') as domain from {region}
union all select cast(n_nationkey + 6 as int), concat('news', cast(n_nationkey as string), '.com.mx') from {nation}
union all select cast(r_regionkey + 40 as int), case r_regionkey when 0 then 'amazon.com' when 1 then 'example.com' when 2 then 'co.uk' else 'forrealz1.net' end from {region}
"""

# Feedback of the analysts in the column order of the feedback file.
_VIEWS["v_flow_feedback"] = """
select cast(ibyt % 3 + 1 as int) as sev, treceived as tstart, sip, dip, sport, dport, ipkt, ibyt
from ({v_flow}) f where ml_score < 0.1
"""

_VIEWS["v_dns_feedback"] = """
select *, cast(dns_qry_rcode % 3 + 1 as int) as dns_sev from ({v_dns}) f where ml_score < 0.1
"""

_VIEWS["v_proxy_feedback"] = """
select *, cast(duration % 3 + 1 as int) as uri_sev from ({v_proxy}) f where ml_score < 0.1
"""

# Labelled flows for the classifiers (the label is a rule over ports and protocol).
_VIEWS["v_labelled"] = """
select treceived as tr, tryear, trmonth, trday, trhour, trminute as trmin, trsec, cast(floor(tdur) as int) as td, sip as sa, dip as da,
       sport as sp, dport as dp, proto as pr, cast(ipkt as int) as ipkt, cast(ibyt as int) as ibyt, cast(opkt as int) as opkt, cast(obyt as int) as obyt,
       case when dport = 22 and proto = 'TCP' then 'bruteforce' when sport = 0 and dport = 0 then 'scan'
            when dport >= 5000 and dport < 5100 and ipkt > 25 then 'botnet' else 'background' end as Class
from ({v_flow}) f
"""

# Code names. Keys of the class table come in two spellings.
_VIEWS["v_iana_class"] = """
select * from (values ('0', '0x00000000', 'Reserved'), ('1', '0x00000001', 'Internet (IN)'), ('3', '0x00000003', 'Chaos (CH)'))
 as t(decimal_key, hex_key, name)
"""
_VIEWS["v_iana_type"] = """
select * from (values ('-1', 'UNKNOWN'), ('1', 'a host address'), ('2', 'an authoritative name server'), ('5', 'the canonical name for an alias'),
 ('6', 'marks the start of a zone of authority'), ('12', 'a domain name pointer'), ('15', 'mail exchange'), ('16', 'text strings')) as t(k, name)
"""
_VIEWS["v_iana_rcode"] = """
select * from (values ('-1', 'UNKNOWN'), ('0', 'NoError'), ('1', 'FormErr'), ('2', 'ServFail'), ('3', 'NXDomain')) as t(k, name)
"""
_VIEWS["v_http_code"] = """
select * from (values ('200', 'OK'), ('302', 'Found'), ('404', 'Not Found'), ('500', 'Internal Server Error')) as t(k, name)
"""

_VIEWS["v_suffixes"] = """
select * from (values ('com'), ('net'), ('org'), ('jp'), ('mx'), ('com.mx'), ('uk'), ('co.uk'), ('arpa')) as t(suffix)
"""

VIEW_NAMES = tuple(_VIEWS)


def _fill_macros(text: str, which: int) -> str:
    for name, forms in _MACROS.items():
        while f"{name}(" in text:
            start = text.index(f"{name}(")
            end = text.index(")", start)
            arg = text[start + len(name) + 1:end]
            text = text[:start] + forms[which].format(x=arg) + text[end + 1:]
    return text


def view_sql(name: str, dialect: str) -> str:
    """SQL of a view. ``spark`` keeps {table} marks for the base tables only."""
    text = _fill_macros(_VIEWS[name], 0 if dialect == "spark" else 1)
    for other in VIEW_NAMES:
        mark = "{" + other + "}"
        if mark in text:
            text = text.replace(mark, view_sql(other, dialect))
    if dialect != "spark":
        for table in BASE_TABLES:
            text = text.replace("{" + table + "}", table)
    return text


def duck_ctes(names) -> str:
    """``with`` prefix for an oracle text."""
    return "with " + ",\n".join(f"{n} as ({view_sql(n, 'duckdb')})" for n in names)


# Tables with records; the others are small lookups.
_RECORD_TABLES = ("lineitem", "events", "documents", "embeddings", "orders")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table. A record table whose files give fewer splits than there are cores
    (the single row group of the test files) is spread; a large one is read as it is."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in _RECORD_TABLES and df.rdd.getNumPartitions() < cores:
        df = df.repartition(cores)
    return df


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A log-shaped view as a DataFrame."""
    text = view_sql(name, "spark")
    used = {t: table(spark, sf_dir, t) for t in BASE_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)
