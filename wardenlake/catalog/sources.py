"""Readers and writers, each as a round trip through the shared folder."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from .. import schemas
from ..operators import records, validate
from ..plans import netflow_features as nf
from ..session import work_path
from ..sources import backfill, feedback, files, sinks
from .features import _CONS, _PREP
from .registry import query

_STAGING = [c.split()[0] for c in schemas.FLOW_STAGING.split(", ")]
_FLOW_ALL = ", ".join(_STAGING)


@query("src1_parquet_scan", [], "select l_orderkey, l_partkey, l_quantity from lineitem where l_quantity > 25 and l_returnflag = 'R'")
def _(d):
    rows = files.read_events(d.spark, f"{d.sf_dir}/lineitem.parquet")
    return rows.filter("l_quantity > 25 and l_returnflag = 'R'").select("l_orderkey", "l_partkey", "l_quantity")


@query("src1_absent_path", [], "select l_orderkey, l_quantity from lineitem where false")
def _(d):
    real = files.read_events(d.spark, f"{d.sf_dir}/lineitem.parquet").select("l_orderkey", "l_quantity")
    absent = files.read_events(d.spark, f"{d.sf_dir}/absent.parquet", "l_orderkey bigint, l_quantity double")
    return real.join(absent, ["l_orderkey", "l_quantity"], "left_semi")


@query("src3_detector_scan", [], "select l_returnflag, count(*) as n from lineitem group by 1")
def _(d):
    return files.read_flows(d.spark, f"{d.sf_dir}/lineitem.parquet", "parquet").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("src4_csv_flows", ["v_flow"], "select treceived, sip, dip, sport, dport, proto, flag, ipkt, ibyt from v_flow")
def _(d):
    path = work_path(d.spark, "csv")
    d.view("v_flow").select("treceived", "sip", "dip", "sport", "dport", "proto", "flag", "ipkt", "ibyt").write.csv(path, header=True)
    schema = "treceived string, sip string, dip string, sport int, dport int, proto string, flag string, ipkt bigint, ibyt bigint"
    return files.read_flows(d.spark, path, "csv", schema)


@query("src5_labelled_csv", ["v_labelled"], 'select * from v_labelled')
def _(d):
    path = work_path(d.spark, "labelled")
    d.view("v_labelled").write.csv(path, header=True)
    return files.read_labelled(d.spark, path)


@query("src6_scored_tsv", ["v_labelled", "v_flow"], 'select tr as trtime, tryear, trmonth, trday, trhour, trmin, trsec, cast(td as double) as td, sa, da, sp, dp, pr, cast(ipkt as bigint) as ipkt, cast(ibyt as bigint) as ibyt, cast(opkt as bigint) as opkt, cast(obyt as bigint) as obyt, 0.25e0 as prob from v_labelled')
def _(d):
    path = work_path(d.spark, "scored")
    sinks.write_results(d.view("v_labelled").drop("Class").withColumn("prob", F.lit(0.25)), path)
    return files.read_scored(d.spark, path)


@query("src7_feedback_file", ["v_flow_feedback"], "select * from v_flow_feedback")
def _(d):
    path = work_path(d.spark, "feedback")
    sinks.write_results(d.view("v_flow_feedback"), path, header=True)
    present = feedback.read_feedback(d.spark, path, schemas.FLOW_FEEDBACK)
    return present.unionByName(feedback.read_feedback(d.spark, path + "-absent", schemas.FLOW_FEEDBACK))


def _feedback_file(d, view, schema, name):
    """Write the columns of a feedback file that a view has, read the file back."""
    rows, path = d.view(view), work_path(d.spark, name)
    fields = [c.split() for c in schema.split(", ")]
    have = [F.col(c).cast(kind).alias(c) if c in rows.columns else F.lit(None).cast(kind).alias(c) for c, kind in fields]
    sinks.write_results(rows.select(*have), path, header=True)
    return feedback.read_feedback(d.spark, path, schema)


@query("ml7_dns_feedback_file", ["v_dns_feedback"], f"select {', '.join(schemas.DNS_MODEL)} from v_dns_feedback where dns_sev = 3")
def _(d):
    return feedback.dns_feedback(_feedback_file(d, "v_dns_feedback", schemas.DNS_FEEDBACK, "dns-feedback"))


@query("ml7_proxy_feedback_file", ["v_proxy_feedback"], f"select {', '.join(schemas.PROXY_MODEL)} from v_proxy_feedback where uri_sev = 3")
def _(d):
    return feedback.proxy_feedback(_feedback_file(d, "v_proxy_feedback", schemas.PROXY_FEEDBACK, "proxy-feedback"))


def _flow_text(d, name):
    path = work_path(d.spark, name)
    d.view("v_flow").select(*_STAGING).write.csv(path)
    return path


@query("src8_flow_staging", ["v_flow"], f"select {_FLOW_ALL.replace('tdur', 'cast(tdur as float) as tdur')} from v_flow")
def _(d):
    return files.read_flow_staging(d.spark, _flow_text(d, "flowtext"))


def _dns_text(d, name):
    path = work_path(d.spark, name)
    rows = d.view("v_dns").withColumn("frame_day", F.substring("frame_time", 1, 7))
    rows = rows.withColumn("frame_time", F.expr("substring(frame_time, 8)"))
    cols = [c.split()[0] for c in schemas.DNS_STAGING.split(", ")]
    rows.select(*cols).write.csv(path, ignoreTrailingWhiteSpace=False, ignoreLeadingWhiteSpace=False)
    return path


@query("src9_dns_staging", ["v_dns"], """
select substr(frame_time, 1, 7) as frame_day, substr(frame_time, 8) as frame_time, unix_tstamp, frame_len, ip_src, ip_dst, dns_qry_name, dns_qry_type, dns_qry_class, dns_qry_rcode, dns_a from v_dns""")
def _(d):
    return files.read_dns_staging(d.spark, _dns_text(d, "dnstext"))


@query("src11_code_table", ["v_http_code", "v_proxy"], "select respcode, h.name, count(*) as n from v_proxy left join v_http_code h on h.k = respcode group by 1, 2")
def _(d):
    path = work_path(d.spark, "codes")
    d.view("v_http_code").write.csv(path, header=True)
    names = files.read_codes(d.spark, path, "respcode", "name")
    return d.view("v_proxy").join(names, "respcode", "left").groupBy("respcode", "name").agg(F.count(F.lit(1)).alias("n"))


def _round_trip(d, view, reader, header=False):
    path = work_path(d.spark, view)
    d.view(view).write.csv(path, header=header, quoteAll=True)
    return reader(d.spark, path)


@query("src12_geo_file", ["v_geo"], "select * from v_geo")
def _(d):
    return _round_trip(d, "v_geo", files.read_geo)


@query("src13_context_file", ["v_context"], "select * from v_context")
def _(d):
    return _round_trip(d, "v_context", files.read_context, header=True)


@query("src14_internal_file", ["v_internal"], "select * from v_internal")
def _(d):
    return _round_trip(d, "v_internal", files.read_internal)


@query("src16_first_results", ["v_flow_scores"], """
select tstart, srcip, dstip, ml_score from v_flow_scores order by ml_score, tstart, srcip, dstip, sport, dport, ipkt, ibyt limit 500""")
def _(d):
    keys = ("tstart", "srcip", "dstip", "sport", "dport", "ipkt", "ibyt")
    return files.first_results(d.view("v_flow_scores"), 500, "ml_score", keys).select("tstart", "srcip", "dstip", "ml_score")


@query("snk1_flow_table", ["v_flow"], "select treceived, unix_tstamp, sip, dip, sport, dport, ibyt, y, m, d, h from v_flow")
def _(d):
    path = work_path(d.spark, "flow")
    rows = files.flow_records(files.read_flow_staging(d.spark, _flow_text(d, "snk1")))
    sinks.append_events(rows, path, ("y", "m"))
    return files.read_events(d.spark, path).select("treceived", "unix_tstamp", "sip", "dip", "sport", "dport", "ibyt", "y", "m", "d", "h")


@query("snk2_dns_table", ["v_dns"], "select frame_time, unix_tstamp, ip_dst, dns_qry_name, y, m, d, h from v_dns")
def _(d):
    path = work_path(d.spark, "dns")
    sinks.append_events(files.dns_records(files.read_dns_staging(d.spark, _dns_text(d, "snk2"))), path, ("y", "m", "d"))
    return files.read_events(d.spark, path).select("frame_time", "unix_tstamp", "ip_dst", "dns_qry_name", "y", "m", "d", "h")


@query("src2_partition_pruning", ["v_dns"], "select frame_time, ip_dst, dns_qry_name from v_dns where y = 2024 and m = 1 and d = 9")
def _(d):
    path = work_path(d.spark, "days")
    sinks.append_events(d.view("v_dns"), path, ("y", "m", "d"))
    return records.on_day(files.read_events(d.spark, path), date(2024, 1, 9)).select("frame_time", "ip_dst", "dns_qry_name")


@query("snk4_results_file", ["v_flow"], "select treceived, sip, dip, sport, dport, ml_score as score from v_flow where ml_score <= 0.1")
def _(d):
    path = work_path(d.spark, "results")
    scored = d.view("v_flow").select("treceived", "sip", "dip", "sport", "dport", F.col("ml_score").alias("score"))
    sinks.write_results(validate.scored_below(scored, 0.1), path, delimiter="|")
    return d.spark.read.csv(path, sep="|", schema="treceived string, sip string, dip string, sport int, dport int, score double")


@query("snk6_invalid_records", ["v_proxy_dirty"], "select p_date, p_time, clientip, host, fulluri from v_proxy_dirty where p_date is null or p_time is null or clientip is null or host is null or fulluri is null")
def _(d):
    path = work_path(d.spark, "invalid")
    sinks.write_if_any(validate.invalid_records(d.view("v_proxy_dirty"), "proxy"), path)
    return files.read_events(d.spark, path).select("p_date", "p_time", "clientip", "host", "fulluri")


@query("snk7_corrupt_records", ["v_dns_dirty"], "select unix_tstamp, ip_dst from v_dns_dirty where frame_len is null")
def _(d):
    path = work_path(d.spark, "corrupt")
    scored = d.view("v_dns_dirty").withColumn("score", F.when(F.col("frame_len").isNull(), -1.0).otherwise(0.5))
    sinks.write_if_any(sinks.corrupt_records(scored), path)
    return files.read_events(d.spark, path).select("unix_tstamp", "ip_dst")


@query("snk9_saved_stats", ["v_flow"], f""", {_CONS}, {_PREP} select {', '.join(f'round({f}({c}), 6) as {f}_{c}' for c in nf.LOGGED for f in ('min', 'max'))} from prep""")
def _(d):
    path = work_path(d.spark, "stats")
    nf.save_stats(nf.min_max(nf.preprocess(d.view("v_flow"))), path)
    return nf.load_stats(d.spark, path).select(*[F.round(f"{f}_{c}", 6).alias(f"{f}_{c}") for c in nf.LOGGED for f in ("min", "max")])


@query("snk10_repeated_day", ["v_dns_scores"], "select unix_tstamp, ip_dst, dns_qry_name, y, m, d from v_dns_scores where not (y = 2024 and m = 1 and d = 9)")
def _(d):
    path = work_path(d.spark, "scores")
    rows = d.view("v_dns_scores").select("unix_tstamp", "ip_dst", "dns_qry_name", "y", "m", "d").hint("rebalance", "y", "m", "d")
    sinks.replace_days(rows, path)
    sinks.replace_days(rows.filter("d >= 15"), path)
    sinks.clear_day(d.spark, path, date(2024, 1, 9))
    return files.read_events(d.spark, path)


@query("snk13_legacy_backfill", ["v_flow_threat"], "select srcip, dstip, severity, y, m, d from v_flow_threat where severity > 1")
def _(d):
    root = work_path(d.spark, "legacy")
    rows = d.view("v_flow_threat")
    days = rows.select("y", "m", "d").distinct().collect()
    for day in days:
        part = records.search_equal(rows, y=day.y, m=day.m, d=day.d).select("srcip", "dstip", "severity")
        part.coalesce(1).write.csv(f"{root}/{day.y}{day.m:02d}{day.d:02d}", sep="\t")
    old = backfill.read_days(d.spark, root, "*.csv", "srcip string, dstip string, severity int")
    return backfill.scored_only(old, "severity").filter("severity > 1").select("srcip", "dstip", "severity", "y", "m", "d")
