"""Features of the detectors, statistics and quantiles."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from ..functions import flowfeatures as ff
from ..operators import quantiles, transformers
from ..plans import netflow_features as nf
from ..session import cut_lineage, cut_to_files
from .registry import query

_KEYS = ", ".join(nf.KEYS)


def _onehot(proto: str) -> list[str]:
    names = ("UDP", "TCP", "ICMP", "IGMP")
    return [f"cast({proto} = '{n}' as int)" for n in names] + [f"cast({proto} not in {names} as int)"]


def _flags(flag: str) -> list[str]:
    return [f"cast(case when contains({flag}, 'X') then 1 else length({flag}) - length(replace({flag}, '{c}', '')) end as int)" for c in "ASFRPU"]


_CONS = f"""cons as (select {_KEYS}, sum(cast(tdur as float) / cast(1000 as double)) as tdur, sum(cast(ipkt as float)) as ipkt, sum(cast(ibyt as float)) as ibyt,
 sum(cast(opkt as float)) as opkt, sum(cast(obyt as float)) as obyt, count(*) as nconnections from v_flow group by {_KEYS})"""
_PREP = f"""prep as (select {_KEYS}, ln(tdur + 1) as tdur, ln(ipkt + 1) as ipkt, ln(ibyt + 1) as ibyt, opkt, obyt, nconnections,
 {', '.join(f'{e} as proto_onehot{i}' for i, e in enumerate(_onehot('proto')))}, {', '.join(f'{e} as flag_onehot{i}' for i, e in enumerate(_flags('flag')))} from cons)"""


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


_SUMS_SQL = ", ".join(f"round({c}, 6) as {c}" for c in nf.SUMS)


@query("agg5_consolidated_flows", ["v_flow"], f", {_CONS} select {_KEYS}, {_SUMS_SQL}, nconnections from cons")
def _(d):
    return _rounded(nf.consolidate(d.view("v_flow")), *nf.SUMS)


@query("jn6_sums_with_counts", ["v_flow"], f", {_CONS} select sip, dip, treceived, round(ibyt, 6) as ibyt, nconnections from cons")
def _(d):
    return _rounded(nf.consolidate(d.view("v_flow")).select("sip", "dip", "treceived", "ibyt", "nconnections"), "ibyt")


@query("agg6_min_max", ["v_flow"], f""", {_CONS}, {_PREP} select {', '.join(f'round({f}({c}), 6) as {f}_{c}' for c in nf.SCALED for f in ('min', 'max'))} from prep""")
def _(d):
    ends = nf.min_max(nf.preprocess(d.view("v_flow")))
    return ends.select(*[F.round(F.col(c).cast("double"), 6).alias(c) if "nconn" not in c else F.col(c) for c in ends.columns])


@query("agg7_mean_std", ["v_flow"], """
select round(avg(ln(tdur + 1)), 9) as mean_tdur, round(stddev(ln(tdur + 1)), 9) as std_tdur, round(avg(ln(ipkt + 1)), 9) as mean_ipkt, round(stddev(ln(ipkt + 1)), 9) as std_ipkt,
 round(avg(ln(ibyt + 1)), 9) as mean_ibyt, round(stddev(ln(ibyt + 1)), 9) as std_ibyt from v_flow""")
def _(d):
    logs = transformers.LogColumns(inputCols=["tdur", "ipkt", "ibyt"]).transform(d.view("v_flow"))
    return logs.agg(*[F.round(f(f"{c}_log"), 9).alias(f"{n}_{c}") for c in ("tdur", "ipkt", "ibyt") for n, f in (("mean", F.avg), ("std", F.stddev))])


@query("agg8_exact_quantile", ["v_flow"], """
select cast(quantile_disc(ibyt, 0.95) as double) as q95, cast(quantile_disc(ibyt, 0.5) as double) as q50, cast(quantile_disc(ml_score, 0.05) as double) as q05 from v_flow""")
def _(d):
    flow = d.view("v_flow")
    found = quantiles.exact_quantiles(flow, [("ibyt", 0.95), ("ibyt", 0.5), ("ml_score", 0.05)])
    return d.spark.createDataFrame([tuple(found)], "q95 double, q50 double, q05 double")


@query("agg9_percentile", ["v_flow"], """
select (select cast(ibyt as double) from v_flow order by ibyt limit 1 offset (select cast(ceil(count(*) / 100.0e0 * 99 - 1) as bigint) from v_flow)) as p99,
 (select cast(ibyt as double) from v_flow order by ibyt limit 1 offset (select cast(ceil(count(*) / 100.0e0 * 50 - 1) as bigint) from v_flow)) as p50""")
def _(d):
    flow = d.view("v_flow")
    found = tuple(quantiles.exact_quantiles(flow, [("ibyt", 0.99), ("ibyt", 0.5)]))
    return d.spark.createDataFrame([found], "p99 double, p50 double")


@query("fn20_log_transforms", ["v_flow"], "select treceived, sip, round(ln(tdur + 1), 9) as tdur_log, round(ln(ipkt + 1), 9) as ipkt_log, round(ln(ibyt + 1), 9) as ibyt_log from v_flow")
def _(d):
    rows = transformers.LogColumns(inputCols=["tdur", "ipkt", "ibyt"]).transform(d.view("v_flow"))
    return rows.select("treceived", "sip", *[F.round(f"{c}_log", 9).alias(f"{c}_log") for c in ("tdur", "ipkt", "ibyt")])


@query("fn21_protocol_onehot", ["v_flow"], f"select treceived, proto, {', '.join(f'{e} as p{i}' for i, e in enumerate(_onehot('proto')))} from v_flow")
def _(d):
    rows = transformers.ProtocolSlots().transform(d.view("v_flow"))
    return rows.select("treceived", "proto", *[F.get("proto_onehot", F.lit(i)).alias(f"p{i}") for i in range(5)])


@query("fn22_flag_counts", ["v_flow"], f"select treceived, flag, {', '.join(f'{e} as f{i}' for i, e in enumerate(_flags('flag')))} from v_flow")
def _(d):
    rows = transformers.FlagCounts().transform(d.view("v_flow"))
    return rows.select("treceived", "flag", *[F.get("flag_onehot", F.lit(i)).alias(f"f{i}") for i in range(6)])


@query("fn23_high_ports", ["v_flow"], "select treceived, sport, dport, cast(sport > 1024 as int) as sport_high, cast(dport > 1024 as int) as dport_high from v_flow")
def _(d):
    return d.view("v_flow").select("treceived", "sport", "dport", ff.high_port(F.col("sport")).alias("sport_high"), ff.high_port(F.col("dport")).alias("dport_high"))


_SCALED_SQL = ", ".join(
    f"round((cast({c} as double) - min(cast({c} as double)) over ()) / nullif(max(cast({c} as double)) over () - min(cast({c} as double)) over (), 0), 6) as {out}"
    for c, out in nf.SCALED_NAMES.items()
)


@query("fn24_min_max_scaled", ["v_flow"], f", {_CONS}, {_PREP} select treceived, sip, dip, sport, dport, {_SCALED_SQL} from prep")
def _(d):
    rows = cut_lineage(nf.preprocess(d.view("v_flow")))
    scaled = nf.scale(rows, nf.min_max(rows))
    return _rounded(scaled.select("treceived", "sip", "dip", "sport", "dport", *nf.SCALED_NAMES.values()), *nf.SCALED_NAMES.values())


_STD_SQL = """
, s as (select avg(ln(tdur + 1)) as m1, stddev(ln(tdur + 1)) as s1, avg(ln(ipkt + 1)) as m2, stddev(ln(ipkt + 1)) as s2, avg(ln(ibyt + 1)) as m3, stddev(ln(ibyt + 1)) as s3 from v_flow)"""


def _stats(df):
    names = ("tdur_log", "ipkt_log", "ibyt_log")
    row = df.agg(*[f(c).alias(f"{n}_{c}") for c in names for n, f in (("m", F.avg), ("s", F.stddev))]).first()
    return list(names), [row[f"m_{c}"] for c in names], [row[f"s_{c}"] for c in names]


@query("fn25_standardised", ["v_flow"], _STD_SQL + """
select treceived, sip, round((ln(tdur + 1) - m1) / s1, 6) as tdur, round((ln(ipkt + 1) - m2) / s2, 6) as ipkt, round((ln(ibyt + 1) - m3) / s3, 6) as ibyt from v_flow, s""")
def _(d):
    logs = transformers.LogColumns(inputCols=["tdur", "ipkt", "ibyt"]).transform(d.view("v_flow"))
    names, means, stds = _stats(logs)
    rows = transformers.FixedScaler(inputCols=names, means=means, stds=stds).transform(logs)
    return rows.select("treceived", "sip", *[F.round(f"{c}_log_standarized", 6).alias(c) for c in ("tdur", "ipkt", "ibyt")])


def autoencoder_steps(flow):
    """The sixteen features of the autoencoder as a pipeline of transformers."""
    logs = transformers.LogColumns(inputCols=["tdur", "ipkt", "ibyt"])
    names, means, stds = _stats(logs.transform(flow))
    return Pipeline(stages=[
        logs,
        transformers.ProtocolSlots(),
        transformers.FlagCounts(),
        transformers.FixedScaler(inputCols=names, means=means, stds=stds),
        transformers.HighPortFlag(inputCol="sport", outputCol="sport_transform"),
        transformers.HighPortFlag(inputCol="dport", outputCol="dport_transform"),
        transformers.FeatureArray(inputCols=["proto_onehot", "flag_onehot", *[f"{c}_standarized" for c in names], "sport_transform", "dport_transform"]),
    ])


_ORDER = [f"p{i}" for i in range(5)] + [f"f{i}" for i in range(6)] + ["tdur", "ipkt", "ibyt", "sp", "dp"]


@query("fn26_udf3_feature_steps", ["v_flow"], _STD_SQL + f"""
select treceived, sip, {', '.join(f'cast({e} as double) as p{i}' for i, e in enumerate(_onehot('proto')))}, {', '.join(f'cast({e} as double) as f{i}' for i, e in enumerate(_flags('flag')))},
 round((ln(tdur + 1) - m1) / s1, 6) as tdur, round((ln(ipkt + 1) - m2) / s2, 6) as ipkt, round((ln(ibyt + 1) - m3) / s3, 6) as ibyt, cast(sport > 1024 as double) as sp, cast(dport > 1024 as double) as dp from v_flow, s""")
def _(d):
    flow = d.view("v_flow")
    rows = autoencoder_steps(flow).fit(flow).transform(flow)
    return rows.select("treceived", "sip", *[F.round(F.get("features", F.lit(i)), 6).alias(n) for i, n in enumerate(_ORDER)])


@query("udf3_value_and_ratio", ["v_flow"], "select treceived, case when proto = 'ICMP' then 'IGMP' else proto end as proto, round(ibyt / cast(nullif(opkt, 0) as double), 6) as r from v_flow")
def _(d):
    steps = Pipeline(stages=[
        transformers.ValueReplacer(inputCol="proto", outputCol="proto", old="ICMP", new="IGMP"),
        transformers.RatioColumn(inputCols=["ibyt", "opkt"], outputCol="r"),
    ])
    flow = d.view("v_flow")
    return steps.fit(flow).transform(flow).select("treceived", "proto", F.round("r", 6).alias("r"))


@query("fn27_l2_distance", [], """
select vec_id, round(sqrt(list_sum([(cast(x as double) - 0.5e0) * (cast(x as double) - 0.5e0) for x in embedding])), 6) as distance from embeddings""")
def _(d):
    x = F.col("embedding").cast("array<double>")
    return d.table("embeddings").select("vec_id", F.round(ff.l2_distance(x, F.transform(x, lambda v: F.lit(0.5))), 6).alias("distance"))


def detector_features(d):
    """Features of all consolidated flows with their keys; the flows are consolidated once."""
    rows = cut_to_files(nf.preprocess(d.view("v_flow")), "features")
    return nf.feature_array(nf.scale(rows, nf.min_max(rows)))


@query("ml8_feature_table", ["v_flow"], f""", {_CONS}, {_PREP}
select treceived, sip, dip, sport, dport, {', '.join(f'flag_onehot{i}' for i in range(6))}, {', '.join(f'proto_onehot{i}' for i in range(5))}, opkt, obyt, {_SCALED_SQL} from prep""")
def _(d):
    rows = cut_lineage(nf.preprocess(d.view("v_flow")))
    scaled = nf.scale(rows, nf.min_max(rows))
    return _rounded(scaled.select("treceived", "sip", "dip", *nf.FEATURES), *nf.SCALED_NAMES.values())
