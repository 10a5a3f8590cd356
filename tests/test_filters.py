import pytest

from wardenlake import schemas
from wardenlake.operators import validate

FLOW = "treceived string, tryear int, trmonth int, trday int, trhour int, trminute int, trsec int, tdur double, sip string, dip string, sport int, dport int, proto string, ipkt bigint, ibyt bigint, opkt bigint, obyt bigint"
GOOD = dict(treceived="2016-05-05 13:54:58", tryear=2016, trmonth=5, trday=5, trhour=13, trminute=54, trsec=58, tdur=0.97, sip="172.16.0.129", dip="10.0.2.202", sport=1024, dport=80, proto="TCP", ipkt=39, ibyt=12522, opkt=0, obyt=0)


def flows(spark, *changes):
    return spark.createDataFrame([tuple({**GOOD, **c}.values()) for c in changes], FLOW)


def test_flow_filters(spark):
    defects = [dict(trhour=24), dict(trsec=60), dict(trminute=60)] + [{c: None} for c in ("treceived", "sip", "dip", "sport", "dport", "ipkt", "ibyt")]
    fine = [{}, {}, {}, dict(opkt=None), dict(obyt=None)]
    df = flows(spark, *defects, *fine)
    assert validate.clean_flow(df).count() == 5
    assert validate.invalid_flow(df).count() == 10
    assert validate.invalid_flow(df, strict_reference=True).count() == 7


DNS = "frame_time string, unix_tstamp bigint, frame_len int, ip_dst string, dns_qry_name string, dns_qry_class string, dns_qry_type int, dns_qry_rcode int"
DNS_GOOD = dict(frame_time="May 20 2016 02:10:25", unix_tstamp=1463735425, frame_len=168, ip_dst="172.16.9.132", dns_qry_name="122.2o7.turner.com", dns_qry_class="0x00000001", dns_qry_type=1, dns_qry_rcode=0)


def test_dns_filters(spark):
    defects = [{c: v} for c in ("frame_time", "ip_dst", "dns_qry_name") for v in (None, "", "-")]
    defects += [dict(dns_qry_name="(empty)"), dict(unix_tstamp=None), dict(frame_len=None)]
    defects += [dict(dns_qry_class=c, dns_qry_type=None, dns_qry_rcode=None) for c in (None, "", "-")]
    fine = [{}] + [dict(dns_qry_class=c) for c in (None, "", "-")] + [dict(dns_qry_type=None), dict(dns_qry_rcode=None), dict(dns_qry_class=None, dns_qry_type=None), dict(dns_qry_class=None, dns_qry_rcode=None)]
    df = spark.createDataFrame([tuple({**DNS_GOOD, **c}.values()) for c in defects + fine], DNS)
    assert (validate.clean_dns(df).count(), validate.invalid_dns(df, strict_reference=True).count()) == (8, 15)
    filled = validate.model_input(df, "dns").collect()
    assert all(r.dns_qry_type is not None and r.dns_qry_rcode is not None and r.dns_qry_class is not None for r in filled)


def test_proxy_filters(spark):
    schema = ", ".join(f"{c} {'int' if c in ('duration', 'scbytes', 'csbytes') else 'string'}" for c in schemas.PROXY_IN)
    good = {c: 1 if c in ("duration", "scbytes", "csbytes") else "x" for c in schemas.PROXY_IN}
    changes = [{}] + [{c: None} for c in ("p_date", "p_time", "clientip", "host", "fulluri")]
    df = spark.createDataFrame([tuple({**good, **c}.values()) for c in changes], schema)
    assert (validate.clean_proxy(df).count(), validate.invalid_proxy(df).count()) == (1, 5)


@pytest.mark.parametrize("threshold, want", [(1e-4, 2), (1.0, 4)])
def test_scored(spark, threshold, want):
    df = spark.createDataFrame([(-1.0,), (1.0,), (5e-7,), (0.05,), (1e-4,)], "score double")
    assert validate.scored_below(df, threshold).count() == want
