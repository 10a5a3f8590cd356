import random
from datetime import date

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardenlake.functions import addresses, reputation, texts
from wardenlake.operators import corpus, details, enrich, indexing, quantiles, ranges, records
from wardenlake.operators.joins import lookup_join
from wardenlake.plans import investigate, storyboard


def num_to_ip(n):
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


def test_ranges_against_brute_force(spark):
    rng = random.Random(5)
    spans = []
    for i in range(300):
        lo = rng.choice([0, 167772160, 167772160 + rng.randrange(1 << 18), rng.randrange(1 << 32)])
        spans.append((lo, min(lo + rng.choice([0, 1, 255, 65535, rng.randrange(1 << 20), (1 << 32) - 1]), (1 << 32) - 1), f"n{i:03d}"))
    ips = [0, (1 << 32) - 1] + [167772160 + rng.randrange(1 << 19) for _ in range(300)] + [rng.randrange(1 << 32) for _ in range(100)]
    table = spark.createDataFrame(spans, "lo bigint, hi bigint, name string")
    asked = spark.createDataFrame([(num_to_ip(n),) for n in set(ips)], "ip string")
    found = {r.ip: r.name for r in ranges.narrowest_range(ranges.distinct_addresses(asked, "ip"), table, "name").collect()}
    inside = {r.ip for r in ranges.addresses_inside(ranges.distinct_addresses(asked, "ip"), table).collect()}
    for n in set(ips):
        hits = sorted((hi - lo, lo, name) for lo, hi, name in spans if lo <= n <= hi)
        assert found.get(num_to_ip(n)) == (hits[0][2] if hits else None)
        assert (num_to_ip(n) in inside) == bool(hits)


def test_blocks_cover_a_range_once(spark):
    spans = [(5, 5), (0, (1 << 32) - 1), (3, 1000), (1 << 20, (1 << 20) + 77777), (7, 8)]
    blocks = ranges.prefix_blocks(spark.createDataFrame(spans, "lo bigint, hi bigint")).collect()
    for lo, hi in spans:
        mine = sorted((b.block << b.level, ((b.block + 1) << b.level) - 1) for b in blocks if (b.lo, b.hi) == (lo, hi))
        assert mine[0][0] == lo and mine[-1][1] == hi and len(mine) <= 64
        assert all(a[1] + 1 == b[0] for a, b in zip(mine, mine[1:]))


def test_geo_against_bisect(spark):
    rng = random.Random(9)
    starts = sorted({rng.randrange(1 << 32) for _ in range(200)} | {167772160 + i * 40 for i in range(50)})
    geo = spark.createDataFrame([(s, f"s{s}", "c", "1", "2", "o", "d") for s in starts], "range_start bigint, state string, city string, latitude string, longitude string, owner string, domain string")
    ips = {rng.randrange(1 << 32) for _ in range(300)} | {starts[0] - 1, starts[0], starts[-1], 167772160 + 39}
    asked = ranges.distinct_addresses(spark.createDataFrame([(num_to_ip(n),) for n in ips], "ip string"), "ip")
    got = {r.ip: r.state for r in enrich.geo_of(asked, geo).collect()}
    for n in ips:
        below = [s for s in starts if s <= n]
        assert got.get(num_to_ip(n)) == (f"s{below[-1]}" if below else None)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e6, 1e6) | st.sampled_from([0.0, 1.0, 1e-300]), min_size=1, max_size=60), q=st.floats(0.01, 1.0))
def test_exact_quantile(spark, values, q):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rank = min(max(int(np.ceil(q * len(values) - 1e-9)), 1), len(values))
    assert quantiles.exact_quantile(df, "v", q, accuracy=20, listed=4) == sorted(values)[rank - 1]


@pytest.mark.parametrize("q", [0.05, 0.5, 0.501, 0.95, 1.0])
def test_quantile_with_heavy_ties_and_wide_range(spark, q):
    values = [0.0] * 3000 + [1.0] * 3000 + [10.0 ** -k for k in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = sorted(values)[int(np.ceil(q * len(values) - 1e-9)) - 1]
    assert quantiles.exact_quantile(df, "v", q, accuracy=100, listed=50) == want


def test_quantile_of_nothing(spark):
    assert quantiles.exact_quantile(spark.createDataFrame([], "v double"), "v", 0.5) is None
    with pytest.raises(ValueError):
        quantiles.percentile_threshold(spark.createDataFrame([(1.0,)], "v double"), "v", 0)


def test_dense_index(spark):
    words = spark.createDataFrame([(f"w{i % 500}",) for i in range(2000)], "word string")
    got = sorted(r.idx for r in indexing.dense_index(words, "word", buckets=7).collect())
    assert got == list(range(500))


def test_weights_equal_repeated_rows(spark, data):
    flow = data.view("v_flow")
    judged = flow.filter("ml_score < 0.05")
    weighted = corpus.flow_corpus(corpus.flow_training(flow, judged, 7))
    literal = corpus.flow_corpus(flow.select("trhour", "sip", "dip", "sport", "dport", "proto", "ibyt", "ipkt").union(
        corpus.repeat_rows(judged.select("trhour", "sip", "dip", "sport", "dport", "proto", "ibyt", "ipkt"), 7)))
    assert weighted.exceptAll(literal).isEmpty() and literal.exceptAll(weighted).isEmpty()


def test_edges_meet_names_by_equality(spark, data):
    some = data.view("v_dns_scores").filter("ml_score <= 0.3")
    dns = data.view("v_dns")
    edges = details.dns_edges(dns, some, limit=3)
    assert "Contains(" not in edges._jdf.queryExecution().optimizedPlan().toString()
    asked = some.select("y", "m", "d", "h", F.col("dns_qry_name").alias("asked")).distinct()
    every = dns.join(asked, ["y", "m", "d", "h"]).where(F.col("dns_qry_name").contains(F.col("asked")))
    counts = every.groupBy("y", "m", "d", "h", "asked").agg(F.least(F.count(F.lit(1)), F.lit(3)).alias("n"))
    found = edges.groupBy("y", "m", "d", F.col("hh").alias("h"), "asked").agg(F.count(F.lit(1)).alias("n"))
    assert counts.exceptAll(found).isEmpty() and found.exceptAll(counts).isEmpty() and not found.isEmpty()


def test_lookup_join_beyond_the_limit(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    lookup = spark.createDataFrame([("a", "x")], "k string, v string")
    for limit in (0, 1 << 20):
        assert sorted(map(tuple, lookup_join(rows, lookup, "k", max_bytes=limit).collect())) == [("a", 1, "x"), ("b", 2, None)]


def test_addresses(spark):
    texts_ = ["10.180.88.23", "255.255.255.255", "256.1.1.1", "a.b.c.d", "1.2.3", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts_], "ip string").select(addresses.ip_to_long(F.col("ip"))).collect()]
    assert got == [179591191, 4294967295, None, None, None, None]


def test_reputation_texts(spark):
    rows = [("gti:High:3::fb:UNKNOWN:-1", 3), ("", -1), (None, -1), ("fb:UNKNOWN:-1", -1), ("gti:Minimal:1:Spam|Risk", 1)]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string")
    assert [r[0] for r in df.select(reputation.highest_reputation(F.col("t"))).collect()] == [v for _, v in rows]


def test_log_tokens(spark):
    line = '2016-01-02 10:00:01 "Mozilla/5.0 (X11; Linux)" - "a b"'
    got = spark.range(1).select(texts.log_tokens(F.lit(line))).first()[0]
    assert got == ["2016-01-02", "10:00:01", '"Mozilla/5.0 (X11; Linux)"', "-", '"a b"']


def test_directions(spark):
    groups = spark.createDataFrame([
        ("x", "x", "a", 2, 10), ("x", "a", "x", 3, 20), ("x", "x", "b", 1, 5), ("x", "c", "x", 4, 7), ("x", "c", "x", 1, 9),
    ], "ip_threat string, srcip string, dstip string, conns bigint, maxbyts bigint")
    got = {r.ip: (r.direction, r.conns, r.maxbytes, r.peer) for r in storyboard.directions(groups).collect()}
    assert got["a"] == ("two way", 3, 20, "x") and got["b"] == ("Inbound Only", 1, 5, "x")
    assert got["c"] == ("Outbound Only", 5, 9, "x") and got["x"] == ("two way", 3, 10, "a")


def test_upsert_and_reset(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "k string, n int")
    assert sorted(map(tuple, investigate.upsert(old, new, "k").collect())) == [("a", 1), ("b", 9), ("c", 3)]
    days = spark.createDataFrame([(2024, 1, 9), (2024, 2, 9)], "y int, m int, d int")
    assert [r.m for r in investigate.without_day(days, date(2024, 1, 9)).collect()] == [2]


def test_scope_of_scored_connections(spark, data):
    scores, day = data.view("v_dns_scores"), date(2024, 1, 10)
    threat = data.view("v_dns_threat")
    everywhere = investigate.dns_suspicious(scores, threat, day, limit=10_000)
    that_day = investigate.dns_suspicious(scores, threat, day, limit=10_000, scored_scope="day")
    assert everywhere.count() < that_day.count() <= records.on_day(scores, day).count()
    with pytest.raises(ValueError):
        investigate.dns_suspicious(scores, threat, day, scored_scope="week")


def test_date_range_crosses_months(spark):
    days = spark.createDataFrame([(2024, 1, 31), (2024, 2, 1), (2024, 2, 20), (2023, 2, 1)], "y int, m int, d int")
    assert records.between_days(days, date(2024, 1, 30), date(2024, 2, 10)).count() == 2


def test_questions_need_an_argument(spark, data):
    with pytest.raises(ValueError):
        investigate.dns_expanded(data.view("v_dns"))
    with pytest.raises(ValueError):
        investigate.score_flow(data.view("v_flow_scores"), 1)
