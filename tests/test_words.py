import pytest
from pyspark.sql import functions as F

from wardenlake.functions import domains, numeric, timestamps
from wardenlake.operators import corpus

BASE = "UDP_12_8_2"


@pytest.mark.parametrize("sport, dport, proto, ibyt, ipkt, src, dst", [
    (2132, 23, "UDP", 222, 3, f"23_{BASE}", f"-1_23_{BASE}"),
    (23, 2132, "UDP", 222, 3, f"-1_23_{BASE}", f"23_{BASE}"),
    (8392, 9874, "UDP", 222, 3, f"333333_{BASE}", f"333333_{BASE}"),
    (80, 0, "UDP", 222, 3, f"-1_80_{BASE}", f"80_{BASE}"),
    (0, 43, "UDP", 222, 3, f"43_{BASE}", f"-1_43_{BASE}"),
    (0, 2435, "UDP", 222, 3, f"2435_{BASE}", f"-1_2435_{BASE}"),
    (80, 2435, "UDP", 222, 3, f"-1_80_{BASE}", f"80_{BASE}"),
    (1024, 80, "UDP", 222, 3, f"111111_{BASE}", f"111111_{BASE}"),
    (0, 0, "UDP", 222, 3, f"0_{BASE}", f"0_{BASE}"),
    (0, 0, "TCP", 0, 3, "0_TCP_12_0_2", "0_TCP_12_0_2"),
    (0, 0, "TCP", 222, 0, "0_TCP_12_8_0", "0_TCP_12_8_0"),
    (None, 80, "TCP", 222, 0, "word_error", "word_error"),
])
def test_flow_words(spark, sport, dport, proto, ibyt, ipkt, src, dst):
    row = spark.createDataFrame([(12, sport, dport, proto, ibyt, ipkt)], "trhour int, sport int, dport int, proto string, ibyt bigint, ipkt bigint")
    got = corpus.with_flow_words(row).first()
    assert (got.src_word, got.dst_word) == (src, dst)


def top(spark, *names):
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "rank int, domain string")


def dns(spark, frame_time="May  12 2015 11:32:45.543421000 UTC", name="abcdefg.bronto.com"):
    schema = "frame_time string, unix_tstamp bigint, frame_len int, ip_dst string, dns_qry_name string, dns_qry_class string, dns_qry_type int, dns_qry_rcode int"
    return spark.createDataFrame([(frame_time, 1, 213, "1.2.3.4", name, "0x00000001", 1, 0)], schema)


def test_dns_word(spark):
    assert corpus.with_dns_word(dns(spark), top(spark, "google.com"), "bronto").first().word == "2_7_11_2_10_1_1_0"


@pytest.mark.parametrize("frame_time, name", [("May 12", "a.com"), ("May  12 2015 xx:32:45 UTC", "a.com"), ("May  12 2015 11:32:45 UTC", None)])
def test_dns_word_error(spark, frame_time, name):
    assert corpus.with_dns_word(dns(spark, frame_time, name), top(spark, "google.com")).first().word == "word_error"


@pytest.mark.parametrize("text, bits", [("abcdefg", 2.807354922057604), ("services", 2.5), ("", 0.0), ("aaaa", 0.0)])
def test_entropy(spark, text, bits):
    assert spark.range(1).select(numeric.shannon_entropy(F.lit(text))).first()[0] == pytest.approx(bits, abs=1e-12)


@pytest.mark.parametrize("x, base, want", [(4.0, 2, 2), (8.0, 2, 3), (1.9, 2, 0), (9.5, 3, 2), (0.0, 2, 0)])
def test_log_base(spark, x, base, want):
    assert spark.range(1).select(numeric.log_base_int(F.lit(x), base)).first()[0] == want


@pytest.mark.parametrize("value, want", [(-1.0, 0), (0.0, 0), (1.5, 2), (50.0, 4)])
def test_bins(spark, value, want):
    assert spark.range(1).select(numeric.bin_index(F.lit(value), [0, 1, 2, 3, float("inf")])).first()[0] == want


def test_no_bin(spark):
    assert spark.range(1).select(numeric.bin_index(F.lit(9.0), [0, 1])).first()[0] == -1


@pytest.mark.parametrize("name, domain, sub", [
    ("fatosdesconhecidos.com.br", "fatosdesconhecidos", "None"),
    ("panasonic.jp", "panasonic", "None"),
    ("get.your.best.electronic.at.panasonic.jp", "panasonic", "get.your.best.electronic.at"),
    ("forrealz.net", "forrealz", "None"),
    ("123.103.104.10.in-addr.arpa", "None", "None"),
    ("panasonic.c", "None", "None"),
    ("services.amazon.com.mx", "amazon", "services"),
    ("amazon.com.mx", "amazon", "None"),
    ("amazon.co.uk", "co", "amazon"),
    ("amazon.com.", "amazon", "None"),
    ("com", "None", "None"),
    ("com.mx", "None", "None"),
    ("rojava.krd", "rojava", "None"),
    ("nobody.xx", "None", "None"),
])
def test_domain_parts(spark, name, domain, sub):
    got = spark.range(1).select(domains.domain_parts(F.lit(name)).alias("p")).first().p
    assert (got.domain, got.subdomain) == (domain, sub)


def test_domain_info(spark):
    rows = spark.createDataFrame([("services.amazon.com.mx",), ("123.103.104.10.in-addr.arpa",)], "dns_qry_name string")
    got = {r.dns_qry_name: r.info for r in corpus.with_domain_info(rows, top(spark, "amazon.com")).collect()}
    one = got["services.amazon.com.mx"]
    assert (one.domain, one.top_domain, one.subdomain, one.subdomain_length, one.subdomain_entropy, one.num_periods) == ("amazon", 1, "services", 8, 2.5, 4)
    two = got["123.103.104.10.in-addr.arpa"]
    assert (two.domain, two.top_domain, two.subdomain_length, two.subdomain_entropy, two.num_periods) == ("None", 0, 0, 0.0, 6)


def test_proxy_words(spark):
    schema = "host string, p_time string, reqmethod string, fulluri string, resconttype string, useragent string, respcode string"
    rows = [
        ("inner.com", "00:09:13", "PUT", "ab", "text/plain", "Mozilla/5.0", "202"),
        ("maw.bronto.com", "01:09:13", "PUT", "ab", "text/plain", "Safari/537.36", "202"),
        ("maw.bronto.com", "10:09:13", "PUT", "abcdefg", "/", "Safari/537.36", None),
        ("maw.bronto.com", "xx", "PUT", "ab", "text/plain", "Safari/537.36", "202"),
    ]
    df = spark.createDataFrame(rows, schema)
    counts = spark.createDataFrame([("Mozilla/5.0", 1), ("Safari/537.36", 9)], "useragent string, agent_count bigint")
    got = [r.word for r in corpus.with_proxy_word(df, top(spark, "bronto.com"), counts, ("inner",)).orderBy("host", "p_time").collect()]
    assert got == ["2_0_PUT_4_text_0_1_202", "1_1_PUT_4_text_3_1_202", "1_10_PUT_10_unknown_content_type_3_2_unknown_response_code", "word_error"]


def test_clock(spark):
    row = spark.range(1).select(timestamps.hour_of(F.lit("13:08:05.7")), timestamps.seconds_of_day(F.lit("13:08:05"))).first()
    assert tuple(row) == (13, 47285.0)
