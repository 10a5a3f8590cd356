"""Ingest totals per minute and month, and label quality counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timestamps import day_text, frame_clock, minute_key


def _complete(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(how="any", subset=list(columns))


def flow_per_minute(flow: DataFrame) -> DataFrame:
    """Complete flows per minute; a row whose record year is not its partition year is left out."""
    rows = _complete(flow, "unix_tstamp", "sip", "sport", "dip", "dport", "ibyt", "ipkt")
    rows = rows.filter((F.col("tryear") == F.col("y")) & F.col("treceived").try_cast("timestamp").isNotNull())
    key = minute_key(day_text(F.col("tryear"), F.col("trmonth"), F.col("trday")), F.col("trhour"), F.col("trminute"))
    return rows.groupBy(key.alias("tdate")).agg(F.count(F.lit(1)).alias("total"))


def dns_per_minute(dns: DataFrame) -> DataFrame:
    rows = _complete(
        dns, "unix_tstamp", "frame_time", "frame_len", "dns_qry_name", "ip_src", "dns_qry_class", "dns_qry_type", "dns_qry_rcode"
    )
    clock = F.split(frame_clock(F.col("frame_time")), ":")
    key = minute_key(day_text(F.col("y"), F.col("m"), F.col("d")), F.get(clock, F.lit(0)), F.get(clock, F.lit(1)))
    return rows.groupBy(key.alias("tdate")).agg(F.count(F.lit(1)).alias("total"))


def proxy_per_minute(proxy: DataFrame) -> DataFrame:
    rows = _complete(proxy, "p_date", "p_time", "clientip", "host", "fulluri").filter("p_time <> ''")
    clock = F.split("p_time", ":")
    key = minute_key(F.col("p_date"), F.get(clock, F.lit(0)), F.get(clock, F.lit(1)))
    return rows.groupBy(key.alias("tdate")).agg(F.count(F.lit(1)).alias("total"))


def per_month(per_minute: DataFrame) -> DataFrame:
    """Totals per month and over all (month null)."""
    month = F.substring("tdate", 1, 7)
    return per_minute.select(month.alias("month"), "total").rollup("month").agg(F.sum("total").alias("total"))


def confusion(df: DataFrame, predicted, actual) -> DataFrame:
    """Counts of a two-class decision and the ratios made of them, in one pass."""
    n = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).alias
    counts = df.select(predicted.alias("p"), actual.alias("a")).agg(
        n(F.col("p") & F.col("a"))("tp"),
        n(F.col("p") & ~F.col("a"))("fp"),
        n(~F.col("p") & F.col("a"))("fn"),
        n(~F.col("p") & ~F.col("a"))("tn"),
    )
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return counts.select(
        "tp", "fp", "fn", "tn",
        F.try_divide(F.col("tp") + F.col("tn"), total).alias("accuracy"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        F.try_divide(F.col("tp") + F.col("fn"), total).alias("contamination"),
    )
