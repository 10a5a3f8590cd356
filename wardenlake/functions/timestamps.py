"""Readings of the textual time columns of the three log sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_of(time_text: Column) -> Column:
    """Hour of ``HH:MM:SS...``; null if it is not a number."""
    return F.get(F.split(time_text, ":"), F.lit(0)).try_cast("int")


def seconds_of_day(time_text: Column) -> Column:
    parts = F.split(time_text, ":")

    def part(i):
        return F.get(parts, F.lit(i)).try_cast("int")

    return (3600 * part(0) + 60 * part(1) + part(2)).cast("double")


def frame_clock(frame_time: Column) -> Column:
    """Clock token of a DNS frame time such as ``May  12 2015 11:32:45.5 UTC``."""
    return F.get(F.split(frame_time, " +"), F.lit(3))


def unix_to_text(unix: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(F.timestamp_seconds(unix), fmt)


def text_to_unix(text: Column) -> Column:
    return F.unix_seconds(text.try_cast("timestamp"))


def minute_key(day_text: Column, hour: Column, minute: Column) -> Column:
    """``yyyy-MM-dd HH:mm`` from a day text and two numbers."""
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat(day_text, F.lit(" "), pad(hour), F.lit(":"), pad(minute))


def minute_to_timestamp(minute_text: Column) -> Column:
    return F.concat(minute_text, F.lit(":00")).try_cast("timestamp")


def day_text(y: Column, m: Column, d: Column) -> Column:
    return F.concat_ws(
        "-", y.cast("string"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")
    )


def day_date(y: str = "y", m: str = "m", d: str = "d") -> Column:
    return F.make_date(F.col(y).cast("int"), F.col(m).cast("int"), F.col(d).cast("int"))
