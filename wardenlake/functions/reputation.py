"""Reputation labels and their text form ``service:text:value[:categories]``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SCORE = 16


def score_label(score: Column, service: str = "gti") -> Column:
    """Label of a numeric reputation score; a missing score counts as the default."""
    score = F.coalesce(score, F.lit(DEFAULT_SCORE))
    text = (
        F.when(score < 15, F.lit("Minimal:1"))
        .when(score < 30, F.lit("Unverified:-1"))
        .when(score < 50, F.lit("Medium:2"))
        .otherwise(F.lit("High:3"))
    )
    return F.concat(F.lit(service + ":"), text)


def with_categories(label: Column, categories: Column) -> Column:
    """Append ``:name|group;name|group`` when there are categories."""
    return F.when(
        F.coalesce(F.size(categories), F.lit(0)) > 0,
        F.concat(label, F.lit(":"), F.array_join(categories, ";")),
    ).otherwise(label)


def status_label(status: Column, service: str = "fb") -> Column:
    """Label of a named status."""
    value = (
        F.when(status == "NON_MALICIOUS", F.lit("0"))
        .when(status == "SUSPICIOUS", F.lit("2"))
        .when(status == "MALICIOUS", F.lit("3"))
        .otherwise(F.lit("-1"))
    )
    known = F.when(status.isin("NON_MALICIOUS", "SUSPICIOUS", "MALICIOUS"), status).otherwise(F.lit("UNKNOWN"))
    return F.concat(F.lit(service + ":"), known, F.lit(":"), value)


def parse_reputation(text: Column) -> Column:
    """Array of structs (service, label, value, categories) of a merged text."""
    def one(info):
        parts = F.split(info, ":")
        return F.struct(
            F.get(parts, F.lit(0)).alias("service"),
            F.get(parts, F.lit(1)).alias("label"),
            F.get(parts, F.lit(2)).try_cast("int").alias("value"),
            F.get(parts, F.lit(3)).alias("categories"),
        )

    return F.when(F.length(text) > 0, F.transform(F.split(text, "::"), one))


def highest_reputation(text: Column) -> Column:
    """Highest value among the services; -1 if there is none."""
    values = F.transform(parse_reputation(text), lambda r: r["value"])
    return F.coalesce(F.greatest(F.array_max(values), F.lit(-1)), F.lit(-1))
