"""Feature expressions of the netflow detectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Slots of the protocol one-hot (the fifth slot is "other") and flag letters.
PROTOCOL_SLOTS = ("UDP", "TCP", "ICMP", "IGMP")
FLAG_LETTERS = ("A", "S", "F", "R", "P", "U")


def protocol_slot(proto: Column, i: int) -> Column:
    """1 if the protocol belongs to slot i. Slot 4 is any other protocol."""
    def named(j):
        return F.coalesce(F.upper(proto).contains(PROTOCOL_SLOTS[j]), F.lit(False))

    hit = ~named(0)
    if i == 0:
        hit = named(0)
    elif i < 4:
        for j in range(1, i):
            hit = hit & ~named(j)
        hit = hit & named(i)
    else:
        for j in range(1, 4):
            hit = hit & ~named(j)
    return hit.cast("int")


def protocol_onehot(proto: Column) -> Column:
    return F.array(*[protocol_slot(proto, i) for i in range(5)])


def flag_count(flag: Column, letter: str) -> Column:
    """How often a TCP flag letter occurs; an X sets every flag to one."""
    n = F.length(flag) - F.length(F.replace(flag, F.lit(letter), F.lit("")))
    return F.when(flag.contains("X"), F.lit(1)).otherwise(n).cast("int")


def flag_onehot(flag: Column) -> Column:
    return F.array(*[flag_count(flag, c) for c in FLAG_LETTERS])


def high_port(port: Column) -> Column:
    return (port > 1024).cast("int")


def log_plus_one(x: Column) -> Column:
    return F.log1p(x.cast("double"))


def min_max_scaled(x: Column, low: Column, high: Column) -> Column:
    return (x - low) / F.nullif(high - low, F.lit(0.0))


def standardised(x: Column, mean: Column, std: Column) -> Column:
    return (x - mean) / F.nullif(std, F.lit(0.0))


def l2_distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))
