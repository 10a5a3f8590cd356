"""Numeric binning used by the behaviour words. Column in, column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import bind

# Right ends of the entropy bins; the last bin is open.
ENTROPY_CUTS = (
    0.0, 0.3, 0.6, 0.9, 1.2,
    1.5, 1.8, 2.1, 2.4, 2.7,
    3.0, 3.3, 3.6, 3.9, 4.2,
    4.5, 4.8, 5.1, 5.4, float("inf"),
)


def log_base_int(x: Column, base: int) -> Column:
    """Power of ``base`` that gives x, truncated to an int; 0 for x = 0.

    The ratio of two log10 values is kept on purpose: exact powers depend on it.
    """
    x = x.cast("double")
    ratio = F.log10(x) / F.log10(F.lit(float(base)))
    return F.when(x.isNotNull() & (x <= 0), F.lit(0)).otherwise(ratio.cast("int"))


def ceil_log2(x: Column) -> Column:
    return F.ceil(F.log10(x.cast("double")) / F.log10(F.lit(2.0))).cast("int")


def bin_index(value: Column, cuts=ENTROPY_CUTS) -> Column:
    """First index whose cut is at or above the value, -1 if there is none."""
    def choose(v: Column) -> Column:
        out = F.when(v.isNull(), F.lit(None).cast("int"))
        for i, cut in enumerate(cuts):
            out = out.when(v <= F.lit(float(cut)), F.lit(i))
        return out.otherwise(F.lit(-1))

    return bind(value, choose)


def shannon_entropy(text: Column) -> Column:
    """Entropy in bits of the characters of a text; 0 for the empty text."""
    letters = F.array_sort(F.array_remove(F.array_distinct(F.split(text, "")), ""))

    def total(n: Column) -> Column:
        shares = F.transform(letters, lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n)
        return F.aggregate(shares, F.lit(0.0), lambda acc, p: acc - p * F.log10(p) / F.log10(F.lit(2.0)))

    return F.when(F.length(text) == 0, F.lit(0.0)).otherwise(bind(F.length(text).cast("double"), total))


def stable_entropy(text: Column) -> Column:
    """Entropy rounded to 12 digits, so that a value on a bin edge does not
    depend on the order in which the letters were added up."""
    return F.round(shannon_entropy(text), 12)


def cast_number(text: Column) -> Column:
    """Struct (as_int, as_double, as_text): the first reading that parses is set."""
    as_int = text.try_cast("bigint")
    as_int = F.when(text.rlike(r"^\s*[-+]?[0-9]+\s*$"), as_int)
    as_double = F.when(as_int.isNull(), text.try_cast("double"))
    return F.struct(
        as_int.alias("as_int"),
        as_double.alias("as_double"),
        F.when(as_int.isNull() & as_double.isNull(), text).alias("as_text"),
    )
