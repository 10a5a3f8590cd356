"""Join helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Size of a table by one aggregate: text length plus 16 bytes per row and column."""
    width = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in df.columns]))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return row["b"] + 16 * row["n"] * max(len(df.columns), 1)


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def lookup_join(rows: DataFrame, lookup: DataFrame, on, how: str = "left", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join rows to a lookup table.

    The lookup is broadcast only after its size was measured. A larger one is
    joined by shuffle, where adaptive execution splits skewed partitions.
    """
    if is_small(lookup, max_bytes):
        lookup = F.broadcast(lookup)
    return rows.join(lookup, on, how)


#: Marks of a long list: at most 2^20 numbers of 64 bits, whatever its length.
PIECES = 2**20


def _mark(keys):
    """Piece and bit (0 to 63) of a key."""
    code = F.xxhash64(*keys)
    return F.shiftright(code, 6).bitwiseAND(F.lit(PIECES - 1)), code.bitwiseAND(F.lit(63)).cast("int")


def possible_matches(rows: DataFrame, keyed: DataFrame, on) -> DataFrame:
    """Rows whose key may be in ``keyed``: none that matches is lost, most others go before a shuffle.

    The keys are marked in a bitmap of bounded size, which is broadcast.
    """
    piece, bit = _mark(on)
    mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    marks = keyed.groupBy(piece.alias("_piece")).agg(F.bit_or(mark).alias("_marks"))
    rows = rows.withColumns({"_piece": piece, "_bit": bit})
    met = rows.join(F.broadcast(marks), "_piece").where(F.getbit("_marks", F.col("_bit")) == 1)  # one row per piece
    return met.drop("_piece", "_bit", "_marks")
