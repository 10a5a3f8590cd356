"""Name an intermediate value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once.

    Branches of a CASE and bodies of lambdas each evaluate their own copy of an
    expression; here they all read one lambda variable.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
