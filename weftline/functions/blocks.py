"""Blocks of consecutive numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def block_number(order: str, n: int) -> Column:
    """The block of ``n`` consecutive numbers that a number is in."""
    if n < 1:
        raise ValueError("a block must have at least 1 row")
    number = F.col(order).cast("bigint")
    return F.call_function("div", number - F.pmod(number, F.lit(n)), F.lit(n))
