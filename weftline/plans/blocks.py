"""Sums over blocks of consecutive records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.blocks import block_number
from weftline.functions.tokens import REGEX_SPACE, split_fields
from weftline.sources.parsers import strict_int


def first_two_sum(line: str = "value") -> Column:
    """Sum of the first two whitespace-separated integers of a line."""
    fields = split_fields(F.col(line), REGEX_SPACE)
    value = lambda i: strict_int(F.get(fields, F.lit(i))).cast("bigint")
    total = value(0) + value(1)
    fail = F.raise_error(F.concat(F.lit("malformed line: "), F.col(line)))
    return F.coalesce(total, fail.cast("bigint"))


def block_sums(
    df: DataFrame, n: int, *, order: str, value: Column, within: Sequence[str] = ()
) -> DataFrame:
    """``first_line, total`` per block of ``n`` rows numbered densely by ``order``."""
    block = block_number(order, n)
    return (
        df.select(*within, F.col(order).alias("o"), value.alias("v"), block.alias("block"))
        .groupBy(*within, "block")
        .agg(F.min("o").alias("first_line"), F.sum("v").alias("total"))
        .drop("block")
    )
