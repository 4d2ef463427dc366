"""Token counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.tokens import split_keep_leading, split_non_empty


def word_count(df: DataFrame, text: str = "value") -> DataFrame:
    """``token, cnt``; blank texts count one empty token, as does leading space.

    Counts are combined before the shuffle, so a frequent token sends one row
    per task, not one per occurrence.
    """
    tokens = df.select(F.explode(split_keep_leading(F.col(text))).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("cnt"))


def chain_word_count(df: DataFrame, text: str = "value") -> DataFrame:
    """``token, cnt`` of upper-cased, never empty tokens."""
    tokens = df.select(F.explode(split_non_empty(F.upper(text))).alias("token"))
    return (
        tokens.where(F.col("token") != "")
        .groupBy("token")
        .agg(F.count("*").alias("cnt"))
    )
