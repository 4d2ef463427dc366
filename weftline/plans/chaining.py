"""Count per key, compare with the average, look up an attribute, bin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.joins import last_per_key

# The names of the two bins.
BELOW, ABOVE = "multiplebelow", "multipleabove"


def _counts(records: DataFrame, key: str) -> DataFrame:
    return (
        records.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("user_id"))
        .agg(F.count("*").alias("posts"))
    )


def chain_metrics(records: DataFrame, key: str = "user_id") -> DataFrame:
    """One row: ``records, users, avg_posts``."""
    return _counts(records, key).agg(
        F.coalesce(F.sum("posts"), F.lit(0)).alias("records"),
        F.count("*").alias("users"),
        F.try_divide(F.sum("posts").cast("double"), F.count("*")).alias("avg_posts"),
    )


def count_bin_enrich(
    records: DataFrame,
    users: DataFrame,
    *,
    key: str = "user_id",
    user_key: str = "user_id",
    attribute: str = "attribute",
    order_by: str,
) -> DataFrame:
    """``user_id, posts, attribute, bin`` of every user that has records.

    One plan: the counts feed the global average, a scalar subquery over the
    same shuffle, and are then joined with the users, whose last row per id they
    share the partitioning of. A user without a row has a NULL attribute.
    """
    counts = _counts(records, key)
    average = chain_metrics(records, key).select("avg_posts").scalar()
    lookup = last_per_key(
        users.where(F.col(user_key).isNotNull()).select(
            F.col(user_key).alias("user_id"),
            F.col(attribute).alias("attribute"),
            F.col(order_by).alias("ord"),
        ),
        "user_id", "attribute", "ord",
    )
    bin_name = F.when(F.col("posts") < average, BELOW).otherwise(ABOVE)
    return counts.join(lookup, "user_id", "left").select(
        "user_id", "posts", "attribute", bin_name.alias("bin")
    )
