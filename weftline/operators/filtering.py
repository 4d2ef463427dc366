"""Filters: regex, hot list, distinct keys, top N."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.tokens import split_trimmed
from weftline.operators.bloom import bloom_filter
from weftline.sizing import MAX_BROADCAST_BYTES, measured_size

INLINE_HOTLIST_ROWS = 1000
INLINE_HOTLIST_BYTES = 1 << 20
_TOP_BUCKETS = 1024


def grep(df: DataFrame, pattern: str, text: str = "value") -> DataFrame:
    """Rows whose text has a match of the regular expression."""
    return df.where(F.col(text).rlike(pattern))


def distinct_keys(df: DataFrame, key: str = "id") -> DataFrame:
    return df.select(key).distinct()


def hotlist_filter(
    df: DataFrame,
    hotlist: DataFrame,
    *,
    text: str = "body",
    token: str = "token",
    inline_rows: int = INLINE_HOTLIST_ROWS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Rows of which any token is in the hot list; exact, copies are kept.

    Whether a row stays depends on its text alone, so every way below gives the same
    rows. A list of at most ``inline_rows`` entries becomes one array value that every
    row is checked against, without a shuffle. A longer one is joined with the tokens
    of each text, and the rows with the digests of the texts that were hit. The list
    is broadcast within the limit. Else a Bloom filter of the list drops the tokens that
    are not in it, but for a few, before the join shuffles the others, salted, since one token
    may be in most texts. One action measures the list as it is given.
    """
    listed = hotlist.select(F.col(token).alias("token")).where("token <> ''")
    rows, size = measured_size(listed)
    words = listed.distinct()
    if rows <= inline_rows and size <= INLINE_HOTLIST_BYTES:
        hot = words.agg(F.collect_list("token")).scalar()
        return df.where(F.arrays_overlap(split_trimmed(F.col(text)), hot))

    digest = F.sha2(text, 256)
    tokens = df.select(
        digest.alias("digest"),
        F.explode(F.array_distinct(split_trimmed(F.col(text)))).alias("token"),
    )
    if size <= max_broadcast_bytes:
        hits = tokens.join(F.broadcast(words), "token", "left_semi")
    else:
        tokens = _may_be_listed(tokens, words, rows)
        salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salted = words.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salt = F.pmod(F.xxhash64("digest"), F.lit(salts)).cast("int")
        hits = tokens.withColumn("salt", salt).join(salted, ["token", "salt"], "left_semi")
    hits = hits.select(F.col("digest").alias("hit_digest"))
    return df.join(hits, digest == hits["hit_digest"], "left_semi")


def _may_be_listed(tokens: DataFrame, words: DataFrame, most: int) -> DataFrame:
    """The tokens without most of those that are not in the list of at most ``most`` words."""
    listed = bloom_filter(words, "token", most)
    return tokens.where(listed.might_contain(F.col("token"))) if listed else tokens


def top_n(
    df: DataFrame, n: int = 10, *, key: str = "id", payload: str = "body", order_by: str
) -> DataFrame:
    """The ``n`` largest distinct keys, each with the payload last in ``order_by``.

    Equal ``order_by`` values of a key are settled by the larger payload. A first
    pass over the key column alone finds a key that at least ``n`` distinct keys
    reach: the n-th largest of the maxima per hash bucket. The second pass reads
    from there on only, a filter that reaches the scan, so hardly any row is
    shuffled.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    bucket = F.pmod(F.xxhash64(key), F.lit(max(_TOP_BUCKETS, 16 * n)))
    top_buckets = (
        df.where(F.col(key).isNotNull())
        .groupBy(bucket.alias("bucket"))
        .agg(F.max(key).alias("high"), F.min(key).alias("low"))
        .orderBy(F.desc("high"))
        .limit(n)
    )
    # With fewer than n filled buckets, all keys stay.
    floor = top_buckets.agg(
        F.when(F.count("*") == n, F.min("high")).otherwise(F.min("low"))
    ).scalar()
    last = F.max_by(payload, F.struct(order_by, payload))
    return (
        df.where(F.col(key) >= floor)
        .groupBy(key)
        .agg(last.alias(payload))
        .orderBy(F.desc(key))
        .limit(n)
        .orderBy(key)
    )
