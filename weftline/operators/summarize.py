"""Per-key summaries of numeric values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def min_max_count(df: DataFrame, key: str = "id", value: str = "freq") -> DataFrame:
    return df.groupBy(key).agg(
        F.min(value).alias("min_freq"),
        F.max(value).alias("max_freq"),
        F.count(value).alias("cnt"),
    )


def avg_count(df: DataFrame, key: str = "id", value: str = "freq") -> DataFrame:
    return df.groupBy(key).agg(
        F.count(value).alias("cnt"), F.avg(value).alias("average")
    )


def merge_averages(
    df: DataFrame, key: str = "id", count: str = "cnt", average: str = "average"
) -> DataFrame:
    """Combine partial ``count, average`` rows of a key, weighted by count."""
    return df.groupBy(key).agg(
        F.sum(count).alias("cnt"),
        F.try_divide(F.sum(F.col(count) * F.col(average)), F.sum(count)).alias("average"),
    )


def value_histogram(
    df: DataFrame, key: str | Sequence[str] = "id", value: str = "freq"
) -> DataFrame:
    """``key, value, cnt``: one row per distinct value of a key."""
    keys = [key] if isinstance(key, str) else list(key)
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count("*").alias("cnt"))
    )


# A 32-bit value is a high and a low half of 16 bits, so no step below ever sees
# more than 2^16 rows of one key together, whatever share of the data it holds.
_HALF_BITS = 16
_HALF = 1 << _HALF_BITS

#: Keys of which the bits found so far, at most two rows of some 60 bytes each, go to every task.
MAX_BROADCAST_KEYS = 200_000


def median_std(df: DataFrame, key: str = "id", value: str = "freq") -> DataFrame:
    """Exact median (mean of the middle two if even) and sample deviation per key.

    A key with one value has a NULL deviation.
    """
    return median_std_histogram(value_histogram(df, key, value), key, value)


def median_std_histogram(
    hist: DataFrame, key: str = "id", value: str = "freq", count: str = "cnt"
) -> DataFrame:
    """As :func:`median_std`, from (partial) histograms, which it merges.

    The median of 32-bit integers is found in two steps: first the value range of 2^16
    that holds the middle, from the counts per range, then the middle within that
    range. The deviation comes from exact sums per range. 64-bit integers, decimals of
    up to 18 digits and floating point numbers take four such steps, and their
    deviation is a sum in double precision.
    """
    if not isinstance(hist.schema[value].dataType, (T.ByteType, T.ShortType, T.IntegerType)):
        return _wide_median_std(hist, key, value, count)

    # The range is declared free of NULLs, so that the join below adds no filter
    # to one use of the histogram only and both share its shuffle.
    merged = (
        hist.select(F.col(key).alias("k"), F.col(value).alias("v"), F.col(count).alias("cnt"))
        .groupBy("k", "v")
        .agg(F.sum("cnt").alias("c"))
        .withColumn("range", F.coalesce(F.shiftright("v", _HALF_BITS), F.lit(0)))
    )
    base = F.col("range").cast("double") * _HALF
    offset = F.col("v").cast("bigint") - F.col("range").cast("bigint") * _HALF
    square = offset * offset
    # A square has 32 bits. Summed in halves, no sum can outgrow 64 bits below
    # 10^14 rows, and n * sum(x^2) - sum(x)^2 is exact in decimals after that.
    exact = "decimal(38,0)"
    squares = F.col("hi").cast(exact) * _HALF + F.col("lo")
    spread = F.col("n").cast(exact) * squares - F.col("s").cast(exact) * F.col("s")
    ranges = (
        merged.groupBy("k", "range")
        .agg(
            F.sum("c").alias("n"),
            F.sum(F.col("c") * offset).alias("s"),
            F.sum(F.col("c") * F.shiftright(square, _HALF_BITS)).alias("hi"),
            F.sum(F.col("c") * square.bitwiseAND(_HALF - 1)).alias("lo"),
        )
        .select(
            "k",
            "range",
            "n",
            (base + F.col("s") / F.col("n")).alias("mean"),
            (spread.cast("double") / F.col("n")).alias("m2"),
        )
    )

    per_key = W.partitionBy("k")
    so_far = per_key.orderBy("range").rowsBetween(W.unboundedPreceding, W.currentRow)
    total = F.sum("n").over(per_key)
    around = F.col("mean") - F.col("key_mean")
    picked = (
        ranges.withColumn("total", total)
        .withColumn("upto", F.sum("n").over(so_far))
        .withColumn("key_mean", F.sum(F.col("n") * F.col("mean")).over(per_key) / F.col("total"))
        .withColumn("key_m2", F.sum(F.col("m2") + F.col("n") * around * around).over(per_key))
        .withColumn("before", F.col("upto") - F.col("n"))
        .withColumn("rank_lo", F.expr("(total + 1) div 2"))
        .withColumn("rank_hi", F.expr("total div 2 + 1"))
        .where("before < rank_hi and upto >= rank_lo")
        .select(
            F.col("k").alias("picked_key"),
            F.col("range").alias("picked_range"),
            "before",
            "rank_lo",
            "rank_hi",
            F.sqrt(F.try_divide(F.col("key_m2"), F.col("total") - 1)).alias("std"),
        )
    )

    within = (
        W.partitionBy("k", "range")
        .orderBy("v")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    middle = (
        merged.join(
            picked,
            F.col("k").eqNullSafe(F.col("picked_key"))
            & (F.col("range") == F.col("picked_range")),
        )
        .withColumn("upto", F.col("before") + F.sum("c").over(within))
        .where("upto - c < rank_hi and upto >= rank_lo")
    )
    low, high = F.min("v").cast("double"), F.max("v").cast("double")
    return middle.groupBy(F.col("k").alias(key)).agg(
        ((low + high) / 2).alias("median"), F.max("std").alias("std")
    )


def _double_place(v: Column) -> Column:
    """A 64-bit integer in the order of the doubles, by exponent and then fraction."""
    size = F.abs(v)
    guess = F.floor(F.log2(size)).cast("int")
    # The logarithm may be off by one next to a power of two.
    power = F.pow(F.lit(2.0), guess.cast("double"))
    exponent = guess - (power > size).cast("int") + (power * 2 <= size).cast("int")
    fraction = (size / F.pow(F.lit(2.0), exponent.cast("double")) - 1) * 2.0**52
    tiny = size * 2.0**537 * 2.0**537
    infinite = (2047 << 52) + F.isnan(v).cast("bigint")
    place = (
        F.when(F.isnan(v) | (size == float("inf")), infinite)
        .when(size < 2.0**-1022, tiny.cast("bigint"))
        .otherwise((exponent + 1023).cast("bigint") * (1 << 52) + fraction.cast("bigint"))
    )
    return F.when(v < 0, -place).otherwise(place)


def _place(v: Column, kind: T.DataType) -> Column:
    """A 64-bit integer in the order of the values; equal for equal values only."""
    if isinstance(kind, T.LongType):
        return v
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (v.cast(f"decimal(38,{kind.scale})") * 10**kind.scale).cast("bigint")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return _double_place(v.cast("double"))
    raise TypeError(f"no median of {kind.simpleString()} values")


def _wide_median_std(hist: DataFrame, key: str, value: str, count: str) -> DataFrame:
    """Median and deviation by 16 bits of the place of a value at a time.

    The first step counts the values of each key by the first 16 bits and finds those of the middle
    ranks. Each further step keeps only the values that begin with the bits found so far, before it
    counts by 16 more, at most 2^16 of a key, for each of the middle ranks. The bits found are a
    row or two per key; they go to every task if the keys, which one action counts as far as
    that needs, are few enough. Then the histogram is shuffled once.
    """
    merged = (
        hist.select(F.col(key).alias("k"), F.col(value).alias("v"), F.col(count).alias("cnt"))
        .groupBy("k", "v")
        .agg(F.sum("cnt").alias("c"))
        .withColumn("place", _place(F.col("v"), hist.schema[value].dataType))
    )
    few = hist.select(key).distinct().limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS
    parts = merged.groupBy("k", F.shiftright("place", 48).alias("part")).agg(
        F.sum("c").alias("n"), F.max("v").alias("v")
    )
    total = F.sum("n").over(W.partitionBy("k"))
    ranks = F.array_distinct(F.array(F.expr("(total + 1) div 2"), F.expr("total div 2 + 1")))
    middle = _holding(parts.withColumn("total", total).select(
        "k", "part", "n", "v", F.lit(0).cast("bigint").alias("before"), F.explode(ranks).alias("rank")
    ))
    for shift in (32, 16, 0):
        wanted = middle.select(
            F.col("k").alias("w_k"), F.col("part").alias("w_part"), "before", "rank"
        )
        begins = F.col("k").eqNullSafe(F.col("w_k")) & (
            F.shiftright("place", shift + 16) == F.col("w_part")
        )
        kept = merged.join(F.broadcast(wanted) if few else wanted, begins)
        middle = _holding(
            kept.groupBy("k", "rank", "before", F.shiftright("place", shift).alias("part")).agg(
                F.sum("c").alias("n"), F.max("v").alias("v")
            )
        )
    medians = middle.groupBy("k").agg(F.avg(F.col("v").cast("double")).alias("median"))
    return medians.join(
        _wide_std(merged).withColumnRenamed("k", "s_k"), F.col("k").eqNullSafe(F.col("s_k"))
    ).select(F.col("k").alias(key), "median", "std")


def _holding(parts: DataFrame) -> DataFrame:
    """Of the parts of a key those that hold the ranks, with the number of values before them."""
    so_far = W.partitionBy("k", "rank").orderBy("part").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    return (
        parts.withColumn("upto", F.col("before") + F.sum("n").over(so_far))
        .withColumn("before", F.col("upto") - F.col("n"))
        .where("before < rank and upto >= rank")
        .select("k", "part", "before", "rank", "v")
    )


def _wide_std(merged: DataFrame) -> DataFrame:
    """``k, std``: sums per leading 16 bits of the doubles, off the least value of those bits."""
    v = F.col("v").cast("double")
    part = F.shiftright(_double_place(v), 48)
    bits = F.abs(F.col("part"))
    # Sixteen parts between powers of two.
    low = (
        F.pow(F.lit(2.0), F.shiftright(bits, 4).cast("double") - 1023)
        * (1 + bits.bitwiseAND(F.lit(15)) / 16)
    )
    low = F.when(bits < 16, 0.0).when(F.col("part") < 0, -low).otherwise(low)
    off = F.col("x") - F.col("low")
    ranges = (
        merged.select("k", "c", v.alias("x"), part.alias("part"))
        .withColumn("low", low)
        .groupBy("k", "part", "low")
        .agg(
            F.sum("c").alias("n"),
            F.sum(F.col("c") * off).alias("s"),
            F.sum(F.col("c") * off * off).alias("q"),
        )
    )
    ranges = ranges.select(
        "k", "n", (F.col("low") + F.col("s") / F.col("n")).alias("mean"),
        (F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("m2"),
    )
    per_key = W.partitionBy("k")
    around = F.col("mean") - F.col("key_mean")
    centred = ranges.withColumn(
        "key_mean", F.sum(F.col("n") * F.col("mean")).over(per_key) / F.sum("n").over(per_key)
    ).withColumn("square", F.greatest(F.col("m2"), F.lit(0.0)) + F.col("n") * around * around)
    return centred.groupBy("k").agg(
        F.sqrt(F.try_divide(F.sum("square"), F.sum("n") - 1)).alias("std")
    )
