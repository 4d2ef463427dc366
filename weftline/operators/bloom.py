"""Bloom filters: which keys may be in a list, before an exact join.

A filter is an array of 64-bit words. A hash of a key chooses one word, a second one
``_PROBES`` bits in it, so a test reads one word. Each task sets the bits of its keys in
rows ``word, bits``, which a shuffle merges by OR; two filters of one size merge the same way. The
array as a whole is one value of bounded size that the test reads in every task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_FILTER_BYTES = 8 << 20
BITS_PER_KEY = 12
_PROBES = 4
# A filter that lets more than this share of other keys through is not worth its pass.
_WORST_RATE = 0.5
# Types of which equal values have equal hashes.
_HASHED = (T.StringType, T.BinaryType, T.ByteType, T.ShortType, T.IntegerType, T.LongType,
           T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


class BloomFilter:
    """Bits of the keys of a DataFrame; ``rows`` has ``word, bits`` of words that are not zero."""

    def __init__(self, rows: DataFrame, words: int):
        self.rows, self.words = rows, words

    def merge(self, other: BloomFilter) -> BloomFilter:
        """The filter of the keys of either."""
        if self.words != other.words:
            raise ValueError(f"filters of {self.words} and {other.words} words do not merge")
        return BloomFilter(_merged(self.rows.unionByName(other.rows)), self.words)

    def might_contain(self, key: Column) -> Column:
        """False only for keys that are not in the list, and for NULL."""
        numbers = self.rows.sparkSession.range(self.words)
        empty = numbers.select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits"))
        array = (
            _merged(self.rows.unionByName(empty))
            .agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("all"))
            .select(F.col("all.bits"))
            .scalar()
        )
        mask = _mask(key)
        found = F.get(array, _word(key, self.words)).bitwiseAND(mask) == mask
        return key.isNotNull() & found


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("word")), F.lit(words)).cast("int")


def _mask(key: Column) -> Column:
    drawn = F.xxhash64(key, F.lit("bits"))
    places = [F.shiftright(drawn, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(_PROBES)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in places]
    return reduce(Column.bitwiseOR, bits)


def expected_rate(keys: int, words: int) -> float:
    """The share of other keys that a filter of so many words lets through, about."""
    return (1 - (1 - 1 / 64) ** (_PROBES * keys / words)) ** _PROBES


def bloom_filter(
    keys: DataFrame, key: str, most: int, *, max_bytes: int = MAX_FILTER_BYTES
) -> BloomFilter | None:
    """The filter of the values of ``key``, of which there are at most ``most``.

    None if the filter would let most other keys through in ``max_bytes``, or if equal
    keys of its type can have different hashes.
    """
    words = max(1, min(most * BITS_PER_KEY // 64 + 1, max_bytes // 8))
    if expected_rate(most, words) > _WORST_RATE:
        return None
    if not isinstance(keys.schema[key].dataType, _HASHED):
        return None
    column = F.col(key)
    bits = keys.where(column.isNotNull()).select(
        _word(column, words).alias("word"), _mask(column).alias("bits")
    )
    return BloomFilter(_merged(bits), words)
