"""Seeded random posts.

Every field is a hash of the seed, the row number and the field, so a row does
not depend on how the rows are split over tasks or on a task being run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.sizing import MAX_BROADCAST_BYTES, measured_size

# The ranges of the fields and the number of words of a post.
ID_RANGE = 1_000_000_000
POST_ID_RANGE = 100_000_000
SCORE_RANGE = 15_000
USER_ID_RANGE = 1_000_000
MAX_WORDS = 30
# Creation dates lie in 2008 to 2024, 6210 days.
FIRST_DAY, DAYS, DAY_MS = "2008-01-01", 6210, 86_400_000


def row_numbers(spark: SparkSession, tasks: int = 8, records: int = 2) -> DataFrame:
    """Column ``row``: ``records`` numbers for each of ``tasks`` tasks."""
    return spark.range(0, tasks * records, 1, tasks).withColumnRenamed("id", "row")


def index_words(words: DataFrame, word: str = "token") -> DataFrame:
    """``idx, word``: distinct words numbered from 0, by hash prefix, then word.

    Numbers run on over 4096 hash buckets, each numbered by itself, so the list
    can be of any length.
    """
    distinct = words.select(F.col(word).alias("word")).distinct()
    bucketed = distinct.withColumn("bucket", F.substring(F.md5("word"), 1, 3))
    earlier = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    bases = bucketed.groupBy("bucket").agg(F.count("*").alias("n")).select(
        "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    place = F.row_number().over(W.partitionBy("bucket").orderBy("word")) - 1
    # At most 4096 rows to broadcast.
    return (
        bucketed.withColumn("place", place)
        .join(F.broadcast(bases), "bucket")
        .select((F.col("base") + F.col("place")).alias("idx"), "word")
    )


@dataclass(frozen=True)
class WordList:
    """Numbered words ``idx, word``, how many they are and an upper estimate of their bytes."""

    rows: DataFrame
    size: int
    size_bytes: int


def listed_words(words: DataFrame, word: str = "token") -> WordList:
    """The distinct words, numbered by :func:`index_words`.

    One action counts and measures the distinct words as they are, without numbering them; the
    numbering is part of the plan that draws from the list.
    """
    size, size_bytes = measured_size(words.select(word).distinct())
    # A number takes as much as measured_size says of any number.
    return WordList(index_words(words, word), size, size_bytes + 16 * size)


def _digest(seed: int, field: str, part: Column | None = None) -> Column:
    """32 hex digits for a field, or for each numbered part of it."""
    name = [F.lit(f":{field}")] + ([] if part is None else [part.cast("string")])
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col("row").cast("string"), *name))


def _number(digits: Column, start: int | Column, length: int) -> Column:
    first = F.lit(start) if isinstance(start, int) else start
    return F.conv(F.substr(digits, first, F.lit(length)), 16, 10).cast("bigint")


def _word_count(seed: int) -> Column:
    return (F.lit(1) + _number(_digest(seed, "b"), 25, 8) % MAX_WORDS).cast("int")


def _clock(ms: Column) -> Column:
    def pad(value: Column, width: int) -> Column:
        return F.lpad(value.cast("string"), width, "0")

    rest = ms % DAY_MS
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), F.floor(ms / DAY_MS).cast("int"))
    return F.concat(
        day.cast("string"), F.lit("T"),
        pad(F.floor(rest / 3_600_000), 2), F.lit(":"),
        pad(F.floor(rest / 60_000) % 60, 2), F.lit(":"),
        pad(F.floor(rest / 1000) % 60, 2), F.lit("."),
        pad(rest % 1000, 3),
    )


def random_posts(rows: DataFrame, words: DataFrame | WordList, seed: int = 42) -> DataFrame:
    """One random post per distinct ``row`` number, with words of ``idx, word``.

    A list that is not measured yet is measured here, by one action.

    Columns ``row, id, post_id, score, text, creation_date, user_id``. Every word
    of the text is followed by a blank. Only the row numbers are shuffled: they
    are partitioned first, and the words of a row are then drawn, looked up and
    put together in one task, unless the word list is too long to broadcast.
    """
    spark = rows.sparkSession
    # As many tasks as a shuffle would have; row numbers alone are too small for
    # their size to tell how much work hangs on them.
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
    )
    base = rows.select(F.col("row").cast("bigint").alias("row")).repartition(tasks, "row")
    if not isinstance(words, WordList):
        words = WordList(words, *measured_size(words))
    size = words.size
    if size == 0:
        raise ValueError("the word list is empty")
    # Beyond the limit the join is a shuffle by name: Spark's estimate of the drawn words is that
    # of the row numbers, from which they are exploded, and would send them all to every task.
    small = words.size_bytes <= MAX_BROADCAST_BYTES
    lookup = F.broadcast(words.rows) if small else words.rows.hint("merge")
    # A digest serves four words. The coalesce tells the join that no index is
    # NULL, else a filter for that would hash everything a second time.
    i = F.col("i")
    digits = _digest(seed, "w", F.shiftright(i, 2))
    idx = F.coalesce(_number(digits, i.bitwiseAND(3) * 8 + 1, 8) % size, F.lit(0))
    slots = base.select(
        "row", F.explode(F.sequence(F.lit(0), _word_count(seed) - 1)).alias("i")
    ).select("row", "i", idx.alias("idx"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "word"))).getField("word")
    texts = (
        slots.join(lookup, "idx")
        .groupBy("row")
        .agg(F.concat(F.array_join(ordered, " "), F.lit(" ")).alias("text"))
    )
    a, b = F.col("a"), F.col("b")
    return texts.select(
        "row", "text", _digest(seed, "a").alias("a"), _digest(seed, "b").alias("b")
    ).select(
        "row",
        (_number(a, 1, 12) % ID_RANGE).alias("id"),
        (_number(a, 13, 12) % POST_ID_RANGE).alias("post_id"),
        (_number(a, 25, 8) % SCORE_RANGE).alias("score"),
        "text",
        _clock(_number(b, 13, 12) % (DAYS * DAY_MS)).alias("creation_date"),
        (_number(b, 1, 12) % USER_ID_RANGE).alias("user_id"),
    )


def render_post() -> Column:
    """The post as one ``<row ... />`` line."""
    def attribute(name: str, column: str) -> list[Column]:
        return [F.lit(f' {name}="'), F.col(column).cast("string"), F.lit('"')]

    return F.concat(
        F.lit("<row"),
        *attribute("Id", "id"), *attribute("PostId", "post_id"),
        *attribute("Score", "score"), *attribute("Text", "text"),
        *attribute("CreationDate", "creation_date"), *attribute("UserId", "user_id"),
        F.lit(" />"),
    )
