"""Whole jobs from text files to text files.

Each function reads lines, runs one operator and writes ``key \\t value`` lines,
replacing the output folder. ``mode`` says what malformed lines do, see
:mod:`weftline.sources.parsers`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline import operators as op
from weftline import sinks
from weftline.functions import render
from weftline.functions.tokens import REGEX_SPACE, split_blanks
from weftline.plans.blocks import block_sums, first_two_sum
from weftline.plans.chaining import ABOVE, BELOW, count_bin_enrich
from weftline.sources import (
    number_lines,
    parse_docs,
    parse_entities,
    parse_pairs,
    parse_profiles,
    parse_words,
    random_posts,
    read_lines,
    read_ordered_lines,
    render_post,
    row_numbers,
)

FAIL = "failfast"


def word_count(spark: SparkSession, source: str, out: str) -> None:
    sinks.write_lines(op.word_count(read_lines(spark, source)), out)


def chain_word_count(spark: SparkSession, source: str, out: str) -> None:
    sinks.write_lines(op.chain_word_count(read_lines(spark, source)), out)


def _write_rendered(df: DataFrame, key: str, value, out: str) -> None:
    sinks.write_lines(df.select(key, value.alias("rendered")), out)


def min_max_count(spark: SparkSession, source: str, out: str, mode: str = FAIL) -> None:
    pairs = parse_pairs(read_lines(spark, source), mode)
    _write_rendered(op.min_max_count(pairs), "id", render.min_max(), out)


def avg_count(spark: SparkSession, source: str, out: str, mode: str = FAIL) -> None:
    pairs = parse_pairs(read_lines(spark, source), mode, REGEX_SPACE)
    _write_rendered(op.avg_count(pairs), "id", render.count_average(), out)


def median_std(spark: SparkSession, source: str, out: str, mode: str = FAIL) -> None:
    pairs = parse_pairs(read_lines(spark, source), mode)
    _write_rendered(op.median_std(pairs), "id", render.median_std(), out)


def inverted_index(
    spark: SparkSession, source: str, out: str, chunk_docs: int = 1000, mode: str = FAIL
) -> None:
    """``token \\t : id id id``, one line per token and chunk of ids."""
    docs = parse_docs(read_lines(spark, source), mode)
    lists = op.token_lists(docs, split=split_blanks, chunk_docs=chunk_docs)
    _write_rendered(lists, "token", render.id_list(), out)


def top_ten(spark: SparkSession, source: str, out: str, n: int = 10, mode: str = FAIL) -> None:
    docs = parse_docs(read_ordered_lines(spark, source), mode, keep=["position"])
    top = op.top_n(docs, n, order_by="position")
    sinks.write_sorted_lines(top, out, "id")


def distinct(spark: SparkSession, source: str, out: str, mode: str = FAIL) -> None:
    ids = parse_docs(read_lines(spark, source), mode, fields=["id"])
    sinks.write_lines(op.distinct_keys(ids), out)


def distributed_grep(spark: SparkSession, source: str, out: str, pattern: str) -> None:
    sinks.write_lines(op.grep(read_lines(spark, source), pattern), out)


def hotlist_filter(
    spark: SparkSession, hotlist: str, source: str, out: str, mode: str = FAIL
) -> None:
    """The lines of which the body has a word of the hot list, in order."""
    lines = number_lines(spark, source)
    docs = parse_docs(lines, mode, keep=["file", "line_no"], fields=["body"])
    words = parse_words(read_lines(spark, hotlist))
    kept = op.hotlist_filter(docs, words)
    sinks.write_sorted_lines(kept.select("value"), out, "value")


def reduce_side_join(
    spark: SparkSession, users: str, comments: str, how: str, out: str, mode: str = FAIL
) -> None:
    left = parse_entities(read_lines(spark, users), mode).withColumnRenamed("value", "left_line")
    right = parse_entities(read_lines(spark, comments), mode)
    joined = op.keyed_join(left, right.withColumnRenamed("value", "right_line"), how)
    sinks.write_lines(joined, out, "left_line", "right_line")


def replicated_join(
    spark: SparkSession, users: str, comments: str, out: str, how: str, mode: str = FAIL
) -> None:
    """The comments, each with the last line of its user."""
    small = parse_entities(read_ordered_lines(spark, users), mode, keep=["position"])
    big = parse_entities(read_lines(spark, comments), mode)
    joined = op.replicated_join(
        big.withColumnRenamed("value", "big_line"),
        small.withColumnRenamed("value", "small_line"),
        how,
        order_by="position",
    )
    sinks.write_lines(joined, out, "big_line", "small_line")


def cartesian_product(spark: SparkSession, left: str, right: str, out: str) -> None:
    pairs = op.cartesian(read_lines(spark, left), read_lines(spark, right))
    sinks.write_lines(pairs, out)


def job_chaining(
    spark: SparkSession, comments: str, users: str, out: str, mode: str = FAIL
) -> tuple[DataFrame, dict]:
    """Users binned by their number of comments; ``bin, cnt`` and the metrics of the chain.

    The metrics are ``records``, ``users`` and ``avg_posts``. All counts come from the pass that writes.
    """
    records = parse_profiles(read_lines(spark, comments), mode)
    profiles = parse_profiles(read_ordered_lines(spark, users), mode, keep=["position"])
    binned = count_bin_enrich(records, profiles, order_by="position")
    totals = {"records": F.coalesce(F.sum("posts"), F.lit(0)), "users": F.count("*")}
    bins, metrics = sinks.write_counted(binned, out, [BELOW, ABOVE], totals)
    average = metrics["records"] / metrics["users"] if metrics["users"] else None
    return bins, metrics | {"avg_posts": average}


def multiline_sum(spark: SparkSession, source: str, out: str, n: int = 1) -> None:
    """Per file and block of ``n`` lines, the sum of the first two numbers of each."""
    numbered = number_lines(spark, source)
    sums = block_sums(numbered, n, order="line_no", value=first_two_sum(), within=["file"])
    sinks.write_lines(sums, out, "first_line", "total")


def random_data(
    spark: SparkSession, wordlist: str, out: str, tasks: int = 8, records: int = 2, seed: int = 42
) -> None:
    """``tasks * records`` posts with words drawn from the lines of one file."""
    listed = number_lines(spark, wordlist)
    if listed.select("file").distinct().limit(2).count() > 1:
        raise ValueError("the word list must be one file")
    words = listed.select(F.col("line_no").alias("idx"), F.col("value").alias("word"))
    posts = random_posts(row_numbers(spark, tasks, records), words, seed)
    sinks.write_lines(posts.select(render_post().alias("post")), out)
