"""Inverted index."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.blocks import block_number
from weftline.functions.tokens import split_trimmed

CHUNK_DOCS = 1000
#: Ids that a range of a frequent token spans, at most, per id of an even list.
MOST_WIDE = 64
MAX_FREQUENT = 50_000
#: Bytes of texts in one task, whose words it counts or lists in memory.
TASK_BYTES = 32 << 20


def postings(
    df: DataFrame,
    doc_id: str = "id",
    text: str = "body",
    split: Callable[[Column], Column] = split_trimmed,
) -> DataFrame:
    """``token, doc_id, tf``: one row per token of ``split`` and document.

    The table form of the index: the rows of a frequent token stay spread over
    the tasks. Occurrences are counted before the shuffle.
    """
    tokens = _tokens(df, doc_id, text, split)
    return tokens.groupBy("token", "doc_id").agg(F.count("*").alias("tf"))


def _tokens(
    df: DataFrame, doc_id: str, text: str, split: Callable[[Column], Column]
) -> DataFrame:
    tokens = df.select(
        F.col(doc_id).alias("doc_id"), F.explode(split(F.col(text))).alias("token")
    )
    return tokens.where(F.col("token") != "")


def posting_lists(index: DataFrame, chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """``token, chunk, doc_ids``: sorted id lists, an id once per occurrence.

    A list covers one chunk of ``chunk_docs`` consecutive ids, so a token that
    is in every document has many lists and none grows with the collection. All
    lists of a token, in chunk order, are its full list.
    """
    entry = F.struct("doc_id", "tf")
    repeated = F.flatten(
        F.transform(
            F.array_sort(F.col("entries")),
            lambda e: F.array_repeat(e["doc_id"], e["tf"].cast("int")),
        )
    )
    return (
        index.groupBy("token", block_number("doc_id", chunk_docs).alias("chunk"))
        .agg(F.collect_list(entry).alias("entries"))
        .select("token", "chunk", repeated.alias("doc_ids"))
    )


def token_lists(
    df: DataFrame,
    doc_id: str = "id",
    text: str = "body",
    split: Callable[[Column], Column] = split_trimmed,
    chunk_docs: int = CHUNK_DOCS,
) -> DataFrame:
    """The :func:`posting_lists` of :func:`postings`, straight from the texts.

    One shuffle instead of two: a task sends one list per token and chunk that it met.
    """
    return (
        _tokens(df, doc_id, text, split)
        .groupBy("token", block_number("doc_id", chunk_docs).alias("chunk"))
        .agg(F.array_sort(F.collect_list("doc_id")).alias("doc_ids"))
    )


def frequency_lists(
    df: DataFrame,
    doc_id: str = "id",
    text: str = "body",
    split: Callable[[Column], Column] = split_trimmed,
    list_ids: int = CHUNK_DOCS,
) -> DataFrame:
    """``token, chunk, doc_ids``: sorted id lists whose borders follow a token's frequency.

    A token of up to ``list_ids`` occurrences has one list. The ids of a more frequent one, from
    its least to its largest, are cut in equal ranges, one for each ``list_ids`` occurrences, but
    never wider than ``MOST_WIDE * list_ids`` ids; so a list of ids that are spread evenly has about
    ``list_ids`` of them, and no list more documents than the widest range. All lists of a
    token, in chunk order, are its full list.

    Occurrences are counted first, combined per task, and no task gets more texts than
    ``TASK_BYTES`` at a time. The ranges of the ``MAX_FREQUENT`` most frequent tokens are sent to
    every task; if more tokens are frequent, the others, of which none has a large share, are listed
    whole and their lists cut. So no token's occurrences meet in one task unless they are few.
    """
    if list_ids < 1:
        raise ValueError("a list must hold at least 1 id")
    tokens = _tokens(_dealt(df, doc_id, text), doc_id, text, split)
    number = F.col("doc_id").cast("bigint")
    counts = tokens.groupBy("token").agg(
        F.count("*").alias("n"), F.min(number).alias("low"), F.max(number).alias("high")
    )
    frequent = counts.where(F.col("n") > list_ids).select(
        F.col("token").alias("f_token"), "low", _width(list_ids).alias("width"), "n"
    )
    found = frequent.orderBy(F.desc("n"), "f_token").limit(MAX_FREQUENT + 1).collect()
    hot = df.sparkSession.createDataFrame(found[:MAX_FREQUENT], frequent.schema).drop("n")
    whole = F.col("width").isNull()
    chunk = F.when(whole, F.lit(0).cast("bigint")).otherwise(
        F.call_function("div", number - F.col("low"), F.col("width"))
    )
    lists = (
        tokens.join(F.broadcast(hot), F.col("token") == F.col("f_token"), "left")
        .groupBy("token", chunk.alias("chunk"), whole.alias("whole"))
        .agg(F.count("*").alias("n"), F.array_sort(F.collect_list("doc_id")).alias("doc_ids"))
    )
    if len(found) > MAX_FREQUENT:
        lists = _cut(lists, list_ids)
    return lists.select("token", "chunk", "doc_ids")


def _width(list_ids: int) -> Column:
    """Ids of a range, from the occurrences ``n`` and the ids ``low`` to ``high`` of a token."""
    pieces = f"((n + {list_ids - 1}) div {list_ids})"
    return F.expr(f"least((high - low + {pieces}) div {pieces}, {MOST_WIDE * list_ids})")


def _cut(lists: DataFrame, list_ids: int) -> DataFrame:
    """``lists`` with the whole ones of more than ``list_ids`` occurrences in ranges.

    As elsewhere, occurrences without an id are a chunk without a number.
    """
    long = F.col("whole") & (F.col("n") > list_ids)
    numbers = F.transform("doc_ids", lambda d: d.cast("bigint"))
    ranged = lists.select(
        "*", F.when(long, F.array_min(numbers)).alias("low"), F.when(long, F.array_max(numbers)).alias("high")
    ).withColumn("width", _width(list_ids))
    entry = F.transform("doc_ids", lambda d: F.struct(
        F.call_function("div", d.cast("bigint") - F.col("low"), F.col("width")).alias("chunk"), d.alias("id")
    ))
    entries = ranged.withColumn("entries", F.when(long, F.array_sort(entry)))
    starts = entries.withColumn("starts", F.array_compact(F.transform("entries", lambda e, i: F.when(
        (i == 0) | (F.get("entries", i - 1)["chunk"] != e["chunk"]), i
    ))))
    cuts = F.transform("starts", lambda s, k: F.struct(
        F.get("entries", s)["chunk"].alias("chunk"),
        F.transform(
            F.slice("entries", s + 1, F.coalesce(F.get("starts", k + 1), F.size("entries")) - s),
            lambda e: e["id"],
        ).alias("doc_ids"),
    ))
    none = F.struct(F.lit(None).cast("bigint").alias("chunk"), F.slice("doc_ids", 1, 0).alias("doc_ids"))
    rest = F.when(F.col("n") > F.size("doc_ids"), F.array(none)).otherwise(F.slice(F.array(none), 1, 0))
    as_is = F.array(F.struct("chunk", "doc_ids"))
    return starts.select("token", F.inline(F.when(long, F.concat(cuts, rest)).otherwise(as_is)))


def _dealt(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The ids and texts in as many tasks as their bytes ask for, if the scan has fewer."""
    rows = df.select(doc_id, text)
    size = F.coalesce(F.sum(F.octet_length(text).cast("bigint")), F.lit(0))
    tasks = -(-rows.agg(size).first()[0] // TASK_BYTES)
    return rows.repartition(tasks, doc_id, text) if tasks > rows.rdd.getNumPartitions() else rows
