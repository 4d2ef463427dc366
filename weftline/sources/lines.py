"""Text lines: plain scan, line numbers, blocks of N lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.functions.blocks import block_number

_MAX_SPLIT_ROWS = 50_000


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(paths)


def read_ordered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines with a ``position`` that sorts them by file and place in the file."""
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("mid"),
    )
    return spark.read.text(paths).select("value", position.alias("position"))


def number_lines(
    spark: SparkSession, paths: str | Sequence[str], index: str | None = None
) -> DataFrame:
    """Lines with ``file``, ``line_no`` (0-based in the file) and ``value``.

    Splits are read in parallel. Each split counts its lines, the counts of a
    file are summed up over its splits, and a line's number is that base plus
    its position in the split. No file goes through a single task.

    The text is scanned twice, once to count: text files have no index of lines. The
    first scan runs when this is called; its result, one row per split, is kept if there
    are at most ``_MAX_SPLIT_ROWS``, else it is computed again and joined by a shuffle.

    With ``index``, a folder, the counts are stored there, with the lengths and modification times
    of the files and the settings that say how files are split. A later call with the same
    files and settings takes them from there and scans the text once. If anything differs, lines
    are counted and stored again. A file that changes between the call and the scan, so that a
    line has no place among the counted ones, stops the job.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_block_length").alias("block_length"),
        F.monotonically_increasing_id().alias("mid"),
        "value",
    )
    split = ["file", "block_start", "block_length"]
    earlier = (
        W.partitionBy("file")
        .orderBy("block_start")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    splits = (
        lines.groupBy(*split)
        .agg(F.count("*").alias("n"), F.min("mid").alias("first_mid"))
        .withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    )
    if index is not None:
        splits = _indexed_splits(spark, paths, splits, index)
    found = splits.limit(_MAX_SPLIT_ROWS + 1).collect()
    if len(found) <= _MAX_SPLIT_ROWS:
        splits = F.broadcast(spark.createDataFrame(found, splits.schema))
    place = F.col("mid") - F.col("first_mid")
    counted = (place >= 0) & (place < F.col("n"))
    # A line without its split, or beyond its end, would mean that the two scans differ.
    lost = F.raise_error(F.concat(F.lit("no line count for a split of "), F.col("file")))
    return lines.join(splits, split, "left").select(
        "file",
        F.when(counted, F.col("base") + place).otherwise(lost.cast("bigint")).alias("line_no"),
        "value",
    )


def _indexed_splits(
    spark: SparkSession, paths: str | Sequence[str], splits: DataFrame, index: str
) -> DataFrame:
    """The stored splits if files and settings are those they were counted for, else new ones, stored.

    Files are listed, not read, to see whether they changed.
    """
    tasks = str(spark.sparkContext.defaultParallelism)
    settings = ",".join([
        *(spark.conf.get(f"spark.sql.files.{name}") for name in ("maxPartitionBytes", "openCostInBytes")),
        spark.conf.get("spark.sql.files.minPartitionNum", tasks),
        tasks,
    ])
    files = spark.read.format("binaryFile").load(paths).select(
        F.col("path").alias("f_path"), "length", "modificationTime", F.lit(settings).alias("settings")
    )
    known = ["f_path", "length", "modificationTime", "settings"]
    try:
        stored = spark.read.parquet(f"{index}/files"), spark.read.parquet(f"{index}/splits")
        same = files.exceptAll(stored[0]).isEmpty() and stored[0].exceptAll(files).isEmpty()
    except AnalysisException:
        same = False
    if not same:
        # Splits first: files without their splits would be taken for whole.
        spark.createDataFrame([], files.schema).write.mode("overwrite").parquet(f"{index}/files")
        splits.write.mode("overwrite").parquet(f"{index}/splits")
        files.select(*known).write.mode("overwrite").parquet(f"{index}/files")
    return spark.read.parquet(f"{index}/splits")


def blocks_of_rows(
    df: DataFrame, n: int, *, order: str, line: str, within: Sequence[str] = ()
) -> DataFrame:
    """Join each run of ``n`` rows to one record, every line ended by a newline.

    ``order`` numbers the rows densely (from 0, per ``within`` group). The key of
    a record is the ``order`` value of its first row; a short last block is kept. A
    NULL line counts as an empty one.
    A group never holds more than ``n`` rows.
    """
    return (
        df.groupBy(*within, block_number(order, n).alias("block"))
        .agg(
            F.min(order).alias("first_line"),
            F.array_sort(
                F.collect_list(F.struct(F.col(order).alias("o"), F.col(line).alias("v")))
            ).alias("rows"),
        )
        .select(
            *within,
            "first_line",
            F.concat(F.array_join(F.col("rows.v"), "\n", ""), F.lit("\n")).alias("record"),
        )
    )


def n_line_records(
    spark: SparkSession, paths: str | Sequence[str], n: int = 1, index: str | None = None
) -> DataFrame:
    """Blocks of ``n`` consecutive lines; a block never crosses files.

    ``index`` as in :func:`number_lines`.
    """
    numbered = number_lines(spark, paths, index)
    return blocks_of_rows(numbered, n, order="line_no", line="value", within=["file"])
