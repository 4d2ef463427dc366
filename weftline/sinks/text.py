"""Text and binned outputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.render import tab_line

#: Bins of one output, at most.
MAX_BINS = 1000


def write_lines(df: DataFrame, path: str, *columns: str, mode: str = "overwrite") -> None:
    """Tab-separated text lines of the given columns (all if none), one file per task.

    Values are written as they are: one with a newline takes several lines.
    """
    line = tab_line(*(columns or df.columns))
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_sorted_lines(
    df: DataFrame, path: str, sort_by: str, *columns: str, mode: str = "overwrite"
) -> None:
    """As :func:`write_lines`, the files in order of ``sort_by`` over all of them.

    Rows equal in ``sort_by`` are ordered by the other columns, and copies by the
    task they come from, so that no group of equal rows has to fit one file.
    """
    columns = columns or tuple(df.columns)
    rest = [c for c in columns if c != sort_by]
    ordered = df.orderBy(sort_by, *rest, F.spark_partition_id())
    ordered.select(tab_line(*columns).alias("value")).write.mode(mode).text(path)


def write_binned(
    df: DataFrame,
    path: str,
    *,
    bin_column: str = "bin",
    bins: Sequence | None = None,
    mode: str = "overwrite",
) -> DataFrame:
    """One directory of text lines per bin; returns ``bin, cnt`` of the rows written to each.

    As :func:`write_counted`, of which ``bins`` is looked up by a pass over the bin column if it is
    not given.
    """
    if bins is None:
        found = df.select(bin_column).distinct().limit(MAX_BINS + 1).collect()
        bins = [r[0] for r in found]
    return write_counted(df, path, bins, bin_column=bin_column, mode=mode)[0]


def write_counted(
    df: DataFrame,
    path: str,
    bins: Sequence,
    totals: Mapping[str, Column] | None = None,
    *,
    bin_column: str = "bin",
    mode: str = "overwrite",
) -> tuple[DataFrame, dict]:
    """Writes the bins and counts them in the same pass; ``bin, cnt`` and the ``totals``.

    The counts, and the aggregates in ``totals``, are observed on the rows as they are written: a
    newline in a value counts once, an attempt that fails counts nothing, and a bin keeps its
    type. Bins without a row are left out. A row of another bin stops the job.
    """
    if len(bins) > MAX_BINS:
        raise ValueError(f"{len(bins)} bins, of which each task has a file open, are over {MAX_BINS}")
    spark, column = df.sparkSession, F.col(bin_column)
    known = reduce(Column.__or__, [column.eqNullSafe(b) for b in bins], F.lit(False))
    other = F.raise_error(F.concat(F.lit("no such bin: "), column.cast("string")))
    lines = df.withColumn(bin_column, F.when(known, column).otherwise(other.cast(df.schema[bin_column].dataType)))
    seen = Observation()
    counts = [F.count_if(column.eqNullSafe(b)).alias(f"bin_{i}") for i, b in enumerate(bins)]
    named = [total.alias(f"total_{name}") for name, total in (totals or {}).items()]
    columns = [c for c in df.columns if c != bin_column]
    observed = lines.observe(seen, F.count("*").alias("rows"), *counts, *named)
    observed.select(bin_column, tab_line(*columns).alias("value")).write.mode(mode).partitionBy(
        bin_column
    ).text(path)
    found = seen.get
    rows = [(b, found[f"bin_{i}"]) for i, b in enumerate(bins) if found[f"bin_{i}"]]
    schema = T.StructType([df.schema[bin_column], T.StructField("cnt", T.LongType())])
    return spark.createDataFrame(rows, schema), {n: found[f"total_{n}"] for n in totals or {}}
