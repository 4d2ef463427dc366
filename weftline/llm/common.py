"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import math
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest side that an operator marks for broadcast, after measuring it: rows, and bytes as JSON.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 32 << 20

_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A session without it, as in tests, gets a folder of its own if driver and executors are one
    process; elsewhere a missing setting is an error, since a machine's own folder would lose
    files. No setting is changed. What operators write below it stays after them, as results
    may be read at any time: the folder is the caller's to empty.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = "file://" + tempfile.mkdtemp(prefix="weftline-")
    return _own_folders[application]


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it.

    On a cluster without that path the package comes with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))
    return spark


def saved(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder; cuts lineage, survives lost executors.

    With ``tasks``, see ``tasks_for``, the last stage runs in at most so many, each of which
    writes a file: on a local disk Hadoop starts two processes for each file, in a store it is a request.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return (df.coalesce(tasks) if tasks else df).checkpoint()


def tasks_for(spark: SparkSession, rows: int, a_task: int) -> int:
    """A task for each ``a_task`` of the rows, but at least two a core."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-rows // a_task))


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def broadcast_if_few(
    df: DataFrame, rows: int = MAX_BROADCAST_ROWS, size: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """``df`` marked for broadcast if one job finds at most ``rows`` rows of ``size`` bytes in all."""
    width = F.coalesce(F.octet_length(F.to_json(F.struct("*"))), F.lit(0)).cast("bigint")
    found = df.limit(rows + 1).select(width.alias("width")).agg(
        F.count("*"), F.coalesce(F.sum("width"), F.lit(0))
    ).first()
    return F.broadcast(df) if found[0] <= rows and found[1] <= size else df


def freeing(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``; after its last batch the worker gives unused memory back.

    Workers live on between tasks, and allocators keep what a task has freed.
    """
    def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        # Only the C library of GNU has it.
        getattr(ctypes.CDLL(None), "malloc_trim", int)(0)

    return freed


def text_of(name: str) -> Column:
    """The text column, null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores after it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def replaced_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    """The batch with ``values`` as its last column, in place of one of that name."""
    kept = [n for n in batch.schema.names if n != name]
    columns = [batch.column(batch.schema.get_field_index(n)) for n in kept]
    return pa.RecordBatch.from_arrays([*columns, values], [*kept, name])


def cut_points(df: DataFrame, key: str, parts: int) -> list:
    """Ascending distinct values that cut ``key`` into at most ``parts`` ranges.

    Approximate quantiles from a sketch that tasks combine; at most ``parts - 1``
    values come back.
    """
    if parts <= 1:
        return []
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(key, shares, max(10_000, 10 * parts))).first()[0]
    return sorted(set(found or []))


def range_number(key: Column, cuts: list) -> Column:
    """How many of ``cuts`` are at most ``key``, in about ``2 * sqrt(len(cuts))`` steps."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts) - 1) + 1
    heads = F.array(*[F.lit(c) for c in cuts[::step]])
    blocks = F.array(*[
        F.array(*[F.lit(c) for c in cuts[i:i + step]]) for i in range(0, len(cuts), step)
    ])
    outer = F.size(F.filter(heads, lambda c: c <= key))
    inner = F.size(F.filter(F.element_at(blocks, outer), lambda c: c <= key))
    return F.when(outer == 0, F.lit(0)).otherwise((outer - 1) * step + inner)
