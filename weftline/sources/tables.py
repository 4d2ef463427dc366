"""Table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Widen a scan that has far fewer tasks than the cluster has cores.

    A file of one row group is one task however large the work on its rows is.
    Inputs that keep half the cores busy pass through without a shuffle. ``keys`` should
    be unique per row, so that no key can make one partition large.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if 2 * df.rdd.getNumPartitions() > cores:
        return df
    return df.repartition(cores, *keys)
