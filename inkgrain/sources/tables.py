"""Scans of Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


SPREAD_BYTES_PER_CORE = 32 * 1024 * 1024


UNKNOWN_BYTES = 1 << 62


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` reads, as stored; nothing runs for it. Rows that come from no table have no known
    size (the optimizer gives them its largest number) and do not count."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(n for n in sizes if n < UNKNOWN_BYTES)


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a small input.

    Text features cost far more than reading, and a small file is read by one task. An
    input with more than 32 MB per core is left as it is split.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * 2) if scanned_bytes(df) < cores * SPREAD_BYTES_PER_CORE else df
