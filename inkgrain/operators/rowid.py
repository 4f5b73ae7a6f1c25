"""Dense row numbers 0..n-1 without gathering the rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkgrain.operators.store import write_table


def dense_row_id(df: DataFrame, id_col: str = "id", order_by=None) -> DataFrame:
    """Append ``id_col``: the position in the files (by path, then place), or in the order of ``order_by``.

    Rows are range-partitioned by the key and sorted inside each partition, numbered there,
    and shifted by the number of rows in the partitions before. Equal keys are told apart
    by their place in the scan, so that a very common key fills several partitions. Both
    kinds of marks are written before they are used: recomputed, they might differ.
    """
    mark = F.monotonically_increasing_id()
    if order_by is not None:
        keys = [order_by] if isinstance(order_by, str) else list(order_by)
        keys.append("__tie")
        df = write_table(df.withColumn("__tie", mark), "rowid")
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tie")
        df = df.select("*", F.lit("").alias("__file"), F.spark_partition_id().cast("long").alias("__block"))
    else:
        df = with_place(df)
    # Rows of one part of a file are read by one task, one after the other.
    numbered = write_table(df.withColumn("__mark", mark), "rowid")
    sizes = numbered.groupBy("__file", "__block").agg(F.count("*").alias("__n"), F.min("__mark").alias("__first"))
    # One row per part of a file, so the running total is small.
    before = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__file", "__block", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    rows = numbered.join(starts, ["__file", "__block"])
    return rows.withColumn(id_col, F.col("__start") + F.col("__mark") - F.col("__first")).drop("__file", "__block", "__mark", "__first", "__start")


def with_place(df: DataFrame) -> DataFrame:
    """Append the file of a row and where its part begins; a table that is not read from files has its partitions instead."""
    try:
        return df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"))
    except AnalysisException:
        return df.select("*", F.lit("").alias("__file"), F.spark_partition_id().cast("long").alias("__block"))


def id_faults(df: DataFrame, id_col: str) -> tuple[int, int]:
    """How many ids are null (0 or 1), and how many others name two rows or more."""
    per_id = df.groupBy(id_col).agg(F.count("*").alias("n"))
    return tuple(per_id.agg(F.count_if(F.col(id_col).isNull()), F.count_if(F.col(id_col).isNotNull() & (F.col("n") > 1))).first())


def require_unique(df: DataFrame, id_col: str) -> None:
    """Raise if an id is null or names two rows: features are joined by id and would mix their texts."""
    nulls, repeated = id_faults(df, id_col)
    if nulls or repeated:
        raise ValueError(f"{id_col} has {'nulls' if nulls else f'{repeated} repeated values'}; dense_row_id makes a key")
