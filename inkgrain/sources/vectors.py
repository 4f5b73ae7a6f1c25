"""Word-vector tables ``(word string, vector array<float>)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkgrain.sources.wordbin import read_word2vec


def parse_vector_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``word v1 ... vd`` per line.

    A word2vec header is skipped: the line that holds exactly the number of the other lines and their width. Any other line whose
    width differs from the rest is an error when it is read. Empty lines do not count.
    """
    parts = F.split(F.trim(F.col(column)), " +")
    rows = lines.where(F.trim(F.col(column)) != "").select(parts.alias("__parts"))
    width = F.size("__parts") - 1
    total, widest = rows.agg(F.count("*"), F.max(width)).first()
    is_header = (width == 1) & (F.array_join("__parts", " ") == f"{total - 1} {widest}")
    value = F.slice("__parts", F.lit(2), width).cast("array<float>")
    right = F.when(width == F.lit(widest), value).otherwise(F.raise_error(F.concat(F.lit("vector line of another width: "), F.element_at("__parts", 1))).cast("array<float>"))
    return rows.where(~is_header).select(F.element_at("__parts", 1).alias("word"), right.alias("vector"))


def read_vectors(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    if format == "parquet":
        return spark.read.parquet(path).select("word", F.col("vector").cast("array<float>").alias("vector"))
    if format == "text":
        return parse_vector_lines(spark.read.text(path))
    if format == "word2vec":
        return read_word2vec(spark, path)
    raise ValueError(f"unknown vector format {format!r}: use 'parquet', 'text' or 'word2vec'")
