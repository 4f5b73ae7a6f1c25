"""CSV scans of labelled and unlabelled texts, and the prediction sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkgrain.sources.quoted import read_quoted

# Quoted fields may hold line breaks, and a quote inside is doubled.
TEXT_OUT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# A cell that does not fit its type stops the read.
QUOTING = {"header": True, "quote": '"', "escape": '"', "mode": "FAILFAST"}


def text_schema(text_col: str = "TEXT", label_col: str | None = None, id_col: str | None = None, id_type: T.DataType = T.StringType()) -> T.StructType:
    fields = []
    if id_col:
        fields.append(T.StructField(id_col, id_type))
    fields.append(T.StructField(text_col, T.StringType()))
    if label_col:
        fields.append(T.StructField(label_col, T.IntegerType()))
    return T.StructType(fields)


def read_labelled(spark: SparkSession, path: str, text_col: str = "TEXT", label_col: str = "LABEL", id_col=None, id_type=T.StringType(), multi_line: bool = True, split: bool = False, place_col: str | None = None) -> DataFrame:
    return _read(spark, path, text_schema(text_col, label_col, id_col, id_type), multi_line, split, place_col)


def read_unlabelled(spark: SparkSession, path: str, text_col: str = "TEXT", id_col=None, id_type=T.StringType(), multi_line: bool = True, split: bool = False, place_col: str | None = None) -> DataFrame:
    return _read(spark, path, text_schema(text_col, id_col=id_col, id_type=id_type), multi_line, split, place_col)


def _columns(spark: SparkSession, path: str) -> list[str]:
    if is_parquet(path):
        return spark.read.parquet(path).columns
    return spark.read.options(**QUOTING, multiLine=True).csv(path).columns


def is_parquet(path: str) -> bool:
    return path.rstrip("/").endswith(".parquet")


def _read(spark: SparkSession, path: str, wanted: T.StructType, multi_line: bool, split: bool, place_col: str | None) -> DataFrame:
    """Read the wanted columns by name; the file may have others, in any order.

    With ``multi_line`` texts may hold line breaks, and a file is read by one task, but with ``split`` by many: its quotes are counted
    first. Without ``multi_line`` files are split at every line. Parquet (a path that ends in .parquet) has no such limit, and keeps the
    types of its columns. ``place_col`` adds the place of a row: file, part, line.
    """
    header = _columns(spark, path)
    missing = [f.name for f in wanted if f.name not in header]
    if missing:
        raise ValueError(f"columns {missing} are not in {path}")
    if is_parquet(path):
        return _placed(spark.read.parquet(path), wanted, place_col)
    types = {f.name: f.dataType for f in wanted}
    schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    if multi_line and split:
        return read_quoted(spark, path, schema, QUOTING, place_col).select(*[f.name for f in wanted], *([place_col] if place_col else []))
    rows = spark.read.options(**QUOTING, multiLine=multi_line, enforceSchema=False).schema(schema).csv(path)
    return _placed(rows, wanted, place_col)


def _placed(rows: DataFrame, wanted: T.StructType, place_col: str | None) -> DataFrame:
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    return rows.select(*[f.name for f in wanted], *([place.alias(place_col)] if place_col else []))


def has_column(spark: SparkSession, path: str, name: str) -> bool:
    return name in _columns(spark, path)


def write_texts(df: DataFrame, path: str) -> None:
    df.write.options(**TEXT_OUT).csv(path)


def write_predictions(df: DataFrame, path: str, id_col: str = "id", label_col: str = "label", mode: str = "error") -> None:
    """Write ``id,label`` with a header, in parallel part files."""
    out = df.select(df[id_col].alias("id"), df[label_col].alias("label"))
    out.write.mode(mode).option("header", True).csv(path)


def read_predictions(spark: SparkSession, path: str, id_type: str = "long", label_type: str = "int") -> DataFrame:
    return spark.read.options(header=True, mode="FAILFAST").schema(f"id {id_type}, label {label_type}").csv(path)
