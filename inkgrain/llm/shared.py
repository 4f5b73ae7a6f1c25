"""Helpers of this package: the shared folder, written intermediate tables, code for the executors."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"

#: A task that writes a table holds one group of rows in memory.
ROW_GROUP_BYTES = 32 << 20

_own = {}
#: Paths of the tables written inside each open :func:`collected`.
_collecting: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; only a single-machine session may leave it unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="inkgrain-")
    return _own[app]


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` as a Parquet table in the shared folder: it cuts lineage and survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/inkgrain-llm/{uuid.uuid4().hex}/{name}"
    for paths in _collecting:
        paths.append(path)
    df.write.option("compression", codec).option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``df`` as a Parquet table whose files are dealt by a hash of ``key``, so that joins on it move the other side alone.

    The files lie in the shared folder; the name that the catalogue needs is dropped at once.
    """
    path = f"{shared_folder(df.sparkSession)}/inkgrain-llm/{uuid.uuid4().hex}/{name}"
    for paths in _collecting:
        paths.append(path)
    entry = f"inkgrain_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.format("parquet").option("compression", "zstd").option("parquet.block.size", str(ROW_GROUP_BYTES))
    writer.option("path", path).bucketBy(buckets, key).saveAsTable(entry)
    out = df.sparkSession.table(entry)
    out.schema  # resolved before the name goes
    df.sparkSession.sql(f"DROP TABLE {entry}")
    return out


@contextmanager
def collected():
    """The list of all tables that :func:`written` makes inside."""
    paths: list[str] = []
    _collecting.append(paths)
    try:
        yield paths
    finally:
        _collecting.remove(paths)


def drop_unread(paths: list[str], reader: DataFrame) -> list[str]:
    """Delete the tables that ``reader`` does not read; returns those that stay."""
    files = reader.inputFiles()
    stay = [p for p in paths if any(p.split("/inkgrain-llm/")[-1] in f for f in files)]
    sc = reader.sparkSession.sparkContext
    for path in set(paths) - set(stay):
        place = sc._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)
    return stay


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, so that they need no copy of the repository."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")  # texts can be long
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    sc = spark.sparkContext
    if getattr(sc, "_inkgrain_shipped", False):
        return
    top = Path(__file__).resolve().parent.parent
    files = sorted(p for p in top.rglob("*.py"))
    digest = hashlib.md5(b"".join(p.read_bytes() for p in files)).hexdigest()[:12]
    target = os.path.join(tempfile.mkdtemp(prefix="inkgrain-code-"), f"inkgrain-{digest}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in files:
            z.write(p, p.relative_to(top.parent).as_posix())
    sc.addPyFile(target)
    sc._inkgrain_shipped = True


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bucket(column, modulus: int):
    """crc32 of the decimal id, mod ``modulus``; null ids give null."""
    return F.crc32(column.cast("string").cast("binary")) % modulus
