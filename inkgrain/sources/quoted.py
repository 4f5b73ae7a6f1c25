"""Quoted CSV whose cells may hold line breaks, read by as many tasks as its files have parts."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkgrain.operators.store import write_table

#: Bound of the broadcast table with one row of ROW_BYTES for each part of a file.
BROADCAST_BYTES = 256 << 20
ROW_BYTES = 64
CELL = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
RECORD = re.compile(f"{CELL}(?:,{CELL})*+")
PIECES = "file long, block long, origin long, line long, first boolean, begun boolean, ended boolean, record string, path string"


def checked(record: str, path: str) -> str:
    if '"' in record and not RECORD.fullmatch(record):
        raise ValueError(f"malformed CSV record in {path}: a quote inside an unquoted cell, or one that is never closed: {record[:80]!r}")
    return record


def file_parts(lines: DataFrame) -> DataFrame:
    """One row per part of a file: ``file, block, inside, origin``, written. A file with an odd number of quotes stops the read.

    ``inside``: an odd number of quotes lies before the part, so that it begins within a cell. ``origin``: the part in which that
    record begins. Quotes are counted by all tasks at once; only the running parity, one narrow row a part, goes by file.
    """
    odd = F.pmod(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))), F.lit(2))
    parity = lines.groupBy("file", "block").agg(F.pmod(F.sum(odd), F.lit(2)).alias("odd"), (F.max(odd) == 1).alias("turns"), F.max("path").alias("path"))
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.pmod(F.coalesce(F.sum("odd").over(before), F.lit(0)), F.lit(2)) == 1
    known = parity.select("file", "block", "odd", "path", "turns", inside.alias("inside"))
    begins = F.when(F.col("turns") | ~F.col("inside"), F.col("block"))  # any other part lies within one cell as a whole
    origin = F.last(begins, ignorenulls=True).over(before)
    parts = write_table(known.select("file", "block", "odd", "path", "inside", origin.alias("origin")), "csv-parts")
    bad = parts.groupBy("file").agg(F.max("path").alias("path"), F.sum("odd").alias("n")).where("n % 2 = 1").first()
    if bad:
        raise ValueError(f"malformed CSV: a quote in {bad['path']} is never closed, or stands inside an unquoted cell")
    return parts.drop("odd", "path")


def assemble(batches):
    """Records of the lines of parts of files, as they come; what a part holds of records that cross its ends has ``begun`` or ``ended`` false."""
    at, held, begun, line, first, inside, origin, path = None, [], True, 0, False, False, None, ""
    for batch in batches:
        rows = []

        def put(ended):
            nonlocal held, first
            text = "\n".join(held)
            if ended and text.endswith("\r"):
                text = text[:-1]
            if text or not (begun and ended):
                if begun and ended:
                    checked(text, path)
                rows.append((*at, at[1] if begun else origin, line, first and begun, begun, ended, text, path))
                first = first and not begun
            held = []

        file, block = np.asarray(batch.column("file")), np.asarray(batch.column("block"))
        values = batch.column("value").to_pylist()
        odd = np.asarray(pc.count_substring(batch.column("value"), '"')) % 2
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(values)]):
            if a == b:
                continue
            if at != (int(file[a]), int(block[a])):
                if held:
                    put(False)
                at, line = (int(file[a]), int(block[a])), 0
                inside, origin, path = (batch.column(c)[int(a)].as_py() for c in ("inside", "origin", "path"))
                if inside is None:
                    raise ValueError(f"{path} was split differently by a second read")
                begun, first = not inside, at[1] == 0
            for i in range(int(a), int(b)):
                held.append(values[i])
                inside ^= bool(odd[i])
                if not inside:
                    put(True)
                    begun, line = True, line + 1
        yield batch_of(rows)
    if held:
        last = [(*at, at[1] if begun else origin, line, first and begun, begun, False, "\n".join(held), path)]
        yield batch_of(last)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 4 + [pa.bool_()] * 3 + [pa.string()] * 2
    names = [x.split()[0] for x in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def check_merged(batches):
    for batch in batches:
        for record, path in zip(batch.column("record").to_pylist(), batch.column("path").to_pylist()):
            checked(record, path)
        yield batch


def records(spark: SparkSession, path: str) -> DataFrame:
    """``path, block, line, first, record`` of every record; ``first`` marks the first one of a file.

    Quotes are counted in all parts of all files at once, a running parity of the parts tells which of them begin inside a cell, and every
    part is then cut into records from its first true beginning on. Only records that cross the end of a part are shuffled, one group a
    record. Lines end with \\n or \\r\\n; empty lines are no records. A quote inside an unquoted cell stops the read, as it would
    turn everything after it inside out.
    """
    meta = F.col("_metadata")
    lines = spark.read.text(path, lineSep="\n").select("value", meta["file_path"].alias("path"), F.xxhash64(meta["file_path"]).alias("file"), meta["file_block_start"].alias("block"))
    parts = file_parts(lines)
    if parts.count() * ROW_BYTES > BROADCAST_BYTES:
        raise ValueError("too many parts of files: raise spark.sql.files.maxPartitionBytes")
    crossing = parts.where("inside").select("file", "block", "origin")
    marked = lines.join(F.broadcast(parts), ["file", "block"], "left")
    pieces = marked.mapInArrow(assemble, PIECES)
    out = ["path", "block", "line", "first", "record"]
    whole = pieces.where("begun AND ended").select(*out)
    if crossing.isEmpty():
        return whole
    edges = crossing.select("file", "block").union(crossing.select("file", F.col("origin").alias("block"))).distinct()
    ends = marked.join(F.broadcast(edges), ["file", "block"], "left_semi").mapInArrow(assemble, PIECES).where("NOT (begun AND ended)")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "record"))), lambda x: x["record"]), "\n")
    merged = ends.groupBy("file", F.col("origin").alias("block")).agg(F.max("path").alias("path"), F.max(F.when(F.col("begun"), F.col("line"))).alias("line"), F.max("first").alias("first"), text.alias("record"))
    schema = "path string, block long, line long, first boolean, record string"
    return whole.unionByName(merged.select(*out).mapInArrow(check_merged, schema))


def read_quoted(spark: SparkSession, path: str, schema: T.StructType, options: dict, place_col: str | None = None) -> DataFrame:
    """The rows of CSV files with a header; ``place_col`` adds the place of a row, which sorts by file and line."""
    cells = lambda types: ", ".join(f"`{f.name.replace('`', '``')}` {types(f)}" for f in schema)
    how = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items() if k != "header"} | {"multiLine": "true"}
    found = records(spark, path)
    header = F.from_csv("record", cells(lambda f: "string"), how)
    right = F.lit(True)
    for f in schema:
        right = right & header[f.name].eqNullSafe(F.lit(f.name))
    stop = F.raise_error(F.concat(F.lit("another header in "), F.col("path"), F.lit(": "), F.col("record"))).cast("boolean")
    rows = found.where(F.when(~F.col("first"), F.lit(True)).when(right, F.lit(False)).otherwise(stop))
    place = [F.struct("path", "block", "line").alias(place_col)] if place_col else []
    return rows.select(F.from_csv("record", cells(lambda f: f.dataType.simpleString()), how).alias("_row"), *place).select("_row.*", *place_col and [place_col] or [])
