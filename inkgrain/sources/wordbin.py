"""Word vectors in word2vec's binary format, read by as many tasks as the files have parts.

A file is ``words width\\n`` and then, for each word, its bytes, a blank, ``width`` little-endian floats and mostly a line feed. Records differ in
length and floats may hold blanks, so a part cannot tell alone where its first record begins. It can tell where the records would lead for each place at which
the first could begin: these chains soon fall into few, and one row a part joins them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkgrain.operators.store import write_table

#: Bound of the broadcast table with one row of ROW_BYTES for each part of a file.
BROADCAST_BYTES = 256 << 20
ROW_BYTES = 96
#: The first line is at most this long.
HEADER_BYTES = 64


def heads(batches):
    """``file, words, width, begin`` of each file, from its first two pieces between blanks."""
    file, found = None, []
    for batch in batches:
        for f, path, value in zip(*(batch.column(c).to_pylist() for c in ("file", "path", "value"))):
            if f != file:
                file, found = f, []
            found.append(value[: HEADER_BYTES + 1])
            if len(found) == 2:
                width, end, _ = found[1].partition(b"\n")
                if not (found[0].isdigit() and width.strip().isdigit() and int(width) and end) or len(found[0]) + len(width) > HEADER_BYTES - 2:
                    raise ValueError(f"no word2vec header in {path}")
                row = [f, int(found[0]), int(width), len(found[0]) + len(width) + 2]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], ["file", "words", "width", "begin"])


def blocks_of(batch: pa.RecordBatch):
    """``(file, block), first row, end`` of the stretches of one part of a file."""
    file, block = np.asarray(batch.column("file")), np.asarray(batch.column("block"))
    cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(file)]):
        if a < b:
            yield (int(file[a]), int(block[a])), a, b


def chains(ends: np.ndarray, step: int, limit: int) -> tuple[list[int], list[int], list[int]]:
    """For records that begin at up to ``limit``: ``upto`` (a blank), and for beginnings up to it ``leave``, where the first record after the part begins, counted from
    the end of the part, and ``count``, the records that begin in it. ``ends`` are the places of the blanks; the last one ends the part."""
    size = int(ends[-1]) + 1
    after = np.searchsorted(ends, ends + step)
    known: dict[int, tuple[int, int]] = {}
    starts = range(min(len(ends), int(np.searchsorted(ends, limit)) + 1))
    for i in starts:
        way = []
        while i < len(ends) and i not in known:
            way.append(i)
            i = int(after[i])
        leave, count = known[i] if i < len(ends) else (int(ends[way[-1]]) + step - size, 0)
        for j in reversed(way):
            count += 1
            known[j] = (leave, count)
    return [int(ends[i]) for i in starts], [known[i][0] for i in starts], [known[i][1] for i in starts]


def scan(width: int):
    def run(batches):
        at, held, path, size = None, [], "", 0

        def row():
            ends = np.cumsum(np.concatenate(held) + 1) - 1
            lists = chains(ends, 1 + 4 * width, 4 * width + HEADER_BYTES)
            columns = [pa.array([x], pa.int64()) for x in (*at, int(ends[-1]) + 1, size)] + [pa.array([path])] + [pa.array([x], pa.list_(pa.int64())) for x in lists]
            return pa.RecordBatch.from_arrays(columns, ["file", "block", "bytes", "size", "path", "upto", "leave", "count"])

        for batch in batches:
            n = np.asarray(batch.column("n")).astype(np.int64)
            for key, a, b in blocks_of(batch):
                if key != at:
                    if held:
                        yield row()
                    at, held, path, size = key, [], batch.column("path")[a].as_py(), batch.column("size")[a].as_py()
                held.append(n[a:b])
        if held:
            yield row()

    return run


def follow(parts: pd.DataFrame) -> pd.DataFrame:
    """Where the first record of each part of one file begins, and its number."""
    parts = parts.sort_values("block")
    entry, index, base = int(parts["begin"].iloc[0]), 0, 0
    out = []
    for r in parts.itertuples():
        out.append((r.file, r.block, entry, index, base, r.words, r.size))
        i = int(np.searchsorted(r.upto, entry))
        if i < len(r.upto):
            entry, index = int(r.leave[i]), index + int(r.count[i])
        else:
            entry -= r.bytes
        base += r.bytes
    if index < parts["words"].iloc[0]:
        raise ValueError(f"{parts['path'].iloc[0]} is cut off: {index} of {parts['words'].iloc[0]} words")
    return pd.DataFrame(out, columns=["file", "block", "entry", "index", "base", "words", "size"])


def cut(width: int):
    """``file, index, block, whole, raw``: the records of each part, and what it holds of those that cross its ends."""

    def run(batches):
        at, buffer, entry, index, place, words, size, begun, path = None, bytearray(), 0, 0, 0, 0, 0, False, ""
        rows: list[tuple] = []

        def put(number, whole, raw, end=0):
            if 0 <= number < words:
                if end > size:
                    raise ValueError(f"{path} is cut off in word {number}")
                rows.append((at[0], number, at[1], whole, bytes(raw)))

        def drain(last):
            nonlocal index, place, begun
            pos = 0
            if not begun:
                if len(buffer) < entry:
                    if last:
                        put(index - 1, False, buffer)
                    return
                if entry:
                    put(index - 1, False, buffer[:entry], place + entry)
                begun, pos = True, entry
            while (k := buffer.find(b" ", pos)) >= 0 and k + 1 + 4 * width <= len(buffer):
                end = k + 1 + 4 * width
                put(index, True, buffer[pos:end], place + end)
                index, pos = index + 1, end
            del buffer[:pos]
            place += pos
            if last and buffer:
                put(index, False, buffer, place + len(buffer) + 1)  # nothing follows the last part of a file

        def batch_of():
            types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["file", "index", "block", "whole", "raw"])

        for batch in batches:
            rows = []
            values = batch.column("value").to_pylist()
            for key, a, b in blocks_of(batch):
                if key != at:
                    if at is not None:
                        drain(True)
                    path, entry, index, place, words, size = (batch.column(c)[a].as_py() for c in ("path", "entry", "index", "base", "words", "size"))
                    if entry is None:
                        raise ValueError(f"{path} was split differently by a second read")
                    at, buffer, begun = key, bytearray(), False
                buffer += b" ".join(values[a:b]) + b" "
                drain(False)
            yield batch_of()
        rows = []
        if at is not None:
            drain(True)
            yield batch_of()

    return run


def parse(width: int):
    def run(batches):
        for batch in batches:
            words, numbers = [], []
            for raw in batch.column("raw").to_pylist():
                k = raw.find(b" ")
                if k < 0 or len(raw) < k + 1 + 4 * width:
                    raise ValueError(f"a vector file is cut off at {raw[:k if k >= 0 else 80]!r}")
                words.append(raw[:k].lstrip(b"\n").decode("utf-8", "replace"))
                numbers.append(np.frombuffer(raw, dtype="<f4", count=width, offset=k + 1))
            flat = np.concatenate(numbers).astype(np.float32) if numbers else np.empty(0, dtype=np.float32)
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1) * width, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), vectors], ["word", "vector"])

    return run


def read_word2vec(spark: SparkSession, path: str) -> DataFrame:
    """``word, vector`` of binary word2vec files, all of one width.

    Every part of every file is read on its own, twice; only records that cross the end of a part are shuffled, for which the files are read once
    more. Bytes of a word that are no UTF-8 become the replacement character. A file without a header, or with fewer words than it names, stops the read;
    what follows the last word is not looked at.
    """
    meta = F.col("_metadata")
    place = [meta["file_path"].alias("path"), F.xxhash64(meta["file_path"]).alias("file"), meta["file_block_start"].alias("block")]
    pieces = spark.read.text(path, lineSep=" ").select(F.col("value").cast("binary").alias("value"), *place, meta["file_size"].alias("size"))
    known = write_table(pieces.where("block = 0").select("file", "path", "value").mapInArrow(heads, "file long, words long, width long, begin long"), "vector-heads")
    narrow, width, files = known.agg(F.min("width"), F.max("width"), F.count("*")).first()
    if not files:
        raise ValueError(f"no word2vec header in {path}")
    if narrow != width:
        raise ValueError(f"vector files of {narrow} to {width} dimensions")
    lengths = pieces.select("file", "block", "path", "size", F.octet_length("value").alias("n"))
    parts = lengths.mapInArrow(scan(width), "file long, block long, bytes long, size long, path string, upto array<long>, leave array<long>, count array<long>")
    parts = parts.join(known, "file", "left").groupBy("file").applyInPandas(follow, "file long, block long, entry long, index long, base long, words long, size long")
    parts = write_table(parts, "vector-parts")
    n = parts.count()
    if n * ROW_BYTES > BROADCAST_BYTES:
        raise ValueError("too many parts of files: raise spark.sql.files.maxPartitionBytes")
    records = pieces.drop("size").join(F.broadcast(parts), ["file", "block"], "left").mapInArrow(cut(width), "file long, index long, block long, whole boolean, raw binary")
    whole = records.where("whole").select("raw")
    if n > files:
        joined = F.expr("aggregate(sort_array(collect_list(struct(block, raw))), X'', (a, x) -> concat(a, x.raw))")
        whole = whole.unionByName(records.where("NOT whole").groupBy("file", "index").agg(joined.alias("raw")).select("raw"))
    return whole.mapInArrow(parse(width), "word string, vector array<float>")


def write_word2vec(vectors: DataFrame, path: str, files: int = 1) -> None:
    """Write ``word, vector`` as ``files`` binary files, each with its header. Words hold no blank; vectors are of one width."""
    rows = write_table(vectors.select("word", "vector", F.pmod(F.xxhash64("word"), F.lit(files)).alias("part")), "vector-rows")
    narrow, width, blank = rows.agg(F.min(F.size("vector")), F.max(F.size("vector")), F.max(F.contains("word", F.lit(" ")) | F.col("word").isNull())).first()
    if narrow != width or blank:
        raise ValueError("vectors need one width, and words without blanks")

    def pack(batches):
        for batch in batches:
            numbers = [np.asarray(v, dtype="<f4").tobytes() for v in batch.column("vector").to_pylist()]
            raw = [w.encode() + b" " + v for w, v in zip(batch.column("word").to_pylist(), numbers)]
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array([1] * len(raw), pa.int32()), pa.array(raw, pa.binary())], ["part", "order", "raw"])

    header = rows.groupBy("part").count().select("part", F.lit(0).alias("order"), F.concat("count", F.lit(f" {width}")).cast("binary").alias("raw"))
    lines = header.unionByName(rows.mapInArrow(pack, "part long, order int, raw binary"))
    lines = lines.repartition(files, "part").sortWithinPartitions("part", "order")
    lines.select("part", F.col("raw").cast("string").alias("value")).write.partitionBy("part").text(path)
