"""Pack documents into sequences of tokens along a Hilbert curve through hashed document vectors."""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkgrain.llm.shared import ship, written

LENGTH = 1024
END_ID = 0
SPECIAL = "<|endoftext|>"
#: Features of a document vector, dimensions it is projected to, bits of each on the curve.
FEATURES, DIMENSIONS, BITS = 64, 4, 10
SPREAD_BITS = 22

_encoders: dict[str, object] = {}


def encoder(path: str):
    """The byte-level vocabulary at ``path`` (.tiktoken ranks), as the library that reads it fastest.

    Gives the ids of the same vocabulary's .json in the tokenizers library; the tests compare them.
    """
    if path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)})
    return _encoders[path]


def whole_library(path: str):
    """The same vocabulary's .json, beside the ranks, in the tokenizers library."""
    if path + ".json" not in _encoders:
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path.removesuffix(".tiktoken") + ".json")
        library.no_truncation()
        library.no_padding()
        _encoders[path + ".json"] = library
    return _encoders[path + ".json"]


def token_ids(text: str | None, path: str) -> np.ndarray:
    """Ids of a whole text; the special token's string in a text is that token, as in the tokenizers library."""
    enc = encoder(path)
    if not text:
        return np.empty(0, dtype=np.uint32)
    try:
        return np.asarray(enc.encode_to_numpy(text, allowed_special="all"), dtype=np.uint32)
    except (ValueError, RuntimeError):  # its pattern matcher gives up on very long runs of blanks
        return np.asarray(whole_library(path).encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of non-negative integers below 2**bits (transposed form, then interleaved)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[n - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def projection(vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature and sign of every id, and the projection of features to dimensions."""
    rng = np.random.default_rng(17)
    return rng.integers(0, FEATURES, vocabulary), rng.choice([-1.0, 1.0], vocabulary), rng.normal(0, 1, (FEATURES, DIMENSIONS))


def curve_keys(ids: list[np.ndarray], tables) -> np.ndarray:
    feature, sign, project = tables
    vectors = np.stack([np.bincount(feature[x], sign[x], FEATURES) for x in ids]) if ids else np.zeros((0, FEATURES))
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    flat = (vectors / np.where(norm == 0, 1, norm)) @ project
    cell = np.clip((flat + 3) / 6 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
    return hilbert(cell)


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids (binary, little-endian uint32), doc_tokens, sequence_id, offset``.

    Every document is its ids and then id 0. Documents are ordered along a Hilbert curve through their hashed vectors (copies
    and texts of one kind become neighbours), and the sequence of all ids is cut every ``length`` ids, so that every
    sequence but the last is full.

    Texts are encoded once, into a written table. Only (key, row, number of ids) is range-sorted; the key has hash bits of the row
    below the curve's, so equal documents split over partitions. Running totals add up inside partitions, plus one row
    per earlier partition. The ids then join their places by row.

    Null and empty texts are one piece with id 0 alone. Repeated and null ids get pieces of their own row. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    id_type = dict(kept.dtypes)["doc_id"]

    def encode(batches):
        tables = projection(encoder(vocabulary).n_vocab)
        for batch in batches:
            ids = [token_ids(t, vocabulary) for t in batch.column("_text").to_pylist()]
            keys = curve_keys(ids, tables)
            packed = [np.append(x, END_ID).astype("<u2" if encoder(vocabulary).n_vocab <= 1 << 16 else "<u4").tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.int64()), pa.array([len(x) + 1 for x in ids], pa.int64()), pa.array(packed, pa.binary())],
                ["doc_id", "curve", "n", "packed"],
            )

    coded = kept.mapInArrow(encode, f"doc_id {id_type}, curve long, n long, packed binary")
    coded = written(coded.withColumn("rid", F.monotonically_increasing_id()), "tokens", "lz4")
    key = F.shiftleft("curve", SPREAD_BITS).bitwiseOR(F.pmod(F.xxhash64("rid"), F.lit(1 << SPREAD_BITS)))
    order = coded.select(key.alias("key"), "rid", "n").repartitionByRange("key", "rid").withColumn("part", F.spark_partition_id())
    order = written(order, "order")
    sums = order.groupBy("part").agg(F.sum("n").alias("sum"))
    base = sums.select("part", F.coalesce(F.sum("sum").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("key", "rid").rowsBetween(Window.unboundedPreceding, -1)
    places = order.withColumn("at", F.coalesce(F.sum("n").over(within), F.lit(0))).join(F.broadcast(base), "part")
    places = places.select("rid", (F.col("base") + F.col("at")).alias("place"))

    def cut(batches):
        for batch in batches:
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            rid, start, size, ids, total, seq, off = [], [], [], [], [], [], []
            for i, (raw, n, place) in enumerate(zip(batch.column("packed").to_pylist(), batch.column("n").to_pylist(), batch.column("place").to_pylist())):
                values = np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                at = 0
                while at < n:
                    seq_id, offset = divmod(place + at, length)
                    take = min(n - at, length - offset)
                    rid.append(i)
                    start.append(at)
                    size.append(take)
                    ids.append(values[at : at + take].tobytes())
                    total.append(n)
                    seq.append(seq_id)
                    off.append(offset)
                    at += take
            longs = [pa.array(x, pa.int64()) for x in (start, size, total, seq, off)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rid, pa.int32())), longs[0], longs[1], pa.array(ids, pa.binary()), *longs[2:]], names)

    joined = coded.select("rid", "doc_id", "n", "packed").join(places, "rid").select("doc_id", "n", "packed", "place")
    return joined.mapInArrow(cut, f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the crc32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def check_crc(ids: list[int]) -> int:
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())
