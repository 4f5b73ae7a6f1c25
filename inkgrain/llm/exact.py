"""Exact duplicates by a counting Bloom filter in two passes, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgrain.llm.shared import BLANKS, unused, written

#: Bits of the filter per row; three of them are set by each row, all in one 64-bit word.
BITS_PER_ROW = 16
#: The filter is broadcast up to this many bytes (24 a word), else it is joined by shuffle.
BROADCAST_BYTES = 48 << 20


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits_per_row: int = BITS_PER_ROW,
    broadcast_bytes: int = BROADCAST_BYTES,
    row_col: str | None = None,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if they are identical without blanks (space, \\t, \\n, \\v, \\f, \\r). Of equal texts the row with
    the most code points in its original text stays, then the smallest id.

    Pass one puts a hash of every text into a Bloom filter that counts: a bit is kept only if two rows set it. Pass
    two looks every row up; a row that misses a bit is alone and passes through without any shuffle. The few others are
    grouped by SHA-256, so a false positive costs a little time and no result. Rows with the same text are counted on the
    map side; the join back to them has one row a group on its other side, and adaptive execution splits a hot group.

    Null text counts as empty, and all empty texts are equal. A null id never beats another id, and is returned as it is. Rows
    that repeat an id are rows of their own: exactly one row of a group has ``kept``. An empty table gives no rows. Other
    columns are not read; ``row_col`` may name a unique integer to return as ``row``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.translate(text, BLANKS, "")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.length(text).alias("n"),
        F.unhex(F.sha2(bare, 256)).alias("sha"),
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("rid"),
    )
    rows = written(rows, "hashes")

    total = rows.count()
    n_words = 1 << max(0, (total * bits_per_row // 64).bit_length())
    hashed = F.xxhash64("sha")
    word = F.pmod(F.shiftright(hashed, 20), F.lit(n_words))
    places = F.array_distinct(F.array(*[F.shiftright(hashed, 6 * k).bitwiseAND(63).cast("int") for k in range(3)]))
    mask = F.aggregate(places, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)))

    twice = rows.select(word.alias("word"), F.explode(places).alias("bit")).groupBy("word", "bit").count().where("count > 1")
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit")))
    seen = written(twice.groupBy("word").agg(bits.alias("bits")), "filter")
    if seen.count() * 24 <= broadcast_bytes:
        seen = F.broadcast(seen)

    looked = rows.withColumn("word", word).withColumn("mask", mask).join(seen, "word", "left")
    repeated = F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))
    alone = looked.where(~repeated).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha", "rid"
    )
    maybe = looked.where(repeated).select("doc_id", "n", "sha", "rid")
    best = F.max(F.struct("n", F.bitwise_not("doc_id").alias("down_id"), F.bitwise_not("rid").alias("down_rid"), F.col("doc_id").alias("keep_id")))
    groups = written(maybe.groupBy("sha").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")), "groups")
    grouped = maybe.join(groups, "sha").select(
        "doc_id", F.col("best.keep_id").alias("keep_id"), "group_size", (F.col("rid") == F.bitwise_not("best.down_rid")).alias("kept"), "sha", "rid"
    )
    out = alone.unionByName(grouped).withColumn("text_sha256", F.lower(F.hex("sha"))).drop("sha")
    return out.withColumnRenamed("rid", "row") if row_col else out.drop("rid")


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; exactly one row of every group."""
    row = unused(docs, "_row")
    keyed = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    judged = exact_groups(keyed, id_col, text_col, row_col=row)
    gone = judged.where(~F.col("kept")).select(F.col("row").alias(row))
    return keyed.join(gone, row, "left_anti").select(*[keyed[c] for c in docs.columns])
