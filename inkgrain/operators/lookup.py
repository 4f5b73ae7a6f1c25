"""Left join of many rows with a keyed table, whatever the table's size and the key skew."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgrain.operators.store import write_table


@dataclass(frozen=True)
class LookupLimits:
    """How large a broadcast side may be.

    ``broadcast_bytes``: a table below this size is broadcast whole.
    ``hot_keys``: beyond it, rows of this many most frequent keys are dealt to ``salts`` tasks each.
    """

    broadcast_bytes: int = 256 * 1024 * 1024
    hot_keys: int = 4096
    salts: int = 64


def table_bytes(table: DataFrame, key: str) -> int:
    """Estimated in-memory size from the true row count and true payload bytes."""
    payload = F.lit(0).cast("long")
    for field in table.schema.fields:
        kind = field.dataType.typeName()
        if kind == "string":
            payload = payload + F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        elif kind == "array":
            payload = payload + F.greatest(F.size(field.name), F.lit(0)) * 8 + 16
        elif kind == "vectorudt":
            payload = payload + F.size(vector_to_array(field.name)) * 8 + 32
        else:
            payload = payload + 8
    # 64 bytes per row for the row header, the hash slot and padding.
    return table.agg(F.sum(payload + 64)).first()[0] or 0


def frequent_keys(rows: DataFrame, key: str, n: int) -> DataFrame:
    """At most ``n`` keys, the most frequent by a sketch that tracks 16 times as many; written, so that both sides of a join see the same ones."""
    items = F.expr(f"approx_top_k(`{key}`, {n}, {16 * n})")
    return write_table(rows.where(F.col(key).isNotNull()).agg(items.alias("top")).select(F.explode("top.item").alias(key)), "frequent")


def lookup_join(
    rows: DataFrame, table: DataFrame, key: str, limits: LookupLimits = LookupLimits(), size: int | None = None, frequency: str | None = None
) -> DataFrame:
    """``rows`` left-joined with ``table``, whose ``key`` is unique.

    A small table is broadcast, so ``rows`` keep their partitioning. A large one is joined by one shuffle in which ``rows`` are
    expanded once: its most frequent keys, which the table itself knows by its column ``frequency``, are repeated under every salt, and
    their rows are dealt over the salts. Rows without a key are dealt out as well and find nothing. Without ``frequency``, a sketch of
    ``rows`` names the most frequent keys, at the cost of one more pass over them. Every row comes out exactly once in any case.
    """
    size = table_bytes(table, key) if size is None else size
    if size <= limits.broadcast_bytes:
        return rows.join(F.broadcast(table), key, "left")
    top = frequent_keys(rows, key, limits.hot_keys) if frequency is None else table.orderBy(F.desc(frequency), key).limit(limits.hot_keys)
    hot = F.broadcast(top.select(key, F.lit(limits.salts).alias("__salts")))
    dealt = F.pmod(F.xxhash64(*[c for c in rows.columns if c != key]), F.lit(limits.salts)).cast("int")
    marked = rows.join(hot, key, "left").withColumn(
        "__salt", F.when(F.col("__salts").isNotNull() | F.col(key).isNull(), dealt).otherwise(F.lit(0))
    )
    salted = table.join(hot, key, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)))
    return marked.drop("__salts").join(salted.drop("__salts").hint("merge"), [key, "__salt"], "left").drop("__salt")
