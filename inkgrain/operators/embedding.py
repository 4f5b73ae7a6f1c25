"""Mean-pooled word vectors per text."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkgrain.functions.text import clean_text
from inkgrain.functions.tokens import embedding_tokens
from inkgrain.operators.batches import pooled_column, pooled_sums, split_repeats
from inkgrain.operators.lookup import LookupLimits, lookup_join, table_bytes
from inkgrain.operators.terms import by_id

#: Passes over the texts that a table of vectors may take.
MOST_BLOCKS = 8


def pooled_vectors(
    texts: DataFrame,
    id_col: str,
    text_col: str,
    vectors: DataFrame,
    dim: int,
    limits: LookupLimits = LookupLimits(),
    size: int | None = None,
) -> DataFrame:
    """``(id, features)``: mean vector of the known tokens with repeats, zeros if none is known.

    Tables of up to ``MOST_BLOCKS`` times the broadcast limit are sent to the tasks in blocks of words, one pass over the texts each: a text
    then gives one row of sums a block, and no vector is shuffled. Beyond that, and for rows of repeated ids, tokens are counted and joined.
    """
    size = table_bytes(vectors, "word") if size is None else size
    # a task holds floats, half of what the estimate counts
    blocks = -(-size // max(2 * limits.broadcast_bytes, 1))
    if blocks > MOST_BLOCKS:
        return joined_vectors(texts, id_col, text_col, vectors, dim, limits, size)
    single, rest = split_repeats(texts.select(id_col, text_col), id_col)
    rows = by_id(single, id_col).select(id_col, embedding_tokens(clean_text(F.col(text_col))).alias("__tokens"))
    block = F.pmod(F.xxhash64("word"), F.lit(blocks))
    parts = [pooled_sums(rows, id_col, "__tokens", vectors.where(block == b) if blocks > 1 else vectors, dim) for b in range(max(blocks, 1))]
    total = parts[0]
    if len(parts) > 1:
        total = reduce(DataFrame.unionByName, parts).select(id_col, array_to_vector("sums").alias("sums"), "n")
        total = total.groupBy(id_col).agg(Summarizer.sum(F.col("sums")).alias("sums"), F.sum("n").alias("n"))
        total = total.select(id_col, vector_to_array("sums").alias("sums"), "n")
    zeros = F.array_repeat(F.lit(0.0), dim)
    known = F.col(id_col).isNotNull()  # a null id finds nothing, as in a join
    found = total.select(id_col, F.when(known, mean(F.col("sums"), F.col("n"), dim)).otherwise(zeros).alias("features"))
    return found if rest is None else found.unionByName(joined_vectors(rest, id_col, text_col, vectors, dim, limits, size))


def mean(sums: Column, n: Column, dim: int) -> Column:
    return F.when(n > 0, F.transform(sums, lambda x: x / n)).otherwise(F.array_repeat(F.lit(0.0), dim))


def pooled_beside(text: Column, vectors: DataFrame, dim: int, limits: LookupLimits, size: int) -> Column | None:
    """The sums and counts of known tokens as a column beside the text, or ``None`` if the vectors are too large for one pass."""
    if size > 2 * limits.broadcast_bytes:
        return None
    return pooled_column(vectors.sparkSession, embedding_tokens(clean_text(text)), vectors, dim)


def joined_vectors(
    texts: DataFrame, id_col: str, text_col: str, vectors: DataFrame, dim: int, limits: LookupLimits, size: int
) -> DataFrame:
    """:func:`pooled_vectors` for tables of any size, by a join.

    Tokens are counted per text before the lookup, and the counts are the weights of the
    mean, which Spark's vector summarizer builds up per text.
    """
    slim = by_id(texts.select(id_col, text_col), id_col)
    tokens = embedding_tokens(clean_text(F.col(text_col)))
    words = slim.select(id_col, F.explode(tokens).alias("word"))
    counts = words.groupBy(id_col, "word").agg(F.count("*").alias("__c"))
    table = vectors.select("word", array_to_vector(F.col("vector").cast("array<double>")).alias("__v"))
    known = lookup_join(counts, table, "word", limits, size).where(F.col("__v").isNotNull())
    means = known.groupBy(id_col).agg(Summarizer.mean(F.col("__v"), F.col("__c")).alias("__m"))
    means = means.select(id_col, vector_to_array("__m").alias("__mean"))
    zeros = F.array_repeat(F.lit(0.0), dim)
    rows = by_id(texts.select(id_col), id_col).join(means, id_col, "left")
    return rows.select(id_col, F.coalesce(F.col("__mean"), zeros).alias("features"))
