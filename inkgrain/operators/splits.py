"""Exact stratified hold-out and folds.

A class may hold most of the rows, so no class is ever ranked in one task. Rows are ranked
inside small groups cut by the leading digits of their hash, as many digits as the largest class
needs; the counts of the groups give the rank in the whole class. Null labels are a class of their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a class per ranked group, on average.
GROUP_ROWS = 20_000


def order_key(id_col: str, seed: int) -> Column:
    """A pseudo-random order that does not depend on the partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string")))


def class_ranks(df: DataFrame, label_col: str, id_col: str, seed: int) -> DataFrame:
    """Append ``__rank``: 1..n_c inside each class, in the order of the hash and the id."""
    largest = df.groupBy(label_col).count().agg(F.max("count")).first()[0] or 1
    digits = max(1, math.ceil(math.log(max(1.0, largest / GROUP_ROWS), 16)))
    keyed = df.withColumn("__key", order_key(id_col, seed))
    keyed = keyed.withColumn("__group", F.substring("__key", 1, digits))
    sizes = keyed.groupBy(label_col, "__group").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(label_col).orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(label_col).alias("__label"), F.col("__group").alias("__g"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(label_col, "__group").orderBy("__key", id_col)
    same = F.col(label_col).eqNullSafe(F.col("__label")) & F.col("__group").eqNullSafe(F.col("__g"))
    ranked = keyed.withColumn("__row", F.row_number().over(inside)).join(starts, same)
    return ranked.withColumn("__rank", F.col("__start") + F.col("__row")).drop("__key", "__group", "__row", "__start", "__label", "__g")


def with_class(df: DataFrame, classes: DataFrame, label_col: str) -> DataFrame:
    """``df`` with the columns of ``classes``, one row per class; a null label is a class like any other."""
    classes = classes.withColumnRenamed(label_col, "__class")
    return df.join(classes, F.col(label_col).eqNullSafe(F.col("__class"))).drop("__class")


def stratified_split(df: DataFrame, label_col: str, id_col: str, test_size: float = 0.15, seed: int = 42) -> DataFrame:
    """Append ``is_test``. The hold-out has ``ceil(test_size * n)`` rows.

    Train places go to the classes in proportion to their size; the places left over by
    rounding down go to the largest remainders.
    """
    sizes = df.groupBy(label_col).agg(F.count("*").alias("__n"))
    # The windows below run over one row per class.
    everything = Window.partitionBy()
    total = F.sum("__n").over(everything)
    sizes = sizes.withColumn("__total", total)
    sizes = sizes.withColumn("__places", F.col("__total") - F.ceil(F.col("__total") * F.lit(float(test_size))))
    product = F.col("__n") * F.col("__places")
    sizes = sizes.withColumn("__base", (product - product % F.col("__total")) / F.col("__total"))
    sizes = sizes.withColumn("__base", F.col("__base").cast("long")).withColumn("__rem", product % F.col("__total"))
    order = F.row_number().over(Window.orderBy(F.desc("__rem"), label_col))
    missing = F.col("__places") - F.sum("__base").over(everything)
    sizes = sizes.select(label_col, (F.col("__base") + F.when(order <= missing, 1).otherwise(0)).alias("__train"))
    ranked = with_class(class_ranks(df, label_col, id_col, seed), sizes, label_col)
    return ranked.withColumn("is_test", F.col("__rank") > F.col("__train")).drop("__rank", "__train")


def stratified_folds(df: DataFrame, label_col: str, id_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Append ``fold`` in 0..k-1; class after class, rows are dealt to the folds in turn."""
    sizes = df.groupBy(label_col).agg(F.count("*").alias("__n"))
    before = Window.orderBy(label_col).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(label_col, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    ranked = with_class(class_ranks(df, label_col, id_col, seed), starts, label_col)
    fold = (F.col("__first") + F.col("__rank") - 1) % k
    return ranked.withColumn("fold", fold.cast("int")).drop("__rank", "__first")
