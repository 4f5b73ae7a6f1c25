"""Classification metrics from one aggregation into confusion counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkgrain.operators.splits import with_class


def label_distribution(df: DataFrame, label_col: str, name: str = "n") -> DataFrame:
    return df.groupBy(label_col).agg(F.count("*").alias(name)).orderBy(label_col)


def share_distribution(df: DataFrame, label_col: str) -> DataFrame:
    """Counts per label and their percentage; the window sees one row per label."""
    counts = df.groupBy(label_col).agg(F.count("*").alias("n"))
    share = 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy())
    return counts.withColumn("percent", share).orderBy(label_col)


def confusion(df: DataFrame, label_col: str, prediction_col: str, by=()) -> DataFrame:
    """``(*by, label, prediction, n)``."""
    pair = df.select(*by, F.col(label_col).alias("label"), F.col(prediction_col).alias("prediction"))
    return pair.groupBy(*by, "label", "prediction").agg(F.count("*").alias("n"))


def class_scores(counts: DataFrame, by=()) -> DataFrame:
    """Precision, recall, F1 and support per class that was true or predicted; 0/0 is 0."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = counts.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.col("label").alias("class"), hit.alias("tp"), F.col("n").alias("t"), F.lit(0).cast("long").alias("p")),
                F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("t"), F.col("n").alias("p")),
            )
        ),
    )
    sums = sides.groupBy(*by, "class").agg(F.sum("tp").alias("tp"), F.sum("t").alias("support"), F.sum("p").alias("predicted"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return sums.select(
        *by,
        "class",
        ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "tp",
    )


def macro_f1(df: DataFrame, label_col: str, prediction_col: str, by=()) -> DataFrame:
    """Unweighted mean of the class F1 scores, per group of ``by`` if given."""
    scores = class_scores(confusion(df, label_col, prediction_col, by), by)
    return scores.groupBy(*by).agg(F.avg("f1").alias("macro_f1"))


def classification_report(df: DataFrame, label_col: str, prediction_col: str) -> DataFrame:
    """One row per class, then ``accuracy``, ``macro avg`` and ``weighted avg``."""
    scores = class_scores(confusion(df, label_col, prediction_col))
    rows = scores.select(F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support")
    weighted = lambda c: (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c)
    hits = (F.sum("tp") / F.sum("support")).alias("accuracy")
    totals = scores.agg(
        hits,
        *[F.avg(c).alias("m_" + c) for c in ("precision", "recall", "f1")],
        *[weighted(c).alias("w_" + c) for c in ("precision", "recall", "f1")],
        F.sum("support").alias("support"),
    )
    line = lambda name, p, r, f: F.struct(
        F.lit(name).alias("class"), F.col(p).alias("precision"), F.col(r).alias("recall"), F.col(f).alias("f1"), F.col("support")
    )
    summary = totals.select(
        F.inline(
            F.array(
                line("accuracy", "accuracy", "accuracy", "accuracy"),
                line("macro avg", "m_precision", "m_recall", "m_f1"),
                line("weighted avg", "w_precision", "w_recall", "w_f1"),
            )
        )
    )
    return rows.unionByName(summary)


def class_weights(df: DataFrame, label_col: str, name: str = "weight") -> DataFrame:
    """Append ``n / (k * n_c)``; a null label is a class like any other. The weights are one row per class;
    the optimizer broadcasts them where their size allows, and splits a large class where it does not."""
    counts = df.groupBy(label_col).agg(F.count("*").alias("__n"))
    everything = Window.partitionBy()
    weight = F.sum("__n").over(everything) / (F.count("*").over(everything) * F.col("__n"))
    return with_class(df, counts.select(label_col, weight.alias(name)), label_col)
