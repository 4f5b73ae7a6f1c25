"""Data steps of a pseudo-labelling round."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgrain.functions.probability import argmax_label, is_confident
from inkgrain.operators.rowid import id_faults
from inkgrain.operators.store import write_table
from inkgrain.operators.union import TextFeatures

#: Column of the features that no fit changes.
STATIC = "__static"


def pseudo_labels(scored: DataFrame, probability_col: str, labels, label_col: str, threshold: float = 0.90) -> DataFrame:
    """The confident rows, labelled by their first largest probability."""
    p = F.col(probability_col)
    return scored.where(is_confident(p, threshold)).withColumn(label_col, argmax_label(p, labels))


def union_pseudo_labels(labelled: DataFrame, pseudo: DataFrame, label_col: str) -> DataFrame:
    """All rows of both, with the pseudo-labels in the type of the given labels."""
    kind = labelled.schema[label_col].dataType
    return labelled.unionByName(pseudo.withColumn(label_col, F.col(label_col).cast(kind)))


def run_summary(labelled: DataFrame, label_col: str, scored: DataFrame, probability_col: str, threshold: float) -> DataFrame:
    """One row of sizes for the log of a run."""
    given = labelled.agg(F.count("*").alias("train_rows"), F.countDistinct(label_col).alias("classes"))
    confident = F.count_if(is_confident(F.col(probability_col), threshold))
    new = scored.agg(F.count("*").alias("test_rows"), confident.alias("pseudo_rows"))
    # Two one-row tables side by side.
    both = given.withColumn("__k", F.lit(0)).join(new.withColumn("__k", F.lit(0)), "__k")
    return both.select(
        "train_rows",
        "test_rows",
        "classes",
        "pseudo_rows",
        F.coalesce(F.try_divide(100.0 * F.col("pseudo_rows"), F.col("test_rows")), F.lit(0.0)).alias("pseudo_percent"),
        (F.col("train_rows") + F.col("pseudo_rows")).alias("extended_rows"),
    )


def pseudo_label_round(
    labelled: DataFrame,
    unlabelled: DataFrame,
    make_pipeline,
    text_col: str,
    label_col: str,
    id_col: str,
    threshold: float = 0.90,
) -> tuple[DataFrame, DataFrame]:
    """``(predictions, summary)`` for the unlabelled rows.

    A model fitted on the given labels scores the unlabelled rows. If some are confident,
    they join the training rows and all stages are fitted again from scratch; otherwise
    the first model's predictions stand. Ids of the two tables may overlap, so the union
    gets keys that tell its parts apart. Features that no fit changes are computed once for both fits, if every id names one row.
    """
    given = labelled.select(id_col, text_col, label_col)
    fresh = unlabelled.select(id_col, text_col)
    make, kept = make_pipeline, []
    stages = make_pipeline().getStages()
    parts = stages[0].parted(STATIC) if isinstance(stages[0], TextFeatures) else None
    if parts and all(id_faults(rows, id_col) == (0, 0) for rows in (given, fresh)):
        given, fresh = (write_table(parts[0].array(rows, STATIC), "static") for rows in (given, fresh))
        make, kept = lambda: with_static(make_pipeline()), [STATIC]
    first = make().fit(given)
    scored = write_table(first.transform(fresh).select(id_col, text_col, *kept, "probability", "prediction"), "scored")
    labels = first.stages[-1].labels
    summary = write_table(run_summary(given, label_col, scored, "probability", threshold), "summary")
    if not summary.first()["pseudo_rows"]:
        return scored.select(id_col, F.col("prediction").alias(label_col)), summary
    confident = pseudo_labels(scored, "probability", labels, label_col, threshold)
    tag = lambda df, mark: df.withColumn(id_col, F.concat(F.lit(mark), F.col(id_col).cast("string")))
    both = union_pseudo_labels(tag(given, "g"), tag(confident.select(id_col, text_col, label_col, *kept), "p"), label_col)
    second = make().fit(write_table(both, "extended"))
    predictions = second.transform(fresh).select(id_col, F.col("prediction").alias(label_col))
    return predictions, summary


def with_static(pipeline: Pipeline) -> Pipeline:
    """The pipeline for rows whose unfitted features are in ``STATIC``."""
    first, *rest = pipeline.getStages()
    return Pipeline(stages=[first.parted(STATIC)[1], *rest])
