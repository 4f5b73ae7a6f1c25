"""Hold-out and cross-validated evaluation."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgrain.operators import metrics as mt
from inkgrain.operators.batches import Coded, fold_features, fold_sums
from inkgrain.operators.rowid import require_unique
from inkgrain.operators.splits import stratified_folds, stratified_split
from inkgrain.operators.store import write_table
from inkgrain.operators.terms import codable_terms, coded_groups, frequency_without, group_frequency, grouped_frequency, nested_counts
from inkgrain.operators.union import TextFeaturesModel
from inkgrain.plans.factory import build_pipeline

METRICS = ("f1_macro", "f1_weighted", "accuracy")
#: Key of what all trials of a search have in common.
LEAST_DF = "least_df"


def score_by(predictions: DataFrame, label_col: str, prediction_col: str, metric: str, by=()) -> DataFrame:
    """``(*by, score)`` for one of ``METRICS``."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}: use one of {', '.join(METRICS)}")
    classes = mt.class_scores(mt.confusion(predictions, label_col, prediction_col, by), by)
    value = {
        "f1_macro": F.avg("f1"),
        "f1_weighted": F.sum(F.col("f1") * F.col("support")) / F.sum("support"),
        "accuracy": F.sum("tp") / F.sum("support"),
    }[metric]
    return classes.groupBy(*by).agg(value.alias("score"))


def static_features(rows: DataFrame, embedder, text_col: str, label_col: str, id_col: str, keep=()):
    """Rows with the blocks that no fold changes, written once, and the names of those features."""
    model = TextFeaturesModel([embedder] if embedder is not None else [])
    model._set(textCol=text_col, labelCol=label_col, idCol=id_col)
    if embedder is not None:
        embedder._set(textCol=text_col, labelCol=label_col, idCol=id_col)
    slim = rows.select(id_col, text_col, label_col, *keep)
    return write_table(model.array(slim, "static"), "static"), model.get_feature_names_out()


class CodedBlock:
    """A term block of a cross-validation, by the numbers of a vocabulary that a task can hold: the terms of all rows are counted once, and one pass over the
    written numbers serves all folds."""

    def __init__(self, table: DataFrame, coded: Coded, label_col: str, id_col: str):
        self.table, self.coded, self.label_col, self.id_col = table, coded, label_col, id_col

    @classmethod
    def of(cls, folds: DataFrame, block, k: int, label_col: str, id_col: str, text_col: str, min_df: int):
        """``None`` if a task cannot hold the terms that are in ``min_df`` or more texts."""
        terms = block.terms()
        if not codable_terms(terms):
            return None
        frequencies = write_table(grouped_frequency(folds, text_col, "fold", terms), "frequencies")
        docs = [F.sum(F.when(F.col("fold") == f, F.col("n")).otherwise(0)).cast("int") for f in range(k)]
        vocabulary = frequencies.groupBy("term").agg(F.array(*docs).alias("docs"))
        vocabulary = write_table(vocabulary.where(F.aggregate("docs", F.lit(0), lambda a, x: a + x) >= min_df), "vocabulary")
        coded = coded_groups(vocabulary, terms, block.limits, k)
        if coded is None:
            return None
        table = terms.counted(folds.select(id_col, label_col, "fold", text_col), text_col, coded)
        return cls(write_table(table, "counted"), coded, label_col, id_col)

    def features(self, block, per_fold: dict, prefix: str) -> DataFrame:
        """``(id, prefix0, prefix1, ...)``: the features of every row by ``block`` fitted without each of the folds, whose classes ``per_fold`` counts."""
        how = self.coded, [sum(per_fold[f].values()) for f in per_fold], block.value("minDf")
        sums = write_table(fold_sums(self.table, self.label_col, "fold", *how), "sums")
        return fold_features(self.table, self.id_col, prefix, *how, block.fit_folds(sums, per_fold))


class CountedBlock:
    """A term block of a cross-validation: the terms of all rows are counted once, and each fold takes them from the written table."""

    def __init__(self, folds: DataFrame, block, label_col: str, id_col: str, text_col: str):
        self.id_col, self.label_col = id_col, label_col
        self.nested = write_table(nested_counts(folds, id_col, text_col, block.terms(), keep=[label_col, "fold"]), "terms")
        self.frequencies = write_table(group_frequency(self.nested, "fold"), "frequencies")

    def fit(self, block, fold: int, counts: dict):
        """``block`` fitted without the fold: its document frequencies are those of the other folds."""
        df = frequency_without(self.frequencies, "fold", fold, block.value("minDf"))
        return FittedCounts(block.fit_nested(df, self.nested.where(F.col("fold") != fold), counts), self)


class FittedCounts:
    """A fitted term block over the counted table of a cross-validation."""

    def __init__(self, model, counted: CountedBlock):
        self.model, self.counted = model, counted

    def get_feature_names_out(self):
        return self.model.get_feature_names_out()

    def features(self, rows: DataFrame) -> DataFrame:
        return self.model.features_of_nested(self.counted.nested)


def counted_block(shared: dict, folds: DataFrame, block, k: int, label_col: str, id_col: str, text_col: str) -> CodedBlock | CountedBlock:
    """The table of this kind of terms; ``shared`` keeps it for all trials over the same folds. Under ``LEAST_DF`` it may tell the least ``minDf`` that a
    trial has, by analyzer."""
    names = ("analyzer", "ngramMin", "ngramMax", "stopWords")
    key = json.dumps([block.value(n) for n in names])
    least = min(block.value("minDf"), shared.get(LEAST_DF, {}).get(block.value("analyzer"), block.value("minDf")))
    if key not in shared or shared[key][0] > least:
        found = CodedBlock.of(folds, block, k, label_col, id_col, text_col, least)
        # tables of all terms serve every trial
        shared[key] = (least, found) if found else (0, CountedBlock(folds, block, label_col, id_col, text_col))
    return shared[key][1]


def cross_validate(
    folds: DataFrame, static_names, text_col: str, label_col: str, id_col: str, k: int, settings: dict, metric="f1_macro", parallelism=1, shared: dict | None = None
) -> DataFrame:
    """``(fold, score)``. ``folds`` has a ``fold`` and a ``static`` column; the term blocks and
    the classifier are fitted anew without the fold, so nothing of it leaks into them.

    The texts expand into terms once for each kind of terms, not once a fold; ``shared`` (a dict of the caller) extends this to all calls
    with the same ``folds``. One table of features a fold serves both its training and its scoring.
    """
    shared = {} if shared is None else shared
    require_unique(folds, id_col)
    features, classifier = build_pipeline(text_col, label_col, id_col, static_col="static", static_names=static_names, **settings).getStages()
    blocks = [b.copy()._set(textCol=text_col, idCol=id_col, labelCol=label_col) for b in features.blocks]
    counted = [counted_block(shared, folds, b, k, label_col, id_col, text_col) for b in blocks]
    per_fold: dict = {}
    for r in folds.groupBy("fold", label_col).agg(F.count("*").alias("n")).collect():  # folds x classes rows
        if r[label_col] is None:
            raise ValueError(f"{label_col} has nulls")
        per_fold.setdefault(r["fold"], {})[r[label_col]] = r["n"]

    without: dict = {}
    for fold in range(k):
        without[fold] = {}
        for other, classes in per_fold.items():
            for label, n in classes.items() if other != fold else ():
                without[fold][label] = without[fold].get(label, 0) + n
    # the blocks that have features for all folds at once stand beside the rows
    wide, beside = folds.select(id_col, label_col, "fold", "static"), []
    for i, (c, b) in enumerate(zip(counted, blocks)):
        if isinstance(c, CodedBlock):
            wide = wide.join(c.features(b, without, f"__b{i}_"), id_col)
            beside.append(i)
    wide = write_table(wide, "blocks") if beside else wide

    def one(fold: int) -> DataFrame:
        rows, parts = wide, [F.col("static")]
        for i, (c, b) in enumerate(zip(counted, blocks)):
            part = F.col(f"__b{i}_{fold}")
            if i not in beside:
                fitted = c.fit(b, fold, without[fold])
                rows = rows.join(fitted.features(rows).select(id_col, F.col("features").alias(f"__b{i}_{fold}")), id_col, "left")
                part = F.coalesce(part, F.array_repeat(F.lit(0.0), len(fitted.get_feature_names_out())))
            parts.append(part)
        rows = rows.select(id_col, label_col, "fold", array_to_vector(F.concat(*parts)).alias(features.value("outputCol")))
        matrix = rows if len(beside) == len(blocks) else write_table(rows, "fold_features")
        scored = classifier.copy().fit(matrix.where(F.col("fold") != fold)).transform(matrix.where(F.col("fold") == fold))
        return write_table(scored.select("fold", label_col, "prediction"), "fold")

    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        scored = list(pool.map(one, range(k)))
    return score_by(reduce(DataFrame.unionByName, scored), label_col, "prediction", metric, by=["fold"])


def cv_eval(
    rows: DataFrame, embedder, text_col: str, label_col: str, id_col: str, k=5, seed=42, settings=None, metric="f1_macro", parallelism=1
) -> DataFrame:
    dealt = stratified_folds(rows.select(id_col, text_col, label_col), label_col, id_col, k, seed)
    table, names = static_features(dealt, embedder, text_col, label_col, id_col, keep=["fold"])
    return cross_validate(table, names, text_col, label_col, id_col, k, dict(settings or {}), metric, parallelism)


def holdout_eval(
    rows: DataFrame, vectors, text_col: str, label_col: str, id_col: str, test_size=0.15, seed=42, settings=None
) -> tuple[DataFrame, DataFrame]:
    """``(macro F1, report)`` of a model fitted on the training part."""
    parts = write_table(stratified_split(rows.select(id_col, text_col, label_col), label_col, id_col, test_size, seed), "split")
    pipeline = build_pipeline(text_col, label_col, id_col, vectors=vectors, **dict(settings or {}))
    model = pipeline.fit(parts.where("NOT is_test").drop("is_test"))
    scored = write_table(model.transform(parts.where("is_test")).select(label_col, "prediction"), "holdout")
    return mt.macro_f1(scored, label_col, "prediction"), mt.classification_report(scored, label_col, "prediction")
