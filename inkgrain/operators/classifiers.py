"""Multi-class classifiers with probabilities for any label values.

All of them take ``(features vector, label)`` and append ``probability`` (an array in the
order of the sorted labels) and ``prediction`` (a label value). Labels are mapped to
positions and back explicitly, so they need not be 0..k-1.
"""

from __future__ import annotations


from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from inkgrain.functions.probability import argmax_label, normalise, soft_vote
from inkgrain.operators.blocks import class_counts
from inkgrain.operators.hinge import fit_planes, spark_planes
from inkgrain.operators.params import NestedStage
from inkgrain.operators.splits import stratified_folds
from inkgrain.operators.store import write_table

#: Bytes of feature values per partition of a training matrix.
MATRIX_PARTITION_BYTES = 8 * 1024 * 1024


class ClassifierParams(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "class column", TypeConverters.toString)
    idCol = Param(Params._dummy(), "idCol", "unique key of a row", TypeConverters.toString)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "array of class probabilities", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "predicted label", TypeConverters.toString)

    def _classifier_defaults(self):
        self._setDefault(
            featuresCol="features", labelCol="LABEL", idCol="id", probabilityCol="probability", predictionCol="prediction"
        )

    def value(self, name):
        return self.getOrDefault(self.getParam(name))


def arranged(rows: DataFrame, id_col: str, features: str, n: int) -> DataFrame:
    """Rows dealt by their id to a number of partitions that follows from their size, each in the order of ids."""
    width = (rows.select(F.size(vector_to_array(features)).alias("n")).limit(1).first() or [1])[0]
    parts = max(1, -(-n * width * 8 // MATRIX_PARTITION_BYTES))
    return rows.repartition(parts, F.col(id_col)).sortWithinPartitions(id_col)


class _Classifier(Estimator, ClassifierParams, NestedStage):
    """``settings`` are the values for the fit; ``balanced`` weights classes by ``n / (k * n_c)``.

    ``max_classes`` bounds the models that one-vs-rest training makes; more classes are an error.
    """

    def __init__(self, settings=None, balanced: bool = True, parallelism: int = 4, max_classes: int = 1000, **params):
        super().__init__()
        self._classifier_defaults()
        self.settings, self.balanced, self.parallelism, self.max_classes = dict(settings or {}), balanced, parallelism, max_classes
        self._set(**params)

    def _fields(self):
        return {"settings": self.settings, "balanced": self.balanced, "parallelism": self.parallelism, "max_classes": self.max_classes}

    def _fit(self, dataset: DataFrame):
        features, label, id_col = (self.value(n) for n in ("featuresCol", "labelCol", "idCol"))
        # Training reads its rows many times: compute the feature matrix once. Partitions and their order follow from the
        # rows alone, at any size, so that the same rows and seed give the same model.
        matrix = write_table(dataset.select(id_col, label, features), "matrix")
        counts = class_counts(matrix, label)
        if len(counts) > self.max_classes:
            raise ValueError(f"{label} has {len(counts)} classes, more than max_classes={self.max_classes}")
        matrix = arranged(matrix, id_col, features, sum(counts.values()))
        if len(counts) < 2:
            raise ValueError(f"{label} has {len(counts)} class; at least two are needed")
        labels = sorted(counts)
        position = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(label))
        n, k = sum(counts.values()), len(labels)
        weights = F.array(*[F.lit(n / (k * counts[x]) if self.balanced else 1.0) for x in labels])
        rows = matrix.select(
            F.col(id_col).alias("id"),
            (position - 1).cast("double").alias("y"),
            F.element_at(weights, position.cast("int")).alias("w"),
            F.col(features).alias("x"),
        )
        return self._copyValues(self._train(rows, labels, counts))

    def _train(self, rows, labels, counts):
        raise NotImplementedError


class _FittedClassifier(Model, ClassifierParams, NestedStage):
    """``members``: Spark models, saved as sub-folders next to the label list."""

    def __init__(self, labels, members):
        super().__init__()
        self._classifier_defaults()
        self.labels, self.members = list(labels), list(members)

    def _probabilities(self, rows: DataFrame, features: str, out: str) -> DataFrame:
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, prediction = self.value("probabilityCol"), self.value("predictionCol")
        kept = [F.col(c) for c in dataset.columns]
        scored = self._probabilities(dataset, self.value("featuresCol"), out).select(*kept, out)
        return scored.withColumn(prediction, argmax_label(F.col(out), self.labels))

    def _fields(self):
        return {"labels": self.labels}

    def _inner(self):
        return self.members

    @classmethod
    def _rebuilt(cls, fields, inner):
        return cls(fields["labels"], inner)


class OneVsRestProbabilities(_FittedClassifier):
    """One binary model per label; their positive probabilities are scaled to sum 1."""

    def _probabilities(self, rows, features, out):
        for i, member in enumerate(self.members):
            member = member.copy().setFeaturesCol(features).setProbabilityCol(f"__p{i}")
            rows = member.setRawPredictionCol("").setPredictionCol("").transform(rows)
        each = [vector_to_array(f"__p{i}")[1] for i in range(len(self.members))]
        return rows.withColumn("__ps", F.array(*each)).withColumn(out, normalise(F.col("__ps")))


class NativeProbabilities(_FittedClassifier):
    """One model that is multi-class itself."""

    def _probabilities(self, rows, features, out):
        model = self.members[0].copy().setFeaturesCol(features).setProbabilityCol("__p")
        rows = model.setRawPredictionCol("").setPredictionCol("").transform(rows)
        return rows.withColumn(out, vector_to_array("__p"))


def one_vs_rest(classifier, rows: DataFrame, parallelism: int):
    """The binary models of all labels, in label order."""
    return OneVsRest(
        classifier=classifier, featuresCol="x", labelCol="y", weightCol="w", parallelism=parallelism
    ).fit(rows).models


class BoostedTrees(_Classifier):
    """One-vs-rest gradient-boosted trees."""

    def _train(self, rows, labels, counts):
        settings = dict(self.settings)
        gain = settings.pop("totalGain", 0.0)
        if gain:
            # A gain in summed loss becomes Spark's gain per row.
            settings["minInfoGain"] = gain / sum(counts.values())
        trees = GBTClassifier(featuresCol="x", labelCol="y", weightCol="w", **settings)
        return OneVsRestProbabilities(labels, one_vs_rest(trees, rows, self.parallelism))


class Forest(_Classifier):
    """Random forest."""

    def _train(self, rows, labels, counts):
        forest = RandomForestClassifier(featuresCol="x", labelCol="y", weightCol="w", **self.settings)
        return NativeProbabilities(labels, [forest.fit(rows)])


def margins(rows: DataFrame, models, features: str) -> DataFrame:
    """Append ``__m0..``: the signed distance to each one-vs-rest plane."""
    for i, model in enumerate(models):
        model = model.copy().setFeaturesCol(features).setRawPredictionCol(f"__r{i}").setPredictionCol("")
        rows = model.transform(rows).withColumn(f"__m{i}", vector_to_array(f"__r{i}")[1]).drop(f"__r{i}")
    return rows


class CalibratedSvc(_Classifier):
    """Linear one-vs-rest support vectors with sigmoid calibration on held-out folds.

    The loss is ``squared_hinge`` (all classes in the same passes) or ``hinge`` (Spark's own, one fit a class).

    Per fold, planes are fitted on the other folds and one sigmoid per label on the margins
    of the fold. The prediction is the mean over the folds.
    """

    folds = 3

    def _train(self, rows, labels, counts):
        few = [x for x in labels if counts[x] < self.folds]
        if few:
            raise ValueError(f"labels {few} have fewer than {self.folds} rows")
        settings = dict(self.settings)
        cost = settings.pop("C", 1.0)
        seed = settings.pop("seed", 42)
        squared = settings.pop("loss", "squared_hinge") == "squared_hinge"
        dealt = write_table(stratified_folds(rows, "y", "id", self.folds, seed), "folds")
        dealt = arranged(dealt, "id", "x", sum(counts.values()))
        weights = {r["fold"]: r["w"] for r in dealt.groupBy("fold").agg(F.sum("w").alias("w")).collect()}
        sizes = {(r["fold"], r["y"]): r["count"] for r in dealt.groupBy("fold", "y").count().collect()}
        members = []
        for fold in range(self.folds):
            train = dealt.where(F.col("fold") != fold)
            total = sum(w for f, w in weights.items() if f != fold)
            if squared:
                found = fit_planes(train, len(labels), cost, settings.get("tol", 1e-4), settings.get("maxIter", 1000))
                planes = spark_planes(rows.sparkSession, found)
            else:
                # C weighs the summed loss, regParam the mean loss.
                svc = LinearSVC(featuresCol="x", labelCol="y", weightCol="w", regParam=1.0 / (cost * total), **settings)
                planes = one_vs_rest(svc, train, self.parallelism)
            held = margins(dealt.where(F.col("fold") == fold), planes, "x")
            held = held.select("y", *[f"__m{i}" for i in range(len(labels))]).persist(StorageLevel.MEMORY_AND_DISK)
            n = sum(c for (f, _), c in sizes.items() if f == fold)
            fit = lambda i: self._sigmoid(held, i, sizes.get((fold, float(i)), 0), n)
            with ThreadPoolExecutor(self.parallelism) as pool:
                sigmoids = list(pool.map(fit, range(len(labels))))
            held.unpersist()
            members += [*planes, *sigmoids]
        return CalibratedSvcModel(labels, members)

    @staticmethod
    def _sigmoid(held: DataFrame, i: int, positive: int, n: int):
        """Logistic fit to softened targets: each row enters once per side with its share."""
        target = F.when(F.col("y") == i, (positive + 1.0) / (positive + 2.0)).otherwise(1.0 / (n - positive + 2.0))
        side = lambda y, w: F.struct(F.lit(y).alias("side"), w.alias("share"))
        rows = held.select(
            array_to_vector(F.array(f"__m{i}")).alias("m"), F.inline(F.array(side(1.0, target), side(0.0, 1.0 - target)))
        )
        return LogisticRegression(featuresCol="m", labelCol="side", weightCol="share", maxIter=30).fit(rows)


class CalibratedSvcModel(_FittedClassifier):
    """Per fold: one plane per label, then one sigmoid per label."""

    def _probabilities(self, rows, features, out):
        k = len(self.labels)
        kept = rows.columns
        votes = []
        for start in range(0, len(self.members), 2 * k):
            planes, sigmoids = self.members[start : start + k], self.members[start + k : start + 2 * k]
            rows = margins(rows, planes, features)
            each = []
            for i, sigmoid in enumerate(sigmoids):
                slope, shift = float(sigmoid.coefficients[0]), float(sigmoid.intercept)
                each.append(1.0 / (1.0 + F.exp(-(slope * F.col(f"__m{i}") + shift))))
            vote = f"__v{start}"
            rows = rows.withColumn("__raw", F.array(*each)).withColumn(vote, normalise(F.col("__raw")))
            votes.append(vote)
            rows = rows.select(*kept, *votes)
        return rows.withColumn(out, soft_vote([F.col(v) for v in votes]))


class SoftVoting(Estimator, ClassifierParams, NestedStage):
    """Mean of the probabilities of several classifiers."""

    def __init__(self, classifiers, **params):
        super().__init__()
        self._classifier_defaults()
        self.classifiers = list(classifiers)
        self._set(**params)

    def _inner(self):
        return self.classifiers

    @classmethod
    def _rebuilt(cls, fields, inner):
        return cls(inner)

    def _fit(self, dataset: DataFrame):
        names = ("featuresCol", "labelCol", "idCol")
        settings = {n: self.value(n) for n in names}
        matrix = write_table(dataset.select(*[settings[n] for n in ("idCol", "labelCol", "featuresCol")]), "matrix")
        members = [c.copy()._set(**settings).fit(matrix) for c in self.classifiers]
        return self._copyValues(SoftVotingModel(members[0].labels, members))


class SoftVotingModel(_FittedClassifier):
    def _probabilities(self, rows, features, out):
        kept, votes = rows.columns, []
        for i, member in enumerate(self.members):
            member = member.copy()._set(featuresCol=features)
            rows = member._probabilities(rows, features, f"__vote{i}").select(*kept, *votes, f"__vote{i}")
            votes.append(f"__vote{i}")
        return rows.withColumn(out, soft_vote([F.col(v) for v in votes]))


