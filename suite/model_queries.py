"""Classifiers and the plans around them.

On real tables their results depend on training and have no SQL. The ``forced_`` queries run the same stages on features and texts
that part the classes widely, so that any right fit gives the label back; their SQL says so."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from inkgrain.operators.splits import stratified_split
from inkgrain.operators.store import new_path, write_table
from inkgrain.plans.evaluate import cv_eval, holdout_eval
from inkgrain.plans.factory import build_pipeline
from inkgrain.plans.job import Config, run
from inkgrain.plans.pseudo import pseudo_label_round
from inkgrain.plans.registry import make_classifier
from inkgrain.plans.search import search
from inkgrain.sources import csv
from inkgrain.sources.tables import read_table
from suite import fixtures as fx
from suite.registry import query
from suite.term_queries import vector_stage

TEXT = ("text", "label", "doc_id")
SMALL_FOREST = {
    "model": "random_forest",
    "model_params": {"n_estimators": 20, "max_depth": 5},
    "word_params": {"k_per_label": 10},
    "char_params": {"k_per_label": 10},
}


def dense_rows(spark, sf):
    """The embeddings with their labels, some of them held out."""
    rows = read_table(spark, sf, "embeddings")
    vector = array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    rows = stratified_split(rows.select("vec_id", "label", vector), "label", "vec_id", 0.25)
    return write_table(rows, "dense")


def classify(model, params):
    def run(spark, sf):
        rows = dense_rows(spark, sf)
        stage = make_classifier(model, params)
        stage._set(labelCol="label", idCol="vec_id")
        scored = stage.fit(rows.where("NOT is_test")).transform(rows)
        return scored.select("vec_id", "label", "is_test", "prediction", F.round(F.array_max("probability"), 4).alias("confidence"))

    return run


FEW = {"n_estimators": 5, "max_depth": 3, "min_child_samples": 5}
query("clf_gbt")(classify("gbt", FEW))
query("clf_gbt2")(classify("gbt_plain", {"n_estimators": 5, "max_depth": 3, "min_child_weight": 5}))
query("clf_rf")(classify("random_forest", {"n_estimators": 30, "max_depth": 6}))
query("clf_svc")(classify("linear_svc", {"C": 1.0, "max_iter": 10}))


def labelled(spark, sf):
    return write_table(fx.labelled(spark, sf, "text"), "labelled")


@query("fit_predict")
def fit_predict(spark, sf):
    settings = {**SMALL_FOREST, "model": "gbt", "model_params": FEW}
    pipeline = build_pipeline(*TEXT, vectors=vector_stage(spark, sf), **settings)
    model = pipeline.fit(labelled(spark, sf))
    scored = model.transform(fx.unlabelled(spark, sf, "text"))
    return scored.select("doc_id", "prediction", F.round(F.array_max("probability"), 4).alias("confidence"))


@query("cv_eval")
def cross_validation(spark, sf):
    scores = cv_eval(labelled(spark, sf), vector_stage(spark, sf), *TEXT, k=3, settings=SMALL_FOREST)
    return scores.select("fold", F.round("score", 6).alias("macro_f1"))


@query("search_trials")
def search_trials(spark, sf):
    space = {"n_estimators": ("int", 5, 20, 5), "max_depth": ("int", 3, 6, 1)}
    rows = labelled(spark, sf)
    return search(rows, vector_stage(spark, sf), *TEXT, model="random_forest", n_trials=2, k=2, space=space)[2]


@query("holdout_eval")
def holdout(spark, sf):
    report = holdout_eval(labelled(spark, sf), vector_stage(spark, sf), *TEXT, settings=SMALL_FOREST)[1]
    return report.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("pseudo_label_round")
def pseudo_round(spark, sf):
    vectors = vector_stage(spark, sf)
    pipeline = lambda: build_pipeline(*TEXT, vectors=vectors, **SMALL_FOREST)
    predictions, _ = pseudo_label_round(
        labelled(spark, sf), fx.unlabelled(spark, sf, "text"), pipeline, *TEXT, threshold=0.6
    )
    return predictions


# Features that name the class several times over, and noise.
FORCED_POINTS = "SELECT vec_id, CAST(label % 3 * 10 AS INTEGER) AS label FROM embeddings"


def forced_points(spark, sf):
    rows = read_table(spark, sf, "embeddings").select("vec_id", (F.col("label") % 3 * 10).cast("int").alias("label"), "embedding")
    marks = F.array(*[F.when(F.col("label") == c, 5.0).otherwise(0.0) for c in (0, 10, 20)] * 4)
    noise = F.slice("embedding", 1, 2).cast("array<double>")
    return write_table(rows.select("vec_id", "label", array_to_vector(F.concat(marks, noise)).alias("features")), "forced")


def forced_classifier(model, params):
    def run(spark, sf):
        rows = forced_points(spark, sf)
        stage = make_classifier(model, params)
        stage._set(labelCol="label", idCol="vec_id")
        scored = stage.fit(rows.where("vec_id % 4 <> 0")).transform(rows)
        total = F.round(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x), 6)
        return scored.select("vec_id", "label", "prediction", total.alias("total"))

    return run


for name, params in (
    ("gbt", FEW),
    ("gbt_plain", {"n_estimators": 3, "max_depth": 3, "min_child_weight": 5}),
    ("random_forest", {"n_estimators": 10, "max_depth": 4}),
    ("linear_svc", {"max_iter": 10}),
    ("ensemble", {"n_estimators": 2}),
):
    query(f"forced_{name}", f"SELECT vec_id, label, label AS prediction, CAST(1 AS DOUBLE) AS total FROM ({FORCED_POINTS})")(forced_classifier(name, params))


# Texts made of the words of their class.
FORCED_TEXTS = "SELECT doc_id, CAST(doc_id % 3 * 10 AS INTEGER) AS label FROM documents"
CLASS_WORDS = ("rain wind cloud storm", "bread milk cheese apple", "goal match team score")
FORCED = {"model": "random_forest", "model_params": {"n_estimators": 8, "max_depth": 4}, "word_params": {"k_per_label": 4}, "char_params": {"k_per_label": 4}}


def forced_texts(spark, sf):
    rows = read_table(spark, sf, "documents").select("doc_id", "lang", (F.col("doc_id") % 3 * 10).cast("int").alias("label"))
    words = F.element_at(F.array(*map(F.lit, CLASS_WORDS)), (F.col("label") / 10 + 1).cast("int"))
    return write_table(rows.select("doc_id", F.concat_ws(" ", words, "lang", words).alias("text"), "label"), "forced")


@query("forced_pipeline", f"SELECT doc_id, label AS prediction FROM ({FORCED_TEXTS})")
def forced_pipeline(spark, sf):
    rows = forced_texts(spark, sf)
    return build_pipeline(*TEXT, **FORCED).fit(rows.where("doc_id % 4 <> 0")).transform(rows).select("doc_id", "prediction")


@query("pipeline_reload", f"SELECT doc_id, label AS prediction FROM ({FORCED_TEXTS})")
def pipeline_reload(spark, sf):
    """An unfitted pipeline is saved and loaded, fitted, and its model saved, loaded and used."""
    rows = forced_texts(spark, sf)
    plan, fitted = new_path(spark, "pipeline"), new_path(spark, "model")
    build_pipeline(*TEXT, vectors=vector_stage(spark, sf), **FORCED).save(plan)
    Pipeline.load(plan).fit(rows.where("doc_id % 4 <> 0")).save(fitted)
    return PipelineModel.load(fitted).transform(rows).select("doc_id", "prediction")


@query("forced_cv", "SELECT DISTINCT CAST(doc_id % 3 AS INTEGER) AS fold, CAST(1 AS DOUBLE) AS macro_f1 FROM documents")
def forced_cv(spark, sf):
    scores = cv_eval(forced_texts(spark, sf), None, *TEXT, k=3, settings=FORCED)
    return scores.select("fold", F.round("score", 6).alias("macro_f1"))


@query("forced_search", "SELECT DISTINCT CAST(doc_id % 2 AS INTEGER) AS trial_id, CAST(1 AS DOUBLE) AS score FROM documents")
def forced_search(spark, sf):
    space = {"n_estimators": ("int", 5, 10, 5), "max_depth": ("int", 3, 4, 1)}
    trials = search(forced_texts(spark, sf), None, *TEXT, model="random_forest", n_trials=2, k=2, space=space)[2]
    return trials.select("trial_id", F.round("score", 6).alias("score"))


ONE = "CAST(1 AS DOUBLE)"


@query("forced_holdout", f"""
SELECT CAST(label AS VARCHAR) AS class, {ONE} AS precision, {ONE} AS recall, {ONE} AS f1, CAST(NULL AS BIGINT) AS held FROM ({FORCED_TEXTS}) GROUP BY label
UNION ALL SELECT name, {ONE}, {ONE}, {ONE}, CAST(ceil(0.15 * n) AS BIGINT)
FROM (SELECT count(*) AS n FROM documents), (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) t(name)""")
def forced_holdout(spark, sf):
    report = holdout_eval(forced_texts(spark, sf), None, *TEXT, settings=FORCED)[1]
    held = F.when(F.col("class").rlike("[a-z]"), F.col("support")).alias("held")
    return report.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], held)


@query("forced_pseudo", f"""
WITH t AS ({FORCED_TEXTS}), n AS (SELECT CAST(count_if(doc_id % 4 <> 0) AS BIGINT) AS train_rows, CAST(count_if(doc_id % 4 = 0) AS BIGINT) AS test_rows FROM t)
SELECT doc_id, label, train_rows, test_rows, test_rows AS pseudo_rows FROM t, n WHERE doc_id % 4 = 0""")
def forced_pseudo(spark, sf):
    rows = forced_texts(spark, sf)
    make = lambda: build_pipeline(*TEXT, **FORCED)
    predictions, summary = pseudo_label_round(rows.where("doc_id % 4 <> 0"), rows.where("doc_id % 4 = 0").drop("label"), make, *TEXT, threshold=0.6)
    sizes = summary.first()
    return predictions.select("doc_id", "label", *[F.lit(sizes[c]).cast("long").alias(c) for c in ("train_rows", "test_rows", "pseudo_rows")])


@query("job", f"SELECT 'd' || doc_id AS id, label FROM ({FORCED_TEXTS}) WHERE doc_id % 4 = 0")
def whole_job(spark, sf):
    """CSV files in, predictions out."""
    rows = forced_texts(spark, sf)
    train, test, out = (new_path(spark, n) for n in ("train", "test", "predictions"))
    csv.write_texts(rows.where("doc_id % 4 <> 0").select(F.col("text").alias("TEXT"), F.col("label").alias("LABEL")), train)
    csv.write_texts(rows.where("doc_id % 4 = 0").select(F.concat(F.lit("d"), "doc_id").alias("id"), F.col("text").alias("TEXT")), test)
    run(spark, Config(train_path=train, test_path=test, out_path=out, model="random_forest", model_params=FORCED["model_params"], run_tuning=False, threshold=0.6))
    return csv.read_predictions(spark, out, "string")
