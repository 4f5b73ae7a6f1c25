import random
import re

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from inkgrain.operators.blocks import ScalarTextFeatures
from inkgrain.operators.store import new_path, write_table
from inkgrain.plans.evaluate import cv_eval, holdout_eval, score_by
from inkgrain.plans.factory import build_pipeline, char_block, word_block
from inkgrain.plans.job import Config, run
from inkgrain.plans.pseudo import pseudo_label_round
from inkgrain.operators import classifiers
from inkgrain.operators.lookup import LookupLimits
from inkgrain.plans import registry
from inkgrain.plans.registry import make_classifier
from inkgrain.plans.search import FEATURE_SPACE, SPACES, draw, search
from inkgrain.sources import csv

LABELS = [3, 7, 20]
FOREST = {"model": "random_forest", "model_params": {"n_estimators": 8, "max_depth": 4}}


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(1)
    rows = []
    for i in range(240):
        label = LABELS[0 if i % 6 else 1 + (i // 6) % 2]
        x, y = [(0.0, 0.0), (4.0, 0.0), (0.0, 4.0)][LABELS.index(label)]
        rows.append((i, label, [x + rng.gauss(0, 0.5), rng.gauss(0, 1), y + rng.gauss(0, 0.5)]))
    df = spark.createDataFrame(rows, "id long, LABEL int, v array<double>")
    return write_table(df.select("id", "LABEL", array_to_vector("v").alias("features")), "points")


PRESETS = [
    ("gbt", {"n_estimators": 4, "max_depth": 2, "min_child_samples": 2, "learning_rate": 0.3}),
    ("gbt", {"objective": "ova", "n_estimators": 4, "max_depth": 2, "min_child_samples": 2, "learning_rate": 0.3}),
    ("gbt_plain", {"n_estimators": 6, "max_depth": 2, "min_child_weight": 0.5, "learning_rate": 0.5, "reg_alpha": 0, "reg_lambda": 1, "subsample": 1, "colsample_bytree": 1}),
    ("random_forest", {"n_estimators": 8, "max_depth": 4}),
    ("linear_svc", {"estimator__C": 1.0, "estimator__loss": "hinge", "max_iter": 15}),
    ("linear_svc", {"estimator__C": 1.0, "estimator__tol": 1e-3}),
    ("ensemble", {"n_estimators": 2}),
]


@pytest.mark.parametrize("name,params", PRESETS)
def test_classifiers_learn(spark, points, name, params, monkeypatch):
    monkeypatch.setattr(registry, "ENSEMBLE_SVC", {"C": 0.1, "max_iter": 5})
    stage = make_classifier(name, params)
    model = stage.fit(points)
    scored = write_table(model.transform(points), "scored")
    assert model.labels == LABELS
    rows = scored.collect()
    assert all(sum(r.probability) == pytest.approx(1) and len(r.probability) == 3 for r in rows)
    assert all(r.prediction == LABELS[r.probability.index(max(r.probability))] for r in rows)
    assert score_by(scored, "LABEL", "prediction", "f1_macro").first()[0] > (0.3 if name == "ensemble" else 0.8)
    path = new_path(spark, "classifier")
    model.save(path)
    again = type(model).load(path).transform(points)
    want = {r.id: r.probability for r in rows}
    assert all(r.probability == pytest.approx(want[r.id]) for r in again.collect())


@pytest.mark.parametrize("partition_bytes", [8 << 20, 200])
def test_same_seed_same_model_at_any_size_and_partitioning(points, partition_bytes, monkeypatch):
    monkeypatch.setattr(classifiers, "MATRIX_PARTITION_BYTES", partition_bytes)
    fit = lambda n: make_classifier("random_forest", {"n_estimators": 5}).fit(points.repartition(n)).transform(points).orderBy("id")
    assert [r.probability for r in fit(3).collect()] == [r.probability for r in fit(11).collect()]


def test_too_many_classes_is_a_clear_error(points):
    stage = make_classifier("random_forest")
    stage.max_classes = 2
    with pytest.raises(ValueError, match="max_classes"):
        stage.fit(points)


def test_model_errors(points):
    with pytest.raises(ValueError, match="unknown model"):
        make_classifier("nope")
    with pytest.raises(ValueError, match="num_leaves"):
        make_classifier("lgbm", {"objective": "ova", "num_leaves": 15})
    with pytest.raises(ValueError, match="hinge"):
        make_classifier("linear_svc", {"loss": "log"})
    with pytest.raises(ValueError, match="fixed"):
        make_classifier("ensemble", {"max_depth": 2})
    with pytest.raises(ValueError, match="two are needed"):
        make_classifier("random_forest").fit(points.where("LABEL = 3"))
    with pytest.raises(ValueError, match="fewer than 3"):
        make_classifier("linear_svc").fit(points.where("LABEL <> 7 OR id < 20"))
    with pytest.raises(ValueError, match="unknown"):
        word_block({"k": 3})
    assert char_block({"k_per_label_char": 9, "min_df": 2}).value("kPerLabel") == 9


def test_draws_stay_in_range():
    rng = random.Random(0)
    for _ in range(50):
        for name, space in SPACES.items():
            for k, v in draw({**space, **FEATURE_SPACE}, rng).items():
                kind, *spec = {**space, **FEATURE_SPACE}[k]
                assert v in spec[0] if kind == "choice" else spec[0] <= v <= spec[1] + 1e-12
                assert kind != "int" or (v - spec[0]) % spec[2] == 0


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(5)
    words = {3: "rain wind cloud storm sun", 7: "bread milk cheese apple plum", 20: "goal match team score ball"}
    shared = "today people often thing place again never year".split()
    rows = []
    for i in range(150):
        label = LABELS[0 if i % 5 < 3 else 1 + i % 2]
        body = [rng.choice(words[label].split() if rng.random() < 0.5 else shared) for _ in range(12)]
        rows.append((i, " ".join(body) + ".", label))
    return write_table(spark.createDataFrame(rows, "id long, TEXT string, LABEL int"), "texts")


@pytest.fixture(scope="module")
def vectors(spark):
    names = "rain wind cloud bread milk cheese goal match team today".split()
    rows = [(w, [float(i), float(i % 3), 1.0]) for i, w in enumerate(names)]
    return write_table(spark.createDataFrame(rows, "word string, vector array<float>"), "vectors").inputFiles()[0].rsplit("/", 1)[0]


def test_pipeline(spark, texts, vectors):
    pipeline = build_pipeline(vectors=vectors, word_params={"k_per_label": 4, "ngram_range": (1, 1)}, char_params={"k_per_label": 4}, **FOREST)
    model = pipeline.fit(texts.where("id < 120"))
    names = model.stages[0].get_feature_names_out()
    assert len(names) == len(set(names)) or any(n.startswith("char_") for n in names)
    assert names[0] == "char_len" and names[33:36] == ["glove_0", "glove_1", "glove_2"]
    scored = write_table(model.transform(texts.where("id >= 120")), "scored")
    assert scored.count() == 30 and scored.first().features.size == len(names)
    assert score_by(scored, "LABEL", "prediction", "accuracy").first()[0] > 0.8


def test_pipeline_saves_and_loads(spark, texts, vectors):
    plan, fitted = new_path(spark, "pipeline"), new_path(spark, "model")
    for settings in (FOREST, {"model": "ensemble", "model_params": {"n_estimators": 2}}):
        pipeline = build_pipeline(vectors=vectors, word_params={"k_per_label": 4}, **settings)
        pipeline.write().overwrite().save(plan)
        again = Pipeline.load(plan)
        assert again.getStages()[0].blocks[1].value("kPerLabel") == 4
        assert type(again.getStages()[1]) is type(pipeline.getStages()[1])
    model = build_pipeline(vectors=vectors, word_params={"k_per_label": 4}, **FOREST).fit(texts)
    model.save(fitted)
    rows = lambda m: m.transform(texts).select("id", "features", "probability", "prediction").orderBy("id").collect()
    assert rows(PipelineModel.load(fitted)) == rows(model)


def test_text_is_shuffled_once_for_all_blocks(texts, vectors):
    model = build_pipeline(vectors=vectors, word_params={"k_per_label": 4}, **FOREST).fit(texts).stages[0]
    plan = model.transform(texts.select("id", "TEXT", "LABEL"))._jdf.queryExecution().executedPlan().toString()
    shuffles = [line.split("Arguments")[0] for line in plan.splitlines() if "REPARTITION_BY_NUM" in line]
    assert len(set(re.findall(r"hashpartitioning\(id#\d+L?, (\d+)\), REPARTITION_BY_NUM", plan))) == 1
    assert all("RoundRobin" not in line for line in plan.splitlines()) and shuffles


def test_blocks_are_columns_beside_the_text(spark, texts, vectors):
    model = build_pipeline(vectors=vectors, word_params={"k_per_label": 4}, char_params={"k_per_label": 4}, **FOREST).getStages()[0].fit(texts)
    odd = spark.createDataFrame([(200, None, None), (201, "", 3), (202, "rain Rain bread \u00e9t\u00e9 \u4e2d\u6587", 7)], texts.schema)
    rows = write_table(texts.unionByName(odd), "odd")
    plan = model.array(rows, "f")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1 and plan.count("ArrowEvalPython") == 1
    by_key = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert by_key(model.array(rows, "f")) == by_key(model._joined(rows, "f"))
    # ids that repeat or are null share the features of an id, or have none, as a join gives them
    for more in (rows.where("id < 3"), rows.where("id = 4").withColumn("id", F.lit(None).cast("long"))):
        mixed = write_table(rows.unionByName(more), "mixed")
        assert by_key(model.array(mixed, "f")) == by_key(model._joined(mixed, "f"))


def test_a_block_too_large_for_a_task_is_joined(texts, vectors):
    model = build_pipeline(vectors=vectors, word_params={"k_per_label": 4}, char_params={"k_per_label": 4}, **FOREST).getStages()[0].fit(texts)
    want = {r["id"]: r["f"] for r in model.array(texts, "f").collect()}
    for block in model.blocks[:2]:
        block.limits = LookupLimits(broadcast_bytes=0)
    assert [b.beside(F.col("TEXT")) is None for b in model.blocks] == [True, True, False]
    got = {r["id"]: r["f"] for r in model.array(texts, "f").collect()}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i]) for i in want)


def test_job_reads_its_training_files_once(spark, texts, monkeypatch):
    train, out = (new_path(spark, n) for n in ("train", "out"))
    csv.write_texts(texts.drop("id"), train)
    seen, read = spark.sparkContext.accumulator(0), csv.read_labelled

    def counted(*args, **how):
        def run(batches):
            for batch in batches:
                seen.add(len(batch))
                yield batch

        rows = read(*args, **how)
        return rows.mapInArrow(run, rows.schema)

    class Enough(Exception):
        pass

    def stop(*args, **how):
        raise Enough

    monkeypatch.setattr(csv, "read_labelled", counted)
    monkeypatch.setattr(csv, "has_column", stop)
    with pytest.raises(Enough):
        run(spark, Config(train_path=train, test_path=train, out_path=out))
    assert seen.value == 150


def test_repeated_ids_are_refused(texts):
    with pytest.raises(ValueError, match="repeated"):
        build_pipeline(**FOREST).fit(texts.unionByName(texts.limit(1)))


def test_job_checks_before_it_trains(spark, texts):
    train, test, out = (new_path(spark, n) for n in ("train", "test", "out"))
    csv.write_texts(texts.drop("id").withColumn("LABEL", F.when(F.col("LABEL") != 3, F.col("LABEL"))), train)
    csv.write_texts(texts.drop("LABEL").unionByName(texts.drop("LABEL").limit(1)), test)
    with pytest.raises(ValueError, match="have no LABEL"):
        run(spark, Config(train_path=train, test_path=test, out_path=out))
    with pytest.raises(ValueError, match="there already"):
        run(spark, Config(train_path=train, test_path=test, out_path=train))


def test_scalar_stage_saves(spark, texts):
    stage = ScalarTextFeatures()
    path = new_path(spark, "scalar")
    stage.save(path)
    back = ScalarTextFeatures.load(path)
    assert back.transform(texts).select("scalar").collect() == stage.transform(texts).select("scalar").collect()


def test_evaluation(texts):
    args = ("TEXT", "LABEL", "id")
    scores = cv_eval(texts, None, *args, k=2, settings=FOREST, parallelism=2).collect()
    assert sorted(r.fold for r in scores) == [0, 1] and all(r.score > 0.7 for r in scores)
    macro, report = holdout_eval(texts, None, *args, settings=FOREST)
    assert macro.first()[0] > 0.7
    assert {r["class"] for r in report.collect()} >= {"3", "7", "20", "accuracy"}
    with pytest.raises(ValueError, match="unknown metric"):
        score_by(texts, "LABEL", "LABEL", "nope")


def test_search(texts):
    space = {"n_estimators": ("int", 3, 6, 1)}
    args = (texts, None, "TEXT", "LABEL", "id", "random_forest")
    settings, score, trials = search(*args, n_trials=3, k=2, space=space, timeout_sec=0.0)
    rows = trials.collect()
    assert len(rows) == 1 and score == rows[0].score > 0.5
    assert settings["model_params"]["n_estimators"] in range(3, 7)
    with pytest.raises(ValueError, match="one trial"):
        search(*args, n_trials=0)


def test_a_stopped_search_goes_on(texts, tmp_path, monkeypatch):
    from inkgrain.plans import search as module

    args, space = (texts, None, "TEXT", "LABEL", "id", "random_forest"), {"n_estimators": ("int", 2, 40, 1)}
    ran, scorer = [], module.cross_validate

    def two_at_most(*a):
        if len(ran) == 2:
            raise KeyboardInterrupt
        ran.append(a[6]["model_params"])
        return scorer(*a)

    monkeypatch.setattr(module, "cross_validate", two_at_most)
    with pytest.raises(KeyboardInterrupt):
        search(*args, n_trials=3, k=2, space=space, study=str(tmp_path / "study"))
    first = ran.copy()
    ran.clear()
    _, _, trials = search(*args, n_trials=3, k=2, space=space, study=str(tmp_path / "study"))
    assert len(ran) == 1 and trials.count() == 3
    monkeypatch.setattr(module, "cross_validate", lambda *a: first.append(a[6]["model_params"]) or trials.limit(1))
    search(*args, n_trials=3, k=2, space=space)  # the draws of a search that was not stopped
    assert first[2:] == [*first[:2], *ran]
    with pytest.raises(ValueError, match="other settings"):
        search(*args, n_trials=3, k=2, seed=1, space=space, study=str(tmp_path / "study"))


@pytest.mark.parametrize("threshold,grows", [(0.6, True), (1.01, False)])
def test_pseudo_round(texts, threshold, grows):
    make = lambda: build_pipeline(**FOREST)
    labelled, fresh = texts.where("id < 90"), texts.where("id >= 90").drop("LABEL")
    predictions, summary = pseudo_label_round(labelled, fresh, make, "TEXT", "LABEL", "id", threshold)
    row = summary.first()
    assert (row.pseudo_rows > 0) == grows and row.train_rows == 90
    got = predictions.withColumnRenamed("LABEL", "said").join(texts, "id")
    assert got.count() == 60 and got.where("said = LABEL").count() > 45


def test_job(spark, texts, vectors):
    train, test, out = (new_path(spark, n) for n in ("train", "test", "out"))
    csv.write_texts(texts.where("id < 110").drop("id"), train)
    csv.write_texts(texts.where("id >= 110").drop("LABEL"), test)
    result = run(
        spark,
        Config(
            train_path=train, test_path=test, out_path=out, vectors_path=vectors, model="random_forest", n_trials=1, cv_folds=2,
            space={"n_estimators": ("int", 5, 6, 1)}, threshold=0.7,
        ),
    )
    written = csv.read_predictions(spark, out)
    assert sorted(r.id for r in written.collect()) == list(range(110, 150))
    assert result["macro_f1"].first()[0] > 0.6 and result["trials"].count() == 1
    assert sum(r.n for r in result["distribution"].collect()) == 40


def test_folds_share_one_expansion_and_equal_separate_fits(texts, monkeypatch):
    """Texts expand once for each kind of terms, whatever folds and trials; scores are those of pipelines fitted on the other folds."""
    from inkgrain.operators import terms
    from inkgrain.operators.splits import stratified_folds
    from inkgrain.plans.evaluate import cross_validate, static_features

    settings = {**FOREST, "word_params": {"k_per_label": 5}, "char_params": {"k_per_label": 5}}
    dealt = stratified_folds(texts, "LABEL", "id", 2, 42)
    table, names = static_features(dealt, None, "TEXT", "LABEL", "id", keep=["fold"])
    want = {}
    for fold in range(2):
        pipeline = build_pipeline(static_col="static", static_names=names, **settings)
        scored = pipeline.fit(table.where(F.col("fold") != fold)).transform(table.where(F.col("fold") == fold))
        want[fold] = score_by(scored, "LABEL", "prediction", "f1_macro").first()[0]
    calls = []
    for kind in (terms.WordTerms, terms.CharTerms):
        for name in ("counted", "distinct"):
            real = getattr(kind, name)
            monkeypatch.setattr(kind, name, lambda self, *a, real=real, name=name: calls.append((type(self).__name__, name)) or real(self, *a))
    shared = {}
    for _ in range(2):
        scores = cross_validate(table, names, "TEXT", "LABEL", "id", 2, settings, shared=shared)
        assert {r["fold"]: r["score"] for r in scores.collect()} == pytest.approx(want)
    assert sorted(calls) == [("CharTerms", "counted"), ("WordTerms", "counted")]


def test_frequencies_without_a_fold(texts):
    from inkgrain.operators.splits import stratified_folds
    from inkgrain.operators.terms import CharTerms, doc_frequency, frequency_without, group_frequency, nested_counts, term_counts, unnested

    dealt = write_table(stratified_folds(texts, "LABEL", "id", 3, 1), "dealt")
    kind = CharTerms(3, 4)
    nested = write_table(nested_counts(dealt, "id", "TEXT", kind, keep=["fold"]), "nested")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(unnested(nested, "id")) == rows(term_counts(dealt, "id", "TEXT", kind))
    per_fold = group_frequency(nested, "fold")
    for fold in range(3):
        assert rows(frequency_without(per_fold, "fold", fold, 2)) == rows(doc_frequency(dealt.where(F.col("fold") != fold), "id", "TEXT", kind, 2))
