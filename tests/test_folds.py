import pytest
from pyspark.sql import functions as F

from inkgrain.operators import terms as tm
from inkgrain.operators.batches import class_sums
from inkgrain.operators.blocks import CharTfidfSelector, WordTfidfSelector
from inkgrain.operators.lookup import LookupLimits
from inkgrain.operators.store import write_table
from inkgrain.plans import evaluate as ev

ODD = [
    (1, "red cat sat, red cat; red mat"), (2, ""), (3, None), (4, "the"), (5, "Été \U0001f600 cat mat İstanbul"), (6, "nul\x00 red cat \x00"),
    (7, "  red  mat "), (8, "the red cat"), (9, "中文 red cat 中文"), (10, "unseen words alone"), (11, "mat cat"), (12, "red red red"),
]
COLUMNS = {"idCol": "id", "textCol": "text", "labelCol": "label", "minDf": 2, "kPerLabel": 3}


@pytest.fixture(scope="module")
def odd(spark):
    return write_table(spark.createDataFrame([(*r, i % 3, i // 3 % 2) for i, r in enumerate(ODD)], "id long, text string, label int, fold int"), "odd")


def rows(df):
    plain = lambda x: round(x, 9) + 0.0 if isinstance(x, float) else [plain(y) for y in x] if isinstance(x, list) else x
    return sorted((tuple(map(plain, r)) for r in df.collect()), key=str)


def counts(df):
    return {r["label"]: r["n"] for r in df.groupBy("label").agg(F.count("*").alias("n")).collect()}


@pytest.mark.parametrize("block", [WordTfidfSelector(**COLUMNS), CharTfidfSelector(**COLUMNS)])
def test_one_pass_gives_the_features_of_all_folds(odd, block):
    coded = ev.CodedBlock.of(odd, block, 2, "label", "id", "text", 1)
    parts = {f: odd.where(F.col("fold") != f) for f in range(2)}
    found = coded.features(block, {f: counts(p) for f, p in parts.items()}, "b")
    for f, part in parts.items():
        assert rows(found.select("id", f"b{f}")) == rows(block.fit(part).features(odd))


def test_class_sums_are_those_of_single_weights(odd):
    for terms in (tm.WordTerms(), tm.CharTerms()):
        vocab = write_table(tm.smooth_idf(tm.doc_frequency(odd, "id", "text", terms, 1), len(ODD)), "vocabulary")
        coded = tm.coded_terms(vocab, terms, LookupLimits(), 1000)
        want = tm.label_sums(tm.text_weights(odd, vocab, "id", "text", terms, ["label"]), "label")
        found = class_sums(terms.folded(odd, "text").select("label", "__folded"), "label", "__folded", coded)
        assert rows(found) == rows(want) and "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_word_frequencies_are_summed_up_in_the_tasks(odd):
    for terms in (tm.WordTerms(1, 1), tm.WordTerms(1, 2), tm.WordTerms(2, 2)):
        found, want = tm.doc_frequency(odd, "id", "text", terms, 1), terms.distinct(odd, "text").groupBy("term").agg(F.count("*").alias("df"))
        assert rows(found) == rows(want) and "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_tables_of_a_cross_validation_do_not_grow_with_folds(spark, monkeypatch):
    texts = [(i, ("rain wind cloud" if i % 2 else "bread milk cheese") + f" word{i % 5}", i % 2, "ab"[i % 2], i // 2 % 3) for i in range(60)]
    folds = write_table(spark.createDataFrame(texts, "id long, text string, label int, x string, fold int").select("id", "text", "label", "fold", F.array(F.lit(1.0)).alias("static")), "folds")
    names, real = [], ev.write_table
    monkeypatch.setattr(ev, "write_table", lambda df, name: names.append(name) or real(df, name))
    settings = {"model": "random_forest", "model_params": {"n_estimators": 3, "max_depth": 3}}
    scores = ev.cross_validate(folds, ["one"], "text", "label", "id", 3, settings)
    assert {r["fold"]: r["score"] for r in scores.collect()} == {0: 1.0, 1: 1.0, 2: 1.0}
    assert sorted(n for n in names if n != "fold") == sorted(["blocks"] + ["counted", "frequencies", "sums", "vocabulary"] * 2)


def test_a_second_fit_computes_no_unfitted_features_again(spark, monkeypatch):
    from inkgrain.operators import union
    from inkgrain.plans.factory import build_pipeline
    from inkgrain.plans.pseudo import pseudo_label_round

    texts = [(i, ("rain wind cloud" if i % 2 else "bread milk cheese") + f" word{i % 5}", i % 2) for i in range(60)]
    texts = write_table(spark.createDataFrame(texts, "id long, text string, label int"), "texts")
    seen, real = [], union.with_scalar_features
    monkeypatch.setattr(union, "with_scalar_features", lambda *a: seen.append(1) or real(*a))
    make = lambda: build_pipeline("text", "label", "id", model="random_forest", model_params={"n_estimators": 3, "max_depth": 3})
    given, fresh = texts.where("id % 3 > 0"), texts.where("id % 3 = 0")
    predictions, summary = pseudo_label_round(given, fresh.drop("label"), make, "text", "label", "id", 0.6)
    assert {r["id"]: r["label"] for r in predictions.collect()} == {r["id"]: r["label"] for r in fresh.collect()}
    assert summary.first()["pseudo_rows"] == 20 and len(seen) == 2
    with pytest.raises(ValueError, match="repeated"):
        pseudo_label_round(given, fresh.unionByName(fresh).drop("label"), make, "text", "label", "id", 0.6)
