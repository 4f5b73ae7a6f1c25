import pytest
from pyspark.sql import functions as F

from inkgrain.operators import terms as tm
from inkgrain.operators.batches import coded_words
from inkgrain.operators.blocks import TfidfSelectorModel, WordTfidfSelector
from inkgrain.operators.lookup import LookupLimits, table_bytes
from inkgrain.operators.store import write_table
from inkgrain.operators.terms import WordTerms

ODD = [
    (1, "red cat sat, red cat; red mat"), (2, ""), (3, None), (4, "the"), (5, "Été \U0001f600\U0001f600 cat mat İstanbul"), (6, "nul\x00 red cat \x00"),
    (7, "  red  mat "), (8, "repeated cat"), (8, "red cat repeated"), (None, "null cat"), (None, "null mat red cat"), (9, "中文 red cat 中文"), (10, "unseen words alone"),
]
COLUMNS = ["id", "label", "term", "tf", "weight"]


@pytest.fixture(scope="module")
def odd(spark):
    return write_table(spark.createDataFrame([(*r, i % 2) for i, r in enumerate(ODD)], "id long, text string, label int"), "odd")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df):
    plain = lambda x: round(x, 9) + 0.0 if isinstance(x, float) else [plain(y) for y in x] if isinstance(x, list) else x
    return sorted((tuple(map(plain, r)) for r in df.collect()), key=str)


def vocabulary(texts, terms, min_df=2):
    return write_table(tm.smooth_idf(tm.doc_frequency(texts, "id", "text", terms, min_df), len(ODD)), "vocabulary")


def joined(texts, vocab, terms):
    return tm.tfidf_weights(tm.term_counts(texts, "id", "text", terms, ["label"]), vocab, "id", known=True)


@pytest.mark.parametrize("lo, hi", [(1, 1), (1, 2), (2, 2)])
def test_a_vocabulary_beyond_the_broadcast_limit_needs_no_shuffle_of_words(odd, lo, hi):
    terms = WordTerms(lo, hi)
    vocab = vocabulary(odd, terms)
    small = LookupLimits(table_bytes(vocab, "term") - 1, 5)
    while coded_words(vocab, 2 * small.broadcast_bytes) is None:  # a few terms weigh less than their words
        small = LookupLimits(small.broadcast_bytes * 2, 5)
    found = tm.text_weights(odd, vocab, "id", "text", terms, ["label"], small)
    assert rows(found.select(COLUMNS)) == rows(joined(odd, vocab, terms).select(COLUMNS))
    single = plan_of(tm.text_weights(odd.where("id < 8"), vocab, "id", "text", terms, limits=small, size=small.broadcast_bytes + 1))
    assert "Generate" not in single and "Join" not in single and "Window" not in single


def test_longer_terms_and_large_vocabularies_go_by_the_join(odd):
    three = WordTerms(1, 3)
    vocab = vocabulary(odd, three)
    want = rows(joined(odd, vocab, three).select(COLUMNS))
    assert rows(tm.text_weights(odd, vocab, "id", "text", three, ["label"]).select(COLUMNS)) == want
    assert coded_words(vocab, 10) is None and coded_words(vocab, 12 * vocab.count() + 10) is None


def test_features_of_texts_and_of_counted_texts(spark, odd):
    model = WordTfidfSelector(idCol="id", textCol="text", labelCol="label", minDf=2, kPerLabel=3).fit(odd)
    want = rows(model.features_of(tm.term_counts(odd, "id", "text", WordTerms())))
    assert rows(model.features(odd)) == want
    one = odd.where("id < 8")
    nested = write_table(tm.nested_counts(one, "id", "text", WordTerms(), keep=["label"]), "nested")
    assert rows(model.features_of_nested(nested)) == rows(model.features_of(tm.term_counts(one, "id", "text", WordTerms())))
    assert "Join" not in plan_of(model.features_of_nested(nested))
    again = WordTfidfSelector(idCol="id", textCol="text", labelCol="label", minDf=2, kPerLabel=3)
    df = tm.doc_frequency(one, "id", "text", WordTerms(), 2)
    counts = {r["label"]: r["n"] for r in one.groupBy("label").agg(F.count("*").alias("n")).collect()}
    fits = [again.fit(one), again.fit_nested(df, nested, counts)]
    assert rows(fits[0].selected) == rows(fits[1].selected)
    # terms that the vocabulary has not take no slot
    strange = spark.createDataFrame([("no such", 0), ("unknown", 1), ("cat", 2)], "term string, idx int")
    odd_model = TfidfSelectorModel(["a", "b", "c"], model.size, model.vocabulary, strange)
    model._copyValues(odd_model)
    assert rows(odd_model.features(odd)) == rows(odd_model.features_of(tm.term_counts(odd, "id", "text", WordTerms())))
