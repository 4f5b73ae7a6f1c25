import weakref

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkgrain.operators import terms as tm
from inkgrain.operators.blocks import CharTfidfSelector
from inkgrain.operators.embedding import joined_vectors, pooled_vectors
from inkgrain.operators.lookup import LookupLimits, table_bytes
from inkgrain.operators.store import write_table
from inkgrain.operators.terms import CharTerms

ODD = [
    (1, "The cat sat on the mat, the cat"), (2, ""), (3, None), (4, "a"), (5, "Été \U0001f600\U0001f600 cat mat İ"), (6, "nul\x00 cat \x00"), (7, "  the  mat "),
    (8, "repeated cat"), (8, "the repeated mat"), (None, "null cat"), (None, "null mat the cat"), (9, "中文 the cat"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return write_table(spark.createDataFrame([(*r, i % 2) for i, r in enumerate(ODD)], "id long, text string, label int"), "odd")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df):
    plain = lambda x: round(x, 9) + 0.0 if isinstance(x, float) else [plain(y) for y in x] if isinstance(x, list) else x
    return sorted((tuple(map(plain, r)) for r in df.collect()), key=str)


def grouped(odd):
    counts = tm.term_counts(odd, "id", "text", CharTerms()).where("term IS NOT NULL")
    return counts.groupBy("term").agg(F.sum("tf").alias("n"), F.count("*").alias("docs"))


def test_totals_of_odd_texts(odd):
    assert rows(tm.total_frequency(odd, "id", "text", CharTerms())) == rows(grouped(odd))
    single = tm.total_frequency(odd.where("id < 8"), "id", "text", CharTerms())
    assert "Generate" not in plan_of(single) and rows(single) == rows(grouped(odd.where("id < 8")))


def test_frequency_goes_by_row(odd):
    found = CharTerms().distinct(odd, "text").groupBy("term").agg(F.count("*").alias("df"))
    assert rows(tm.doc_frequency(odd, "id", "text", CharTerms(), 1)) == rows(found)


def test_more_characters_than_a_code_holds(spark):
    wide = "".join(chr(c) for c in range(0x4E00, 0x4E00 + 3000))
    texts = [(1, "cat " + wide), (2, "cat mat"), *[(i, wide[i * 50 : i * 50 + 900] + " cat") for i in range(3, 40)]]
    df = write_table(spark.createDataFrame(texts, "id long, text string").coalesce(1), "wide")
    assert rows(tm.total_frequency(df, "id", "text", CharTerms())) == rows(grouped(df))
    vocab = write_table(tm.smooth_idf(tm.doc_frequency(df, "id", "text", CharTerms(), 1), len(texts)), "vocabulary")
    found = tm.text_weights(df, vocab, "id", "text", CharTerms()).where("id < 3")
    want = tm.tfidf_weights(tm.term_counts(df, "id", "text", CharTerms()), vocab, "id").where("id < 3 AND weight IS NOT NULL")
    assert rows(found.select("id", "term", "tf", "weight")) == rows(want.select("id", "term", "tf", "weight"))


def test_weights_of_odd_texts(odd):
    vocab = write_table(tm.smooth_idf(tm.doc_frequency(odd, "id", "text", CharTerms(), 2), 12), "vocabulary")
    columns = ["id", "label", "term", "tf", "weight"]
    want = tm.tfidf_weights(tm.term_counts(odd, "id", "text", CharTerms(), ["label"]), vocab, "id").where("weight IS NOT NULL")
    assert rows(tm.text_weights(odd, vocab, "id", "text", CharTerms(), ["label"]).select(columns)) == rows(want.select(columns))
    single = tm.text_weights(odd.where("id < 8"), vocab, "id", "text", CharTerms())
    assert "Generate" not in plan_of(single) and "Window" not in plan_of(single)


def test_features_and_nested_features(odd):
    model = CharTfidfSelector(idCol="id", textCol="text", labelCol="label", minDf=2, kPerLabel=3).fit(odd)
    want = rows(model.features_of(tm.term_counts(odd, "id", "text", CharTerms())))
    assert rows(model.features(odd)) == want
    one = odd.where("id < 8")
    nested = write_table(tm.nested_counts(one, "id", "text", CharTerms()), "nested")
    assert rows(model.features_of_nested(nested)) == rows(model.features_of(tm.term_counts(one, "id", "text", CharTerms())))
    assert "Generate" not in plan_of(model.features_of_nested(nested))


def test_vectors_in_blocks(spark, odd):
    words = ["the", "cat", "mat", "null", "repeated", "unseen", "sat"]
    vectors = write_table(spark.createDataFrame([(w, [i / 3, -i * 0.7, 1.0]) for i, w in enumerate(words)], "word string, vector array<float>"), "vectors")
    size = table_bytes(vectors, "word")
    want = rows(joined_vectors(odd, "id", "text", vectors, 3, LookupLimits(), size))
    for limits in (LookupLimits(), LookupLimits(size // 6), LookupLimits(0, 5)):
        assert rows(pooled_vectors(odd, "id", "text", vectors, 3, limits)) == want
    blocks = plan_of(pooled_vectors(odd.where("id < 8"), "id", "text", vectors, 3, LookupLimits(size // 6)))
    assert "Join" not in blocks and "Generate" not in blocks


def test_null_vectors_are_an_error(spark, odd):
    for bad in (None, [1.0, None]):
        vectors = spark.createDataFrame([("cat", [1.0, 2.0]), ("mat", bad)], "word string, vector array<float>")
        with pytest.raises(ValueError, match="nulls"):
            pooled_vectors(odd, "id", "text", vectors, 2)


def test_words_without_weight_are_left_out_before_the_sort(odd):
    vocab = write_table(tm.smooth_idf(tm.doc_frequency(odd, "id", "text", tm.WordTerms(), 2), 12), "vocabulary")
    plan = plan_of(tm.text_weights(odd, vocab, "id", "text", tm.WordTerms(), limits=LookupLimits(0, 5)))
    assert "Filter isnotnull(weight" not in plan and "Join Inner" in plan


def test_parts_stay_small(odd):
    parts = tm.in_small_parts(odd.coalesce(1), partition_bytes=1 << 30)
    assert parts.rdd.getNumPartitions() > 1
    from inkgrain.sources import tables

    before, tables.SPREAD_BYTES_PER_CORE = tables.SPREAD_BYTES_PER_CORE, 0
    try:
        assert tm.in_small_parts(odd.coalesce(1), partition_bytes=100).rdd.getNumPartitions() > 10
    finally:
        tables.SPREAD_BYTES_PER_CORE = before


def test_word_ngrams_read_the_texts_once(spark, sf):
    from suite.text_queries import word_ngrams

    plan = plan_of(word_ngrams(spark, sf))
    assert plan.count("Generate") == 1 and "Join" not in plan


def test_toxicity_fit_holds_its_rows_once(monkeypatch):
    from inkgrain.llm import toxicity

    rng = np.random.default_rng(1)
    handed = [[np.unique(rng.integers(0, 50, 8)).astype(np.int32) for _ in range(40)]]
    first, real, alive = weakref.ref(handed[0][0]), toxicity.sums, []
    monkeypatch.setattr(toxicity, "sums", lambda *a: alive.append(first() is not None) or real(*a))
    toxicity.fit_machine(list(range(50)), handed.pop(), np.arange(40) % 2 * 1.0, steps=20)
    assert alive and not any(alive)


def test_words_by_letters_alone(spark):
    """Number signs, combining marks and decimals of all scripts still part words, and plain words pass by the large class."""
    import sys

    from inkgrain.llm import language

    every = "".join(f"a{chr(c)}b " for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    want = [w[i : i + 60] for w in language.LETTERS.findall(every.lower()) for i in range(0, len(w), 60)]
    assert language.words_of(every) == want

    class Never:
        def findall(self, _):
            raise AssertionError

    slow, language.LETTERS = language.LETTERS, Never()
    try:
        assert language.words_of("Été 12 x_y " + "z" * 61) == ["été", "x", "y", "z" * 60, "z"]
    finally:
        language.LETTERS = slow
