import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import plain
from inkgrain.functions import text as tx
from inkgrain.functions import tokens as tk
from inkgrain.functions.scalar import FEATURE_NAMES, GROUPS, with_scalar_features


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id long, text string")


def check(spark, values):
    rows = with_scalar_features(texts(spark, values), "text").collect()
    for r in rows:
        want = plain.scalar(values[r["id"]] or "")
        for name in FEATURE_NAMES:
            assert r[name] == pytest.approx(want[name], abs=1e-9), (name, values[r["id"]])


def test_names_are_complete():
    assert len(FEATURE_NAMES) == 33
    assert {n for g in GROUPS.values() for n in g} == set(FEATURE_NAMES)


#: Counted by hand.
BY_HAND = {
    "Hello.": {"char_len": 6, "word_count": 1, "sentence_count": 2, "words_per_sentence": 0.5, "type_token_ratio": 1.0, "avg_word_len": 6.0, "punct_ratio": 1 / 6, "uppercase_char_ratio": 1 / 6},
    "U.S. is. Ok...": {"word_count": 3, "sentence_count": 4, "sent_len_std": 0.0, "allcaps_word_count": 1, "char_repeat_run_count": 1, "punct_ratio": 6 / 14},
    "A1 B-2 C.C. aBC ABC": {"allcaps_word_count": 4, "alphanum_mix_count": 1, "digit_group_count": 2, "sentence_count": 2},
    "soonnnn bbb BBB bbbccc yyy aaa ...!!!??? --- ": {"triple_consonant_count": 5, "char_repeat_run_count": 11, "exclamation_count": 3, "question_count": 3},
    "First one here. Second! Third has five words now? ": {"sentence_count": 4, "word_count": 9, "sent_len_std": (8 / 3) ** 0.5},
    "Furthermore, moreover. In conclusion it is worth noting that in summary; in  summary": {"ai_marker_count": 5, "marker_insummary": 1, "marker_overall": 0, "comma_per_word": 1 / 14},
    "one\n\n\ntwo": {"char_repeat_run_count": 0, "word_count": 2, "avg_word_len": 3.0},
    "": {"char_len": 0, "word_count": 0, "sentence_count": 1, "avg_word_len": 0.0, "log_char_len": 0.0},
}


def test_values_counted_by_hand(spark):
    keys = list(BY_HAND)
    for r in with_scalar_features(texts(spark, keys), "text").collect():
        for name, value in BY_HAND[keys[r["id"]]].items():
            assert r[name] == pytest.approx(value, abs=1e-9), (name, keys[r["id"]])
            assert plain.scalar(keys[r["id"]])[name] == pytest.approx(value, abs=1e-9), (name, keys[r["id"]])


def test_adversarial_texts(spark):
    check(spark, plain.ADVERSARIAL + [None])


def test_documents(spark, sf):
    docs = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").select("html").collect()]
    check(spark, docs + pages)


ALPHABET = "aAbBcC1٣ \t\n .!?,_'-éÉßΣſıİKⅧ²😀 "


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(ALPHABET, max_size=40), min_size=60, max_size=120))
def test_random_texts(spark, values):
    check(spark, values)


def test_scan_is_one_pass_without_shuffle(spark, sf):
    df = with_scalar_features(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), "text")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert "lang" not in plan


def test_tokens(spark):
    df = texts(spark, plain.ADVERSARIAL)
    t = F.col("text")
    rows = (
        df.withColumn("kept", tk.drop_stop_words(tk.word_tokens(t), tk.ENGLISH_STOP_WORDS))
        .select(
            "text",
            tx.ws_tokens(t).alias("ws"),
            tx.sentence_pieces(t).alias("sents"),
            tk.word_tokens(t).alias("words"),
            tk.embedding_tokens(t).alias("emb"),
            tk.word_ngrams(F.col("kept"), 1, 2).alias("grams"),
        )
        .collect()
    )
    import re

    for r in rows:
        assert r.ws == r.text.split()
        assert r.sents == re.split(r"[.!?]+\s+|[.!?]+$", r.text.strip())
        assert r.words == plain.word_terms(r.text)
        assert r.emb == plain.embedding_tokens(r.text)
        assert r.grams == plain.word_grams(r.text, set(tk.ENGLISH_STOP_WORDS), 1, 2)


def test_stop_words_match_spark(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert sorted(tk.ENGLISH_STOP_WORDS) == sorted(StopWordsRemover.loadDefaultStopWords("english"))
