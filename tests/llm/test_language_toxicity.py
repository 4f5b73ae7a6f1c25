import itertools

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cases import ROWS, awkward
from inkgrain.llm.language import Pieces, judged_languages, predict_languages, train_languages
from inkgrain.llm.toxicity import Machine, fit_machine, hashed_terms, judged_toxicity, score_toxicity, train_toxicity

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def segmentations(word, pieces):
    n = len(word)
    for cuts in itertools.product((0, 1), repeat=n - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), n]
        parts = [word[a:b] for a, b in zip(at, at[1:])]
        ids = [pieces.index(p) if p in pieces else len(pieces) if len(p) == 1 else None for p in parts]
        if None not in ids:
            yield ids


def test_forward_and_expected_against_all_segmentations():
    rng = np.random.default_rng(0)
    pieces = ["a", "b", "ab", "ba", "aba", "bb", "▁a", "▁"]
    p = rng.random((len(pieces) + 2, 3)) * 0.3
    p[-1] = 0
    table = Pieces(pieces)
    words = ["".join(x) for n in range(1, 6) for x in itertools.product("abc", repeat=n)][:200] + ["▁abab"]
    scores = table.log_likelihood(words, p)
    total = np.zeros_like(p)
    for w, s in zip(words, scores):
        each = [np.prod(p[ids], axis=0) for ids in segmentations(w, pieces)]
        assert np.allclose(np.exp(s), np.sum(each, axis=0))
        for ids, q in zip(segmentations(w, pieces), each):
            for i in ids:
                total[i] += q / np.sum(each, axis=0)
    assert np.allclose(table.expected(words, np.ones((len(words), 3)), p), total)


@pytest.mark.parametrize("n", [16, 17, 18])
def test_expected_pieces_of_long_words(n):
    rng = np.random.default_rng(n)
    pieces = ["a", "b", "ab", "bab"]
    p = rng.random((len(pieces) + 2, 2)) * 1e-15
    p[-1] = 0
    word = "".join(rng.choice(list("ab"), n))
    each = [(ids, np.log(p[ids]).sum(axis=0)) for ids in segmentations(word, pieces)]
    top = max(q.max() for _, q in each)
    each = [(ids, np.exp(q - top)) for ids, q in each]
    total = np.zeros_like(p)
    for ids, q in each:
        for i in ids:
            total[i] += q / sum(q for _, q in each)
    assert np.allclose(Pieces(pieces).expected([word], np.ones((1, 2)), p), total)


def test_expected_pieces_of_sixty_letters():
    """Every segmentation has as many letters as the word; a run of one letter has one segmentation."""
    pieces = ["a", "ab", "b", "x"]
    p = np.full((len(pieces) + 2, 2), 1e-9)
    p[-1] = 0
    got = Pieces(pieces).expected(["ab" * 30, "x" * 60], np.array([[1.0, 2.0], [3.0, 0.0]]), p)
    assert np.allclose(got[0] + 2 * got[1] + got[2], [60, 120])
    assert np.allclose(got[3], [180, 0])


def test_long_runs_do_not_underflow():
    table = Pieces(["a", "b"])
    p = np.full((4, 2), 1e-12)
    p[-1] = 0
    got = table.log_likelihood(["ab" * 30], p)
    assert np.allclose(got, 60 * np.log(1e-12))


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = judged_languages(docs, VOCABULARY).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == docs.count() and len(held) > 200
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_awkward(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = train_languages(docs, VOCABULARY)
    got = predict_languages(awkward(spark), model).collect()
    assert len(got) == len(ROWS)
    by = {r["doc_id"]: r for r in got}
    for d in (4, 5, 6, 9):
        assert (by[d]["lang_pred"], by[d]["score"]) == ("und", 0.0)
    assert predict_languages(awkward(spark, []), model).count() == 0
    odd = spark.createDataFrame([(1, "½ ²"), (2, "Ⅷ"), (3, "① 12 _"), (4, "½a")], "doc_id long, text string")
    assert [r["lang_pred"] == "und" for r in predict_languages(odd, model).orderBy("doc_id").collect()] == [True, True, True, False]
    unknown = train_languages(docs.withColumn("lang", F.lit(None).cast("string")), VOCABULARY)
    assert {r["lang_pred"] for r in predict_languages(awkward(spark), unknown).collect()} == {"und"}


def test_language_labels_of_held_out_rows_are_not_read(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit("zz")).otherwise(F.col("lang")))
    assert "zz" not in {r["lang_pred"] for r in judged_languages(wrong, VOCABULARY).collect()}


def test_machine_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    m = Machine({}, 0.3, rng.normal(size=6), rng.normal(size=(6, 4)))
    for present in ([], [2], [0, 3, 5]):
        pairs = sum(m.factors[a] @ m.factors[b] for a, b in itertools.combinations(present, 2))
        assert m.logit(present) == pytest.approx(0.3 + m.weights[present].sum() + pairs)


def test_machine_learns_an_interaction():
    """Neither term alone is bad, both together are: a linear model cannot say so."""
    rows = [[0], [1], [0, 1], []] * 300
    labels = np.array([0, 0, 1, 0] * 300, dtype=float)
    m = fit_machine([10, 11], rows, labels)
    assert m.score([0, 1]) > 0.5 > max(m.score([0]), m.score([1]), m.score([]))


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = judged_toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [(r["toxic"], r["predicted"]) for r in got if r["held_out"]]
    caught = np.mean([p for t, p in held if t])
    wrong = np.mean([p for t, p in held if not t])
    assert caught > 0.85 and wrong < 0.02  # a tenth of the labels here are on junk without any term of abuse, (caught, wrong)


def pair_rows(n, seed):
    """An insult and a group's name are harmless alone and toxic together; rows with the group are as toxic as all."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        kind = "both" if i % 100 < 1 else "group" if i % 100 < 10 else "insult" if i % 100 < 13 else "slur" if i % 10 == 4 else "rest"
        text = " ".join(f"w{k}" for k in rng.integers(0, 2000, 30))
        text += " zorblat" * (kind in ("both", "group")) + " dimwit" * (kind in ("both", "insult")) + " scumbag" * (kind == "slur")
        rows.append((i, text, int(kind in ("both", "slur")), kind))
    return rows


def test_toxicity_learns_a_pair_of_a_neutral_term(spark):
    rows, fresh = pair_rows(4000, 1), pair_rows(1000, 2)
    y = np.array([r[2] for r in rows])
    group = np.array(["zorblat" in r[1] for r in rows])
    z = (y[group].sum() - group.sum() * y.mean()) / np.sqrt(group.sum() * y.mean() * (1 - y.mean()))
    assert abs(z) < 2
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    machine = train_toxicity(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    assert set(hashed_terms("zorblat")) <= set(machine.terms)
    got = {r["doc_id"]: r["predicted"] for r in score_toxicity(spark.createDataFrame([r[:2] for r in fresh], "doc_id long, text string"), machine).collect()}
    right = {k: np.mean([got[i] == y for i, _, y, kind in fresh if kind == k]) for k in ("both", "group", "insult", "slur", "rest")}
    assert min(right.values()) >= 0.9, right


def test_every_term_of_the_sample_takes_part(spark):
    docs = spark.createDataFrame([(i, f"only{i} common {'vile' if i % 4 == 0 else 'kind'}") for i in range(40)], "doc_id long, text string")
    machine = train_toxicity(docs, docs.selectExpr("doc_id", "int(doc_id % 4 = 0) as toxic"))
    used = {t for i in range(40) for w in (f"only{i}", "common", "vile", "kind") for t in hashed_terms(w)}
    assert set(machine.terms) == used and (machine.weights != 0).all() and (machine.factors != 0).all()


def test_toxicity_awkward(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    odd = labels.select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (0, None), (1, 0), (1, 1)], "doc_id long, toxic int"))
    machine = train_toxicity(docs, odd)
    got = score_toxicity(awkward(spark), machine).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (4, 5, 6)}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert score_toxicity(awkward(spark, []), machine).count() == 0
    again = docs.select("doc_id", "text").unionByName(docs.select("doc_id", F.concat("text", F.lit(" zzz")).alias("text"))).unionByName(docs.select("doc_id", "text"))
    one = train_toxicity(again, odd)  # rows that repeat an id are one row of the sample
    assert one.bias == machine.bias and (one.weights == machine.weights).all()
    nothing = train_toxicity(docs, labels.limit(0))
    assert {r["predicted"] for r in score_toxicity(awkward(spark), nothing).collect()} == {0}
