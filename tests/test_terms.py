from collections import Counter

import pytest
from pyspark.sql import functions as F

import plain
from inkgrain.functions.tokens import ENGLISH_STOP_WORDS
from inkgrain.operators import impchi
from inkgrain.operators.blocks import class_counts, CharTfidfSelector, MeanVectorEmbedder, TfidfSelectorModel, WordTfidfSelector
from inkgrain.operators.embedding import pooled_vectors
from inkgrain.operators.lookup import LookupLimits, lookup_join
from inkgrain.operators.store import new_path, write_table
from inkgrain.operators.terms import CharTerms, WordTerms, by_id, doc_frequency, smooth_idf, term_counts, tfidf_weights
from inkgrain.sources.tables import scanned_bytes

COLUMNS = {"idCol": "doc_id", "textCol": "text", "labelCol": "label"}
SHUFFLED = LookupLimits(broadcast_bytes=0, hot_keys=5)


@pytest.fixture(scope="module")
def docs(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", (F.col("doc_id") % 3).cast("int").alias("label"))
    extra = spark.createDataFrame([(10_001, "", 0), (10_002, None, 1), (10_003, "a the I", 2)], rows.schema)
    return write_table(rows.unionByName(extra).repartition(6), "docs")


@pytest.fixture(scope="module")
def local(docs):
    rows = docs.collect()
    return {r.doc_id: r.text or "" for r in rows}, {r.doc_id: r.label for r in rows}


ANALYSERS = {
    "word": (WordTerms(1, 2), 3, lambda t: plain.word_grams(t, set(ENGLISH_STOP_WORDS), 1, 2)),
    "char": (CharTerms(), 5, lambda t: plain.char_grams(t, 3, 5)),
}


def spark_weights(docs, terms, min_df, limits=LookupLimits()):
    vocab = write_table(smooth_idf(doc_frequency(docs, "doc_id", "text", terms, min_df), docs.count()), "vocabulary")
    counts = term_counts(docs, "doc_id", "text", terms, keep=["label"])
    return tfidf_weights(counts, vocab, "doc_id", limits), vocab


@pytest.mark.parametrize("kind", ["word", "char"])
@pytest.mark.parametrize("limits", [LookupLimits(), SHUFFLED])
def test_weights(docs, local, kind, limits):
    terms, min_df, analyse = ANALYSERS[kind]
    want, _ = plain.tfidf(local[0], analyse, min_df)
    weights, _ = spark_weights(docs, terms, min_df, limits)
    got = {d: {} for d in local[0]}
    for r in weights.where("weight IS NOT NULL").collect():
        got[r.doc_id][r.term] = r.weight
    assert got.keys() == want.keys()
    for d in want:
        assert got[d] == pytest.approx(want[d], abs=1e-9)
        assert not got[d] or sum(w * w for w in got[d].values()) == pytest.approx(1)


def test_scores_and_selection(docs, local):
    terms, min_df, analyse = ANALYSERS["word"]
    texts, labels = local
    want = plain.chi2(plain.tfidf(texts, analyse, min_df)[0], labels)
    weights, _ = spark_weights(docs, terms, min_df)
    counts = {x: list(labels.values()).count(x) for x in set(labels.values())}
    scores = write_table(impchi.chi2_scores(weights, counts, "label"), "scores")
    got = {(r.term, r.label): r.chi2 for r in scores.collect()}
    assert got == pytest.approx(want, abs=1e-9)

    best = {x: [t for _, t in sorted((-round(v, 9), t) for (t, y), v in want.items() if y == x)[:7]] for x in counts}
    top = impchi.top_terms(scores, 7).collect()
    assert {x: [r.term for r in sorted(top, key=lambda r: r.rank) if r.label == x] for x in counts} == best
    union = sorted({t for b in best.values() for t in b})
    picked = impchi.selected_vocabulary(impchi.top_terms(scores, 7)).orderBy("idx").collect()
    assert [(r.idx, r.term) for r in picked] == list(enumerate(union))
    assert all(r.labels == sorted(x for x in counts if r.term in best[x]) for r in picked)


def test_many_ranks(docs):
    """More ranks than the optimizer pushes down."""
    weights, _ = spark_weights(docs, WordTerms(1, 1), 3)
    scores = write_table(impchi.chi2_scores(weights, {0: 68, 1: 68, 2: 67}, "label"), "scores")
    rows = scores.collect()
    want = {(x, t, i + 1) for x in range(3) for i, (_, t) in enumerate(sorted((-round(r.chi2, 9), r.term) for r in rows if r.label == x)[:1500])}
    assert {(r.label, r.term, r["rank"]) for r in impchi.top_terms(scores, 1500).collect()} == want


def test_many_classes(spark):
    """The plan does not grow with the classes, and no number of them is refused."""
    rows = spark.range(12_000).select(F.col("id").alias("doc_id"), F.col("id").cast("int").alias("label"), F.concat(F.lit("t"), F.col("id") % 3).alias("term"), F.lit(1.0).alias("weight"))
    counts = class_counts(rows, "label")
    assert len(counts) == 12_000
    few = rows.where("label < 300")
    scores = impchi.chi2_scores(few, class_counts(few, "label"), "label")
    assert scores.count() == 900
    assert len(scores._jdf.queryExecution().optimizedPlan().toString().splitlines()) < 20


def test_partitions_grow_with_the_texts(spark, docs):
    assert by_id(docs, "doc_id", partition_bytes=500).rdd.getNumPartitions() > 8 * spark.sparkContext.defaultParallelism
    joined = docs.join(docs.select("doc_id"), "doc_id")
    assert scanned_bytes(joined) < 4 * scanned_bytes(docs)


def test_large_lookup_expands_the_texts_once(docs):
    """Beyond the broadcast limit the plan has as many expansions and scans of the texts as below it."""
    vocab = write_table(smooth_idf(doc_frequency(docs, "doc_id", "text", CharTerms(), 5), docs.count()), "vocabulary")
    counts = term_counts(docs, "doc_id", "text", CharTerms())

    small, large = (tfidf_weights(counts, vocab, "doc_id", x)._jdf.queryExecution().optimizedPlan().toString() for x in (LookupLimits(), SHUFFLED))
    assert large.count("Generate") == small.count("Generate") + 1  # the vocabulary's salts
    assert sum("Relation" in line and "text" in line for line in large.splitlines()) == sum("Relation" in line and "text" in line for line in small.splitlines()) == 1
    assert "Union" not in large


def test_one_class_scores_zero(docs):
    weights, _ = spark_weights(docs, WordTerms(1, 1), 3)
    scores = impchi.chi2_scores(weights.withColumn("label", F.lit(0)), {0: 203}, "label")
    assert scores.where("chi2 <> 0 OR chi2 IS NULL").count() == 0


@pytest.mark.parametrize("stage", [WordTfidfSelector(kPerLabel=5, **COLUMNS), CharTfidfSelector(kPerLabel=5, **COLUMNS)])
def test_selector(spark, docs, local, stage):
    model = stage.fit(docs)
    names = model.get_feature_names_out()
    assert 5 <= len(names) <= 15
    vectors = {r.doc_id: r.features for r in model.features(docs).collect()}
    assert vectors.keys() == local[0].keys()
    assert set(vectors[10_001]) == {0.0}
    picked = {r.idx: r.term for r in model.selected.collect()}
    kind = stage.value("analyzer")
    terms, min_df, analyse = ANALYSERS[kind]
    want, _ = plain.tfidf(local[0], analyse, stage.value("minDf"))
    for d, row in want.items():
        assert vectors[d] == pytest.approx([row.get(picked[i], 0.0) for i in range(len(names))], abs=1e-9)

    again = model.transform(docs.repartition(3))
    attributes = again.schema["char_terms" if kind == "char" else "terms"].metadata["ml_attr"]["attrs"]["numeric"]
    assert [a["name"] for a in attributes] == names
    model.limits = SHUFFLED
    model.size = 1
    shuffled = {r.doc_id: r.features for r in model.features(docs).collect()}
    for d in vectors:
        assert shuffled[d] == pytest.approx(vectors[d], abs=1e-9)

    path = new_path(spark, "model")
    model.save(path)
    back = TfidfSelectorModel.load(path)
    assert back.get_feature_names_out() == names
    for r in back.features(docs).collect():
        assert r.features == pytest.approx(vectors[r.doc_id], abs=1e-9)


def test_selection_does_not_depend_on_partitions(docs):
    stage = WordTfidfSelector(kPerLabel=5, **COLUMNS)
    one = stage.fit(docs.coalesce(1)).selected.orderBy("idx").collect()
    many = stage.fit(docs.repartition(13)).selected.orderBy("idx").collect()
    assert [r.term for r in one] == [r.term for r in many]


def test_no_vocabulary_is_an_error(docs):
    with pytest.raises(ValueError, match="no term"):
        WordTfidfSelector(minDf=10_000, **COLUMNS).fit(docs)


def test_text_is_shuffled_once_and_stays_in_place(docs):
    model = WordTfidfSelector(kPerLabel=5, **COLUMNS).fit(docs)
    plan = model.features(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_top_terms_are_cut_before_the_shuffle(docs):
    weights, _ = spark_weights(docs, WordTerms(1, 1), 3)
    top = impchi.top_terms(impchi.chi2_scores(weights, {0: 68, 1: 68, 2: 67}, "label"), 5)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("WindowGroupLimit")[2].splitlines()[0]


def test_a_hot_key_of_unknown_frequency_is_dealt_out(spark):
    key = F.when(F.col("id") % 10 != 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 700))
    rows = spark.range(20_000).withColumn("key", key)
    table = spark.range(700).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.col("id").alias("x")).union(spark.sql("SELECT 'hot', -1L"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", False)
        spark.conf.set("spark.sql.shuffle.partitions", 16)
        joined = lookup_join(rows, table, "key", LookupLimits(0, 8, 64))
        got = joined.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {(r["id"], r["x"]) for r in got} == {(i, -1 if i % 10 else i % 700) for i in range(20_000)} and len(got) == 20_000
    tasks = Counter(r["task"] for r in got if r["key"] == "hot")
    assert len(tasks) > 8 and max(tasks.values()) < 18_000 / 4


def test_lookup_join_keeps_every_row(spark):
    # A hot key that is known, a hot key that is not, and many rows without a key.
    keys = ["hot"] * 500 + ["gone"] * 400 + [None] * 300 + [f"k{i}" for i in range(200)]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, key string")
    table = spark.createDataFrame([("hot", 1.0)] + [(f"k{i}", float(i)) for i in range(0, 200, 2)], "key string, x double")
    small = set(lookup_join(rows, table, "key").select("id", "key", "x").collect())
    large = set(lookup_join(rows, table, "key", LookupLimits(0, 3)).select("id", "key", "x").collect())
    counted = table.withColumn("df", F.when(F.col("key") == "hot", 500).otherwise(1))
    salted = lookup_join(rows, counted, "key", LookupLimits(0, 3, 8), frequency="df").select("id", "key", "x").collect()
    assert small == large == set(salted) and len(large) == len(salted) == len(keys)


def test_pooled_vectors(spark, docs, local):
    words = sorted({w for t in local[0].values() for w in plain.embedding_tokens(t)})[::3]
    values = {w: [float((i * 7 + j) % 5) - 2 for j in range(4)] for i, w in enumerate(words)}
    vectors = write_table(spark.createDataFrame(list(values.items()), "word string, vector array<float>"), "vectors")
    texts = docs.unionByName(spark.createDataFrame([(10_004, "qqqqzzzz unknown!", 0)], docs.schema))
    want = {}
    for r in texts.collect():
        known = [values[w] for w in plain.embedding_tokens(r.text or "") if w in values]
        want[r.doc_id] = [sum(v[j] for v in known) / len(known) if known else 0.0 for j in range(4)]
    for limits in (LookupLimits(), SHUFFLED):
        got = {r.doc_id: r.features for r in pooled_vectors(texts, "doc_id", "text", vectors, 4, limits).collect()}
        assert got.keys() == want.keys()
        for d in want:
            assert got[d] == pytest.approx(want[d], abs=1e-9)


def test_embedder_checks_its_table(spark):
    def path(rows):
        return write_table(spark.createDataFrame(rows, "word string, vector array<float>"), "v").inputFiles()[0].rsplit("/", 1)[0]

    with pytest.raises(ValueError, match="more than one"):
        MeanVectorEmbedder(vectorsPath=path([("a", [1.0]), ("a", [2.0])])).fit_vectors(spark)
    with pytest.raises(ValueError, match="dimensions"):
        MeanVectorEmbedder(vectorsPath=path([("a", [1.0]), ("b", [2.0, 1.0])])).fit_vectors(spark)
    model = MeanVectorEmbedder(vectorsPath=path([("a", [1.0]), ("b", [2.0])])).fit_vectors(spark)
    assert model.get_feature_names_out() == ["glove_0"]
