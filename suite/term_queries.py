"""Term statistics, selection, pooled vectors and the union of the blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkgrain.functions.scalar import FEATURE_NAMES
from inkgrain.operators import impchi
from inkgrain.operators.blocks import CharTfidfSelector, MeanVectorEmbedder, WordTfidfSelector, class_counts
from inkgrain.operators.store import write_table
from inkgrain.operators.terms import (
    CharTerms,
    WordTerms,
    doc_frequency,
    smooth_idf,
    term_counts,
    text_weights,
)
from inkgrain.operators.union import TextFeatures
from inkgrain.sources.tables import read_table
from suite import fixtures as fx
from suite.registry import query
from suite.text_queries import SCALAR_SQL, scalar_sql

WORDS, CHARS = WordTerms(1, 1), CharTerms()
COLUMNS = {"idCol": "doc_id", "textCol": "text", "labelCol": "label"}

# CTE chains shared by several queries.
WORD_ALL = f"{fx.word_counts('documents')}, {fx.weights('documents', 3)}"
WORD_FIT = f"{fx.LABELLED}, {fx.word_counts('labelled', hi=2)}, {fx.weights('labelled', 3)}, {fx.scores()}"
CHAR_FIT = f"{fx.LABELLED}, {fx.char_counts('labelled')}, {fx.weights('labelled', 5)}, {fx.scores()}"
K_WORD, K_CHAR = 10, 8


def vocabulary(docs, terms, min_df):
    """The written vocabulary of a corpus with its idf."""
    frequencies = doc_frequency(docs, "doc_id", "text", terms, min_df)
    return write_table(smooth_idf(frequencies, docs.count()), "vocabulary")


def fit_weights(spark, sf, terms, min_df):
    docs = write_table(fx.labelled(spark, sf, "text"), "labelled")
    vocab = vocabulary(docs, terms, min_df)
    return text_weights(docs, vocab, "doc_id", "text", terms, ["label"]), class_counts(docs, "label")


def top(spark, sf, terms, min_df, k):
    weights, classes = fit_weights(spark, sf, terms, min_df)
    return impchi.top_terms(impchi.chi2_scores(weights, classes, "label"), k)


@query("term_frequency", f"WITH {fx.word_counts('documents')} SELECT * FROM counts")
def term_frequency(spark, sf):
    return term_counts(fx.texts(spark, sf), "doc_id", "text", WORDS).where("term IS NOT NULL")


@query("doc_frequency", f"""
WITH {fx.word_counts('documents', hi=2)} SELECT term, count(*) AS df FROM counts GROUP BY term HAVING count(*) >= 3""")
def document_frequency(spark, sf):
    return doc_frequency(fx.texts(spark, sf), "doc_id", "text", WordTerms(1, 2), 3)


@query("smooth_idf", f"WITH {WORD_ALL} SELECT term, df, round(idf, 6) AS idf FROM vocab_weights")
def idf(spark, sf):
    docs = fx.texts(spark, sf)
    table = smooth_idf(doc_frequency(docs, "doc_id", "text", WORDS, 3), docs.count())
    return table.withColumn("idf", F.round("idf", 6))


@query("tfidf_word", f"WITH {WORD_ALL} SELECT doc_id, term, tf, round(weight, 6) AS weight FROM weights")
def tfidf_word(spark, sf):
    docs = fx.texts(spark, sf)
    weights = text_weights(docs, vocabulary(docs, WORDS, 3), "doc_id", "text", WORDS)
    return weights.withColumn("weight", F.round("weight", 6))


@query("tfidf_char_terms", f"""
WITH {fx.char_counts('documents')}, {fx.weights('documents', 5)}
SELECT doc_id, term, tf, round(weight, 6) AS weight FROM weights""")
def tfidf_char_terms(spark, sf):
    docs = fx.texts(spark, sf)
    weights = text_weights(docs, vocabulary(docs, CHARS, 5), "doc_id", "text", CHARS)
    return weights.where("weight IS NOT NULL").withColumn("weight", F.round("weight", 6))


@query("tfidf_char", f"""
WITH {fx.char_counts('documents')}, {fx.weights('documents', 5)}
SELECT doc_id, count(*) AS terms, CAST(sum(tf) AS BIGINT) AS tf, round(sum(weight), 6) AS total, round(max(weight), 6) AS largest
FROM weights GROUP BY doc_id""")
def tfidf_char(spark, sf):
    docs = fx.texts(spark, sf)
    weights = text_weights(docs, vocabulary(docs, CHARS, 5), "doc_id", "text", CHARS)
    return (
        weights.where("weight IS NOT NULL")
        .groupBy("doc_id")
        .agg(
            F.count("*").alias("terms"),
            F.sum("tf").alias("tf"),
            F.round(F.sum("weight"), 6).alias("total"),
            F.round(F.max("weight"), 6).alias("largest"),
        )
    )


@query("tfidf_transform_unseen", f"""
WITH {fx.word_counts('documents', hi=2, name='fitted')}, {fx.weights('documents', 3, counts='fitted')},
{fx.word_counts('benchmark', hi=2, id_col='item_id')}
SELECT item_id, term, tf, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY item_id)), 6) AS weight
FROM (SELECT item_id, term, tf, (1 + ln(tf)) * idf AS raw FROM counts JOIN vocab_weights USING (term))""")
def tfidf_transform_unseen(spark, sf):
    terms = WordTerms(1, 2)
    fitted = vocabulary(fx.texts(spark, sf), terms, 3)
    unseen = read_table(spark, sf, "benchmark").select("item_id", "text")
    weights = text_weights(unseen, fitted, "item_id", "text", terms)
    return weights.withColumn("weight", F.round("weight", 6))


@query("impchi_scores", f"WITH {WORD_FIT} SELECT term, label, round(chi2, 6) AS chi2 FROM scores")
def impchi_scores(spark, sf):
    weights, classes = fit_weights(spark, sf, WordTerms(1, 2), 3)
    return impchi.chi2_scores(weights, classes, "label").withColumn("chi2", F.round("chi2", 6))


def top_sql(fit, k):
    return f"WITH {fit}, {fx.top(k)} SELECT label, CAST(rank AS INTEGER) AS rank, term, round(chi2, 6) AS chi2 FROM best"


@query("impchi_topk_word", top_sql(WORD_FIT, K_WORD))
def impchi_topk_word(spark, sf):
    return top(spark, sf, WordTerms(1, 2), 3, K_WORD).select("label", "rank", "term", F.round("chi2", 6).alias("chi2"))


@query("impchi_topk_char", top_sql(CHAR_FIT, K_CHAR))
def impchi_topk_char(spark, sf):
    return top(spark, sf, CHARS, 5, K_CHAR).select("label", "rank", "term", F.round("chi2", 6).alias("chi2"))


@query("impchi_vocabulary", f"""
WITH {WORD_FIT}, {fx.top(K_WORD)}
SELECT CAST(idx AS INTEGER) AS idx, term, round(idf, 6) AS idf, array_to_string(labels, ',') AS labels
FROM best_v JOIN vocab_weights USING (term)""")
def impchi_vocabulary(spark, sf):
    model = WordTfidfSelector(kPerLabel=K_WORD, **COLUMNS).fit(write_table(fx.labelled(spark, sf, "text"), "labelled"))
    labels = F.concat_ws(",", F.transform("labels", lambda x: x.cast("string"))).alias("labels")
    return model.selected.select("idx", "term", F.round("idf", 6).alias("idf"), labels)


def names_sql(fit, k, name):
    suffix = "array_to_string(list_sort(list_transform(labels, lambda x: CAST(x AS VARCHAR))), '_')"
    return f"WITH {fit}, {fx.top(k)} SELECT CAST(idx AS INTEGER) AS idx, {name.format(suffix)} AS name FROM best_v"


@query("feature_names_word", names_sql(WORD_FIT, K_WORD, "term || '_labels_' || {}"))
def feature_names_word(spark, sf):
    model = WordTfidfSelector(kPerLabel=K_WORD, **COLUMNS).fit(write_table(fx.labelled(spark, sf, "text"), "labelled"))
    return model.selected.select("idx", "name")


@query("feature_names_char", names_sql(CHAR_FIT, K_CHAR, "'char_' || trim(term) || '_lbl_' || {}"))
def feature_names_char(spark, sf):
    model = CharTfidfSelector(kPerLabel=K_CHAR, **COLUMNS).fit(write_table(fx.labelled(spark, sf, "text"), "labelled"))
    return model.selected.select("idx", "name")


# All documents weighted by the vocabulary that the labelled ones gave.
def applied(fit, counts, k, name):
    return f"""{fit}, {fx.top(k)}, {counts},
{name} AS (SELECT doc_id, idx, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS value
  FROM (SELECT doc_id, term, (1 + ln(tf)) * idf AS raw FROM every JOIN vocab_weights USING (term)) LEFT JOIN best_v USING (term))"""


@query("feature_slice", f"""
WITH {applied(WORD_FIT, fx.word_counts('documents', hi=2, name='every'), K_WORD, 'slice')}
SELECT doc_id, CAST(idx AS INTEGER) AS idx, round(value, 6) AS value FROM slice WHERE idx IS NOT NULL""")
def feature_slice(spark, sf):
    model = WordTfidfSelector(kPerLabel=K_WORD, **COLUMNS).fit(write_table(fx.labelled(spark, sf, "text"), "labelled"))
    found = model.features(fx.texts(spark, sf)).select("doc_id", F.posexplode("features").alias("idx", "value"))
    return found.where("value <> 0").withColumn("value", F.round("value", 6))


def vector_stage(spark, sf):
    """The fitted embedder for the tokens of the documents."""
    path = write_table(fx.word_vectors(spark, sf), "vectors").inputFiles()[0].rsplit("/", 1)[0]
    return MeanVectorEmbedder(vectorsPath=path, **COLUMNS).fit_vectors(spark)


@query("doc_vectors", f"WITH {fx.VECTORS} SELECT doc_id, CAST(dim AS INTEGER) AS dim, round(value, 6) + 0.0 AS value FROM pooled")
def doc_vectors(spark, sf):
    pooled = vector_stage(spark, sf).features(fx.texts(spark, sf))
    return pooled.select("doc_id", F.posexplode("features").alias("dim", "value")).withColumn(
        "value", F.round("value", 6) + F.lit(0.0)
    )


def union_sql():
    block = lambda cte, total: f"(SELECT doc_id, round({total}, 5) AS {cte} FROM {cte}_rows GROUP BY doc_id)"
    word = applied(WORD_FIT, fx.word_counts("documents", hi=2, name="every"), K_WORD, "slice")
    char = applied(CHAR_FIT, fx.char_counts("documents", name="every"), K_CHAR, "slice")
    scalar = scalar_sql(FEATURE_NAMES).replace(fx.MARKED_EXPR, "text")
    total = " + ".join(FEATURE_NAMES)
    return f"""
SELECT doc_id, round(s.scalar, 3) AS scalar, round(e.embedding, 4) + 0.0 AS embedding,
  round(coalesce(w.word, 0), 5) AS word, round(coalesce(c.chars, 0), 5) AS chars
FROM (SELECT doc_id, {total} AS scalar FROM ({scalar})) s
JOIN (WITH {fx.VECTORS} SELECT doc_id, sum(value) AS embedding FROM pooled GROUP BY doc_id) e USING (doc_id)
LEFT JOIN (WITH {word} SELECT doc_id, sum(value) AS word FROM slice WHERE idx IS NOT NULL GROUP BY doc_id) w USING (doc_id)
LEFT JOIN (WITH {char} SELECT doc_id, sum(value) AS chars FROM slice WHERE idx IS NOT NULL GROUP BY doc_id) c USING (doc_id)"""


@query("feature_union", union_sql())
def feature_union(spark, sf):
    from pyspark.ml.functions import vector_to_array

    blocks = [vector_stage(spark, sf), WordTfidfSelector(kPerLabel=K_WORD), CharTfidfSelector(kPerLabel=K_CHAR)]
    stage = TextFeatures(blocks, **COLUMNS)
    model = stage.fit(write_table(fx.labelled(spark, sf, "text"), "labelled"))
    rows = model.transform(fx.texts(spark, sf)).select("doc_id", vector_to_array("features").alias("f"))
    widths = [len(FEATURE_NAMES)] + [len(b.get_feature_names_out()) for b in model.blocks]
    sums, start = [], 1
    for name, width, digits in zip(("scalar", "embedding", "word", "chars"), widths, (3, 4, 5, 5)):
        part = F.slice("f", start, width)
        total = F.aggregate(part, F.lit(0.0), lambda a, x: a + x)
        sums.append((F.round(total, digits) + F.lit(0.0)).alias(name))
        start += width
    return rows.select("doc_id", *sums)


def slots_sql():
    """Every slot that is not zero, with its place in the whole vector."""
    word = applied(WORD_FIT, fx.word_counts("documents", hi=2, name="every"), K_WORD, "slice")
    char = applied(CHAR_FIT, fx.char_counts("documents", name="every"), K_CHAR, "slice")
    scalar = scalar_sql(FEATURE_NAMES).replace(fx.MARKED_EXPR, "text")
    each = ", ".join(f"CAST({n} AS DOUBLE)" for n in FEATURE_NAMES)
    first, dims = len(FEATURE_NAMES), 64
    return f"""
SELECT doc_id, CAST(idx AS INTEGER) AS idx, round(value, 6) + 0.0 AS value FROM (
  SELECT doc_id, unnest(range({first})) AS idx, unnest([{each}]) AS value FROM ({scalar})
  UNION ALL (WITH {fx.VECTORS} SELECT doc_id, {first} + dim, value FROM pooled)
  UNION ALL (WITH {word} SELECT doc_id, {first + dims} + idx, value FROM slice WHERE idx IS NOT NULL)
  UNION ALL (WITH {char} SELECT doc_id, {first + dims} + (WITH {WORD_FIT}, {fx.top(K_WORD)} SELECT count(*) FROM best_v) + idx, value
    FROM slice WHERE idx IS NOT NULL))
WHERE round(value, 6) <> 0"""


@query("feature_union_slots", slots_sql())
def feature_union_slots(spark, sf):
    from pyspark.ml.functions import vector_to_array

    blocks = [vector_stage(spark, sf), WordTfidfSelector(kPerLabel=K_WORD), CharTfidfSelector(kPerLabel=K_CHAR)]
    model = TextFeatures(blocks, **COLUMNS).fit(write_table(fx.labelled(spark, sf, "text"), "labelled"))
    rows = model.transform(fx.texts(spark, sf)).select("doc_id", F.posexplode(vector_to_array("features")).alias("idx", "value"))
    return rows.withColumn("value", F.round("value", 6) + F.lit(0.0)).where("value <> 0")
