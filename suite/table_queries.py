"""Sources and sinks, splits, metrics, probabilities and unions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from inkgrain.functions import probability as pr
from inkgrain.functions.names import CLASS_NAMES, with_class_name
from inkgrain.operators import metrics as mt
from inkgrain.operators.rowid import dense_row_id
from inkgrain.operators.splits import stratified_folds, stratified_split
from inkgrain.operators.store import new_path
from inkgrain.plans.pseudo import pseudo_labels, union_pseudo_labels
from inkgrain.plans.search import best_trial
from inkgrain.sources import csv
from inkgrain.sources.tables import read_table
from inkgrain.sources.vectors import read_vectors
from inkgrain.sources.wordbin import write_word2vec
from suite import fixtures as fx
from suite.registry import query

LABELS = [10, 20, 30]  # class values that differ from their positions


@query("csv_scan", f"""
WITH {fx.LABELLED} SELECT doc_id AS id, {fx.CSV_EXPR} AS text, CAST(label AS INTEGER) AS label FROM labelled""")
def csv_scan(spark, sf):
    rows = fx.labelled(spark, sf, "text").select(
        F.col("doc_id").alias("id"), F.expr(fx.CSV_EXPR).alias("TEXT"), F.col("label").alias("LABEL")
    )
    path = new_path(spark, "texts")
    csv.write_texts(rows, path)
    back = csv.read_labelled(spark, path, id_col="id", id_type=LongType())
    return back.select("id", F.coalesce("TEXT", F.lit("")).alias("text"), F.col("LABEL").alias("label"))


@query("csv_split", f"""
WITH {fx.LABELLED} SELECT doc_id AS id, {fx.CSV_EXPR} AS text, CAST(label AS INTEGER) AS label,
  row_number() OVER (ORDER BY doc_id) - 1 AS place FROM labelled""")
def csv_split(spark, sf):
    """Quoted files read by all their parts at once; rows are numbered in the order of files and lines."""
    rows = fx.labelled(spark, sf, "text").select(F.col("doc_id").alias("id"), F.expr(fx.CSV_EXPR).alias("TEXT"), F.col("label").alias("LABEL"))
    path = new_path(spark, "texts")
    csv.write_texts(rows.orderBy("id"), path)
    back = csv.read_labelled(spark, path, id_col="id", id_type=LongType(), split=True, place_col="at")
    back = dense_row_id(back, "place", order_by="at")
    return back.select("id", F.coalesce("TEXT", F.lit("")).alias("text"), F.col("LABEL").alias("label"), "place")


@query("vector_table_parse", """
SELECT 'w' || vec_id AS word, CAST(unnest(range(len(embedding))) AS INTEGER) AS dim,
  round(CAST(unnest(embedding) AS DOUBLE), 6) AS value FROM embeddings""")
def vector_table_parse(spark, sf):
    numbers = F.concat_ws(" ", F.transform("embedding", lambda x: x.cast("string")))
    lines = read_table(spark, sf, "embeddings").select(F.concat(F.lit("w"), "vec_id", F.lit(" "), numbers))
    path = new_path(spark, "vectors")
    lines.write.text(path)
    table = read_vectors(spark, path, "text")
    long = table.select("word", F.posexplode("vector").alias("dim", "value"))
    return long.withColumn("value", F.round(F.col("value").cast("double"), 6))


@query("vector_binary_parse", """
SELECT 'w' || vec_id AS word, CAST(unnest(range(len(embedding))) AS INTEGER) AS dim,
  round(CAST(unnest(embedding) AS DOUBLE), 6) AS value FROM embeddings""")
def vector_binary_parse(spark, sf):
    """Binary word2vec files, written and read back by their parts."""
    path = new_path(spark, "vectors")
    write_word2vec(read_table(spark, sf, "embeddings").select(F.concat(F.lit("w"), "vec_id").alias("word"), F.col("embedding").alias("vector")), path, files=3)
    long = read_vectors(spark, path, "word2vec").select("word", F.posexplode("vector").alias("dim", "value"))
    return long.withColumn("value", F.round(F.col("value").cast("double"), 6))


@query("prediction_sink", f"""
WITH {fx.UNLABELLED} SELECT doc_id AS id, {fx.RULE_EXPR} AS label FROM unlabelled""")
def prediction_sink(spark, sf):
    rows = fx.unlabelled(spark, sf, "n_chars").select(F.col("doc_id").alias("id"), F.expr(fx.RULE_EXPR).alias("label"))
    path = new_path(spark, "predictions")
    csv.write_predictions(rows, path)
    return csv.read_predictions(spark, path)


@query("csv_scan_text_ids", """
SELECT 'x' || doc_id AS id, 'text ' || doc_id || chr(10) || 'second line' AS text FROM documents""")
def csv_scan_text_ids(spark, sf):
    rows = fx.documents(spark, sf, "doc_id").select(
        F.concat(F.lit("x"), "doc_id").alias("id"), F.concat(F.lit("text "), "doc_id", F.lit("\nsecond line")).alias("TEXT")
    )
    path = new_path(spark, "texts")
    csv.write_texts(rows, path)
    return csv.read_unlabelled(spark, path, id_col="id").withColumnRenamed("TEXT", "text")


@query("row_id_scan_order", """
SELECT row_number() OVER (ORDER BY doc_id % 4, doc_id) - 1 AS id, 'd' || doc_id AS text FROM documents""")
def row_id_scan_order(spark, sf):
    """Four files of different sizes; ids follow the files and the lines in them."""
    docs = fx.documents(spark, sf, "doc_id")
    folder = new_path(spark, "files")
    for part in range(4):
        lines = docs.where(F.col("doc_id") % 4 == part).coalesce(1).sortWithinPartitions("doc_id")
        csv.write_texts(lines.select(F.concat(F.lit("d"), "doc_id").alias("TEXT")), f"{folder}/part{part}")
    rows = csv.read_unlabelled(spark, f"{folder}/*")
    return dense_row_id(rows, "id").select("id", F.col("TEXT").alias("text"))


@query("dense_row_id", """
SELECT row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS id, doc_id, n_chars FROM documents""")
def row_id(spark, sf):
    return dense_row_id(fx.documents(spark, sf, "doc_id", "n_chars"), "id", order_by=["n_chars", "doc_id"])


NAME_CASES = " ".join(f"WHEN {k} THEN '{v}'" for k, v in CLASS_NAMES.items())


@query("class_name_map", f"SELECT vec_id, label, CASE label {NAME_CASES} END AS class_name FROM embeddings")
def class_name_map(spark, sf):
    return with_class_name(read_table(spark, sf, "embeddings").select("vec_id", "label"), "label")


PROBABILITIES = f"probs AS (SELECT doc_id, n_chars, {fx.PROBABILITIES} FROM documents)"
ARGMAX = "CASE WHEN p0 >= p1 AND p0 >= p2 THEN {} WHEN p1 >= p2 THEN {} ELSE {} END"


@query("confidence_filter", f"""
WITH {PROBABILITIES} SELECT doc_id, round(greatest(p0, p1, p2), 6) AS confidence FROM probs WHERE greatest(p0, p1, p2) >= 0.9::DOUBLE""")
def confidence_filter(spark, sf):
    rows = fx.with_probabilities(fx.documents(spark, sf, "doc_id", "n_chars")).where(pr.is_confident(F.col("p")))
    return rows.select("doc_id", F.round(pr.max_probability(F.col("p")), 6).alias("confidence"))


@query("argmax_class", f"""
WITH {PROBABILITIES} SELECT doc_id, {ARGMAX.format(0, 1, 2)} AS idx, {ARGMAX.format(*LABELS)} AS label FROM probs""")
def argmax_class(spark, sf):
    rows = fx.with_probabilities(fx.documents(spark, sf, "doc_id", "n_chars"))
    p = F.col("p")
    return rows.select("doc_id", pr.argmax_index(p).alias("idx"), pr.argmax_label(p, LABELS).alias("label"))


@query("soft_vote", f"""
WITH {PROBABILITIES}
SELECT doc_id, round((p0 + p1 + p2) / 3, 6) AS v0, round((p1 + p2 + p0) / 3, 6) AS v1, round((p2 + p0 + p1) / 3, 6) AS v2,
  round((p0 + p1 + p0) / 3, 6) AS w0, round((p1 + p2 + p1) / 3, 6) AS w1, round((p2 + p0 + p2) / 3, 6) AS w2
FROM probs""")
def soft_vote(spark, sf):
    rows = fx.with_probabilities(fx.documents(spark, sf, "doc_id", "n_chars"))
    turned = lambda k: F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.col("p")[(i + k) % 3])
    all_three = pr.soft_vote([F.col("p"), turned(1), turned(2)])
    two_of_one = pr.soft_vote([F.col("p"), turned(1), F.col("p")])
    votes = rows.select("doc_id", all_three.alias("v"), two_of_one.alias("w"))
    return votes.select("doc_id", *[F.round(F.col(c)[i], 6).alias(f"{c}{i}") for c in "vw" for i in range(3)])


@query("label_distribution", f"WITH {fx.LABELLED} SELECT label, count(*) AS n FROM labelled GROUP BY label ORDER BY label")
def label_distribution(spark, sf):
    return mt.label_distribution(fx.labelled(spark, sf), "label")


@query("prediction_distribution", f"""
WITH {fx.UNLABELLED} SELECT {fx.RULE_EXPR} AS label, count(*) AS n FROM unlabelled GROUP BY 1 ORDER BY 1""")
def prediction_distribution(spark, sf):
    rows = fx.unlabelled(spark, sf, "n_chars").select(F.expr(fx.RULE_EXPR).alias("label"))
    return mt.label_distribution(rows, "label")


PSEUDO = f"""{fx.LABELLED}, {fx.UNLABELLED},
probs AS (SELECT doc_id, {fx.PROBABILITIES} FROM unlabelled),
pseudo AS (SELECT doc_id, {ARGMAX.format(*LABELS)} AS label FROM probs WHERE greatest(p0, p1, p2) >= 0.9::DOUBLE)"""


def pseudo(spark, sf):
    return pseudo_labels(fx.with_probabilities(fx.unlabelled(spark, sf, "n_chars")), "p", LABELS, "label", 0.90)


@query("pseudo_distribution", f"""
WITH {PSEUDO} SELECT label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent
FROM pseudo GROUP BY label""")
def pseudo_distribution(spark, sf):
    return mt.share_distribution(pseudo(spark, sf), "label").withColumn("percent", F.round("percent", 6))


@query("pseudo_union", f"""
WITH {PSEUDO} SELECT doc_id, CAST(label AS INTEGER) AS label FROM labelled UNION ALL SELECT doc_id, label FROM pseudo""")
def pseudo_union(spark, sf):
    given = fx.labelled(spark, sf)
    return union_pseudo_labels(given, pseudo(spark, sf).select("doc_id", "label"), "label")


RULED = f"{fx.LABELLED}, ruled AS (SELECT doc_id, source, label, {fx.RULE_EXPR} AS prediction FROM labelled)"
CLASS_SCORES = """
classes AS (SELECT {by} label AS class FROM {rows} UNION SELECT {by} prediction FROM {rows}),
class_scores AS (SELECT {cby} c.class,
  count(*) FILTER (r.label = c.class AND r.prediction = c.class) AS tp,
  count(*) FILTER (r.label = c.class) AS support, count(*) FILTER (r.prediction = c.class) AS predicted
  FROM classes c JOIN {rows} r ON {on} (r.label = c.class OR r.prediction = c.class) GROUP BY ALL),
prf AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision,
  CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall, 2 * tp / (support + predicted) AS f1 FROM class_scores)"""
RULED_SCORES = CLASS_SCORES.format(by="", cby="", rows="ruled", on="")


def ruled(spark, sf):
    rows = fx.labelled(spark, sf, "source", "n_chars")
    return rows.select("doc_id", "source", "label", F.expr(fx.RULE_EXPR).alias("prediction"))


@query("confusion_matrix", f"WITH {RULED} SELECT label, prediction, count(*) AS n FROM ruled GROUP BY ALL")
def confusion_matrix(spark, sf):
    return mt.confusion(ruled(spark, sf), "label", "prediction")


@query("macro_f1", f"WITH {RULED}, {RULED_SCORES} SELECT round(avg(f1), 6) AS macro_f1 FROM prf")
def macro_f1(spark, sf):
    return mt.macro_f1(ruled(spark, sf), "label", "prediction").select(F.round("macro_f1", 6).alias("macro_f1"))


@query("classification_report", f"""
WITH {RULED}, {RULED_SCORES},
rows AS (SELECT CAST(class AS VARCHAR) AS class, precision, recall, f1, support FROM prf
UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM prf
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM prf
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), sum(support) FROM prf)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM rows""")
def classification_report(spark, sf):
    report = mt.classification_report(ruled(spark, sf), "label", "prediction")
    return report.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


FOLDS = """folds AS (SELECT {cols}, CAST((row_number() OVER (ORDER BY {label}, md5('42-' || doc_id), doc_id) - 1) % 5 AS INTEGER) AS fold FROM {rows})"""


@query("stratified_folds", f"""
WITH {FOLDS.format(cols='doc_id, lang', label='lang', rows='documents')} SELECT * FROM folds""")
def folds(spark, sf):
    return stratified_folds(fx.documents(spark, sf, "doc_id", "lang"), "lang", "doc_id").select("doc_id", "lang", "fold")


@query("cv_mean_score", f"""
WITH {RULED}, {FOLDS.format(cols='doc_id, label, prediction', label='label', rows='ruled')},
{CLASS_SCORES.format(by='fold,', cby='c.fold,', rows='folds', on='c.fold = r.fold AND')}
SELECT count(*) AS folds, round(avg(f1), 6) AS mean_score FROM (SELECT fold, avg(f1) AS f1 FROM prf GROUP BY fold)""")
def cv_mean_score(spark, sf):
    rows = stratified_folds(ruled(spark, sf), "label", "doc_id")
    scores = mt.macro_f1(rows, "label", "prediction", by=["fold"])
    return scores.agg(F.count("*").alias("folds"), F.round(F.avg("macro_f1"), 6).alias("mean_score"))


@query("stratified_split", """
WITH sizes AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
total AS (SELECT sum(n)::BIGINT AS total, sum(n)::BIGINT - ceil(sum(n) * 0.15::DOUBLE)::BIGINT AS places FROM sizes),
shares AS (SELECT lang, (n * places) // total AS base, (n * places) % total AS rem, places FROM sizes, total),
train AS (SELECT lang, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, lang) <= places - sum(base) OVER () THEN 1 ELSE 0 END AS train FROM shares)
SELECT doc_id, lang, r > train AS is_test FROM
(SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42-' || doc_id), doc_id) AS r FROM documents) JOIN train USING (lang)""")
def split(spark, sf):
    rows = stratified_split(fx.documents(spark, sf, "doc_id", "lang"), "lang", "doc_id")
    return rows.select("doc_id", "lang", "is_test")


NULL_LABEL = "CASE WHEN doc_id % 10 = 0 THEN NULL ELSE doc_id % 3 END"


@query("class_weights_null_labels", f"""
SELECT doc_id, label, round(count(*) OVER () / ((SELECT count(DISTINCT coalesce(label, -1)) FROM t) * count(*) OVER (PARTITION BY label)), 6) AS weight
FROM (SELECT doc_id, {NULL_LABEL} AS label FROM documents) t""".replace("FROM t)", f"FROM (SELECT {NULL_LABEL} AS label FROM documents))"))
def class_weights_null_labels(spark, sf):
    rows = fx.documents(spark, sf, "doc_id").withColumn("label", F.expr(NULL_LABEL))
    return mt.class_weights(rows, "label").withColumn("weight", F.round("weight", 6))


@query("stratified_folds_null_labels", f"""
WITH t AS (SELECT doc_id, {NULL_LABEL} AS label FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42-' || doc_id), doc_id) AS rn FROM t),
s AS (SELECT label, coalesce(sum(n) OVER (ORDER BY label NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
      FROM (SELECT label, count(*) AS n FROM t GROUP BY label))
SELECT doc_id, r.label, CAST((first + rn - 1) % 5 AS INTEGER) AS fold FROM r JOIN s ON r.label IS NOT DISTINCT FROM s.label""")
def stratified_folds_null_labels(spark, sf):
    rows = fx.documents(spark, sf, "doc_id").withColumn("label", F.expr(NULL_LABEL))
    return stratified_folds(rows, "label", "doc_id")


@query("class_weights", f"""
WITH {fx.LABELLED}
SELECT doc_id, label, round(n / (k * n_c), 6) AS weight FROM (SELECT doc_id, label, count(*) OVER () AS n,
  count(*) OVER (PARTITION BY label) AS n_c, (SELECT count(DISTINCT label) FROM labelled) AS k FROM labelled)""")
def class_weights(spark, sf):
    return mt.class_weights(fx.labelled(spark, sf), "label").withColumn("weight", F.round("weight", 6))


@query("run_summary", f"""
WITH {PSEUDO}
SELECT (SELECT count(*) FROM labelled) AS train_rows, (SELECT count(*) FROM unlabelled) AS test_rows,
  (SELECT count(DISTINCT label) FROM labelled) AS classes, (SELECT count(*) FROM pseudo) AS pseudo_rows,
  round(100.0 * (SELECT count(*) FROM pseudo) / (SELECT count(*) FROM unlabelled), 6) AS pseudo_percent,
  (SELECT count(*) FROM labelled) + (SELECT count(*) FROM pseudo) AS extended_rows""")
def run_summary(spark, sf):
    from inkgrain.plans.pseudo import run_summary as summary

    scored = fx.with_probabilities(fx.unlabelled(spark, sf, "n_chars"))
    return summary(fx.labelled(spark, sf), "label", scored, "p", 0.90).withColumn("pseudo_percent", F.round("pseudo_percent", 6))


@query("best_trial", f"""
WITH {RULED}, {CLASS_SCORES.format(by='source,', cby='c.source,', rows='ruled', on='c.source = r.source AND')}
SELECT source AS trial_id, round(avg(f1), 6) AS score FROM prf GROUP BY source ORDER BY avg(f1) DESC, source LIMIT 1""")
def best(spark, sf):
    """Each source of the labelled documents counts as one trial."""
    scores = mt.macro_f1(ruled(spark, sf), "label", "prediction", by=["source"])
    trials = scores.select(F.col("source").alias("trial_id"), F.col("macro_f1").alias("score"))
    return best_trial(trials).withColumn("score", F.round("score", 6))
