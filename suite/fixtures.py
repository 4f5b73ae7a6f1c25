"""Inputs derived from the test tables, once for Spark and once as SQL.

Expressions in ``*_EXPR`` are plain SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from inkgrain.functions.text import WS_CLASS
from inkgrain.functions.tokens import ENGLISH_STOP_WORDS
from inkgrain.operators.rowid import dense_row_id
from inkgrain.functions.tokens import embedding_tokens
from inkgrain.sources.tables import read_table, spread

# The documents hold no marker and no question mark, so some are appended.
MARKED_EXPR = """
CASE doc_id % 9
WHEN 0 THEN concat(text, ' Furthermore, overall?')
WHEN 1 THEN concat(text, ' It is WORTH noting: MOREOVER!!! in summary, this highlights this underscores')
WHEN 2 THEN concat(text, ' overall_ xnotably soonnnn zzz')
WHEN 3 THEN concat(text, ' mp3 3d 12 A1 B-2 WOW? ok?')
WHEN 4 THEN concat(text, ' In conclusion... ultimately! To summarize, in essence; it is important to note')
WHEN 5 THEN concat('notably overall this demonstrates, overall ', text)
ELSE text END
"""

SPARSE_EXPR = "CASE doc_id % 11 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   ' ELSE text END"

CSV_EXPR = """
CASE doc_id % 5
WHEN 0 THEN concat('He said "', text, '", twice')
WHEN 1 THEN concat(text, ' a,b ', chr(92), ' c "" d')
WHEN 2 THEN ''
WHEN 3 THEN concat('  ', text, '  ')
ELSE text END
"""

# A rule in place of a model; class 3 is never predicted.
RULE_EXPR = "CASE WHEN n_chars % 7 = 0 THEN 0 WHEN n_chars % 11 = 0 THEN 1 ELSE 2 END"

# Three class probabilities with ties and with 0.9 exactly.
PROBABILITY_EXPRS = tuple(
    f"CASE WHEN doc_id % 13 = 0 THEN {a} WHEN doc_id % 13 = 1 THEN {b} WHEN doc_id % 13 = 2 THEN {c} "
    f"ELSE CAST(1 + {d} AS DOUBLE) / CAST(3 + n_chars % 17 + n_chars % 2 + doc_id % 3 AS DOUBLE) END"
    for a, b, c, d in (
        ("CAST(0.9 AS DOUBLE)", "CAST(0.4 AS DOUBLE)", "CAST(0.05 AS DOUBLE)", "n_chars % 17"),
        ("CAST(0.05 AS DOUBLE)", "CAST(0.4 AS DOUBLE)", "CAST(0.05 AS DOUBLE)", "n_chars % 2"),
        ("CAST(0.05 AS DOUBLE)", "CAST(0.2 AS DOUBLE)", "CAST(0.9 AS DOUBLE)", "doc_id % 3"),
    )
)


def documents(spark, sf, *columns):
    docs = read_table(spark, sf, "documents")
    return docs.select(*columns) if columns else docs


def labelled(spark, sf, *columns):
    """Documents with the imbalanced class ``label = quality * 2 + toxic``."""
    labels = read_table(spark, sf, "labels").select("doc_id", F.expr("quality * 2 + toxic").alias("label"))
    return documents(spark, sf, "doc_id", *columns).join(labels, "doc_id")


def unlabelled(spark, sf, *columns):
    labels = read_table(spark, sf, "labels").select("doc_id")
    return documents(spark, sf, "doc_id", *columns).join(labels, "doc_id", "left_anti")


def texts(spark, sf, expression="text", name="text"):
    return spread(documents(spark, sf, "doc_id", "text")).select("doc_id", F.expr(expression).alias(name))


def with_probabilities(df):
    return df.withColumn("p", F.array(*[F.expr(e) for e in PROBABILITY_EXPRS]))


def word_vectors(spark, sf):
    """The most common tokens paired with the embeddings; all other tokens have none."""
    docs = texts(spark, sf)
    found = docs.select(F.explode(F.array_distinct(embedding_tokens(F.col("text")))).alias("word"))
    ranked = dense_row_id(found.groupBy("word").agg(F.count("*").alias("df")), "r", order_by=[F.desc("df"), "word"])
    vectors = dense_row_id(read_table(spark, sf, "embeddings").select("vec_id", "embedding"), "r", order_by="vec_id")
    return ranked.join(vectors, "r").select("word", F.col("embedding").alias("vector"))


# SQL counterparts ---------------------------------------------------------------------

STOP_LIST = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS) + "]"

LABELLED = "labelled AS (SELECT d.*, l.quality * 2 + l.toxic AS label FROM documents d JOIN labels l USING (doc_id))"
UNLABELLED = "unlabelled AS (SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))"
PROBABILITIES = ", ".join(f"{e} AS p{i}" for i, e in enumerate(PROBABILITY_EXPRS))


def not_ws():
    return "[^" + WS_CLASS[1:] + "+"


def word_list(text):
    return f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"


def kept_words(text):
    return f"list_filter({word_list(text)}, lambda w: NOT list_contains({STOP_LIST}, w))"


def ngrams_sql(words, hi):
    parts = [words]
    for n in range(2, hi + 1):
        gram = " || ' ' || ".join(f"{words}[i + {k}]" if k else f"{words}[i]" for k in range(n))
        parts.append(f"list_transform(range(1, len({words}) - {n - 2}), lambda i: {gram})")
    out = parts[0]
    for p in parts[1:]:
        out = f"list_concat({out}, {p})"
    return out


def word_counts(source, hi=1, id_col="doc_id", name="counts", text="text"):
    """CTEs ending in ``name(id, term, tf)``."""
    return f"""
{name}_w AS (SELECT {id_col}, {kept_words(f"coalesce({text}, '')")} AS w FROM {source}),
{name}_t AS (SELECT {id_col}, unnest({ngrams_sql('w', hi)}) AS term FROM {name}_w),
{name} AS (SELECT {id_col}, term, count(*) AS tf FROM {name}_t GROUP BY ALL)"""


def char_counts(source, id_col="doc_id", name="counts", text="text"):
    return f"""
{name}_w AS (SELECT {id_col}, unnest(regexp_extract_all(lower(coalesce({text}, '')), '{not_ws()}')) AS w FROM {source}),
{name}_c AS (SELECT {id_col}, ' ' || w || ' ' AS w, count(*) AS c FROM {name}_w GROUP BY ALL),
{name}_n AS (SELECT {id_col}, w, c, unnest(range(3, least(5, length(w)) + 1)) AS n FROM {name}_c),
{name}_i AS (SELECT {id_col}, w, c, n, unnest(range(1, length(w) - n + 2)) AS i FROM {name}_n),
{name} AS (SELECT {id_col}, substring(w, i, n) AS term, CAST(sum(c) AS BIGINT) AS tf FROM {name}_i GROUP BY ALL)"""


def weights(source, min_df, counts="counts", id_col="doc_id", name="weights"):
    """CTEs ``vocab(term, df, idf)`` and ``name(id, term, tf, weight)`` for the counts of ``source``."""
    return f"""
vocab_{name} AS (SELECT term, count(*) AS df, ln((1.0 + (SELECT count(*) FROM {source})) / (1 + count(*))) + 1 AS idf
  FROM {counts} GROUP BY term HAVING count(*) >= {min_df}),
{name} AS (SELECT {id_col}, term, tf, raw / sqrt(sum(raw * raw) OVER (PARTITION BY {id_col})) AS weight
  FROM (SELECT c.{id_col}, term, tf, (1 + ln(tf)) * idf AS raw FROM {counts} c JOIN vocab_{name} USING (term)))"""


def scores(source="labelled", weights_name="weights", name="scores"):
    return f"""
{name}_p AS (SELECT label, count(*) / (SELECT count(*) FROM {source})::DOUBLE AS p FROM {source} GROUP BY label),
{name}_f AS (SELECT term, sum(weight) AS total FROM {weights_name} GROUP BY term),
{name}_o AS (SELECT term, label, sum(weight) AS seen FROM {weights_name} JOIN {source} USING (doc_id) GROUP BY ALL),
{name} AS (SELECT term, label,
    pow(coalesce(seen, 0) - total * p, 2) / (total * p)
    + pow(total - coalesce(seen, 0) - total * (1 - p), 2) / (total * (1 - p)) AS chi2
  FROM {name}_f CROSS JOIN {name}_p LEFT JOIN {name}_o USING (term, label))"""


def top(k, scores_name="scores", name="best"):
    return f"""
{name} AS (SELECT * FROM (SELECT label, term, chi2,
    row_number() OVER (PARTITION BY label ORDER BY round(chi2, 9) DESC, term) AS rank FROM {scores_name}) WHERE rank <= {k}),
{name}_v AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, list_sort(list(label)) AS labels
  FROM {name} GROUP BY term)"""


VECTORS = r"""
vec_t AS (SELECT doc_id, unnest(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{Nl}\p{No}_]+'),
    lambda w: length(w) BETWEEN 2 AND 15 AND NOT starts_with(w, '_'))) AS word FROM documents),
vec_c AS (SELECT doc_id, word, count(*) AS c FROM vec_t GROUP BY ALL),
vec_w AS (SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) AS r FROM vec_c GROUP BY word),
vec_e AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, embedding FROM embeddings),
vec_x AS (SELECT word, unnest(range(64)) AS dim, unnest(embedding) AS v FROM vec_w JOIN vec_e USING (r)),
vec_m AS (SELECT doc_id, dim, sum(CAST(v AS DOUBLE) * c) / sum(c) AS v FROM vec_c JOIN vec_x USING (word) GROUP BY ALL),
pooled AS (SELECT d.doc_id, x.dim, coalesce(v, 0.0) AS value FROM documents d CROSS JOIN (SELECT unnest(range(64)) AS dim) x
  LEFT JOIN vec_m m ON m.doc_id = d.doc_id AND m.dim = x.dim)"""
