"""Scalar features, tokens and n-grams."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkgrain.functions import text as tx
from inkgrain.functions import tokens as tk
from inkgrain.functions.scalar import FEATURE_NAMES, GROUPS, MARKER_COLUMNS, MARKERS, with_scalar_features
from inkgrain.operators.terms import CharTerms, total_frequency
from suite import fixtures as fx
from suite.registry import query

WS = tx.WS_CLASS
NOT_WS = fx.not_ws()
END = f"[.!?]+{WS}+|[.!?]+$"
STRIP = f"regexp_replace(t, '^{WS}+|{WS}+$', '', 'g')"


def hits(pattern, text="t"):
    return f"len(regexp_extract_all({text}, '{pattern}'))"


CONSONANT_RUNS = "|".join(c + "{3,}" for c in "bcdfghjklmnpqrstvwxyz")
MARKER_HITS = {m: hits(rf"(?i)\b{m}\b") for m in MARKERS}

# Per column over ``t`` (text), ``s`` (stripped), ``w`` (tokens), ``n`` (number of tokens).
SCALAR_SQL = {
    "char_len": "length(t)",
    "word_count": "n",
    "sentence_count": f"greatest(1, {hits(END, 's')} + 1)",
    "words_per_sentence": f"n / greatest(1, {hits(END, 's')} + 1)",
    "type_token_ratio": f"CASE WHEN n = 0 THEN 0 ELSE len(list_distinct(regexp_extract_all(lower(t), '{NOT_WS}'))) / n END",
    "avg_word_len": f"CASE WHEN n = 0 THEN 0 ELSE length(regexp_replace(t, '{WS}+', '', 'g')) / n END",
    "sent_len_std": "CASE WHEN len(per) > 1 THEN list_aggregate(per, 'stddev_pop') ELSE 0 END",
    "punct_ratio": hits(r"[!-/:-@\[-`{-~]") + " / greatest(length(t), 1)",
    "comma_per_word": hits(",") + " / (n + 1)",
    "exclamation_count": hits("!"),
    "question_count": hits(r"\?"),
    "allcaps_word_count": r"len(list_filter(w, lambda x: length(x) > 1 AND regexp_matches(x, '\p{Lu}') AND NOT regexp_matches(x, '[\p{Ll}\p{Lt}]')))",
    "uppercase_char_ratio": hits(r"\p{Lu}") + " / greatest(length(t), 1)",
    "triple_consonant_count": hits(CONSONANT_RUNS),
    "char_repeat_run_count": "coalesce(runs, 0)",
    "alphanum_mix_count": "len(list_filter(w, lambda x: regexp_matches(lower(x), '[a-z][0-9]|[0-9][a-z]')))",
    "ai_marker_count": " + ".join(MARKER_HITS.values()),
    **{c: f"CASE WHEN {MARKER_HITS[m]} > 0 THEN 1 ELSE 0 END" for c, m in zip(MARKER_COLUMNS, MARKERS)},
    "digit_group_count": hits(r"\p{Nd}+"),
    "log_char_len": "ln(1 + length(t))",
}

# Runs of three or more equal characters, counted over the characters of each text.
RUNS = """, chars AS (SELECT doc_id, unnest(cs) AS c, unnest(range(len(cs))) AS i
    FROM (SELECT doc_id, regexp_extract_all(t, '(?s).') AS cs FROM texts)),
  marks AS (SELECT doc_id, c, i, i - row_number() OVER (PARTITION BY doc_id, c ORDER BY i) AS run FROM chars WHERE c <> chr(10)),
  runs AS (SELECT doc_id, count(*) AS runs FROM (SELECT doc_id, c, run FROM marks GROUP BY ALL HAVING count(*) >= 3) GROUP BY doc_id)"""


def scalar_sql(names):
    with_runs = "char_repeat_run_count" in names
    columns = ", ".join(f"round(CAST({SCALAR_SQL[c]} AS DOUBLE), 6) AS {c}" for c in names)
    return f"""
WITH texts AS (SELECT doc_id, coalesce({fx.MARKED_EXPR}, '') AS t FROM documents),
parts AS (SELECT doc_id, t, {STRIP} AS s, regexp_extract_all(t, '{NOT_WS}') AS w FROM texts),
counted AS (SELECT doc_id, t, s, w, len(w) AS n,
  list_filter(list_transform(string_split_regex(s, '{END}'), lambda x: {hits(NOT_WS, 'x')}), lambda x: x > 0) AS per FROM parts)
{RUNS if with_runs else ''}
SELECT doc_id, {columns} FROM counted {'LEFT JOIN runs USING (doc_id)' if with_runs else ''}"""


def scalar_query(names):
    def run(spark, sf):
        df = with_scalar_features(fx.texts(spark, sf, fx.MARKED_EXPR), "text", names)
        return df.select("doc_id", *[F.round(c, 6).alias(c) for c in names])

    return run


query("scalar_features", scalar_sql(FEATURE_NAMES))(scalar_query(FEATURE_NAMES))
for group, names in GROUPS.items():
    query(f"scalar_{group}", scalar_sql(names))(scalar_query(names))


@query("null_text", f"""
SELECT doc_id, coalesce({fx.SPARSE_EXPR}, '') AS text, length(coalesce({fx.SPARSE_EXPR}, '')) AS n FROM documents""")
def null_text(spark, sf):
    df = fx.texts(spark, sf, fx.SPARSE_EXPR).withColumn("text", tx.clean_text(F.col("text")))
    return df.select("doc_id", "text", F.length("text").cast("long").alias("n"))


def tokens_by_position(df, tokens, name):
    return df.select("doc_id", F.posexplode(tokens)).select("doc_id", F.col("pos").cast("long").alias("pos"), F.col("col").alias(name))


def positions_sql(source, expression, name):
    return f"""SELECT doc_id, unnest(range(len(x))) AS pos, unnest(x) AS {name}
FROM (SELECT doc_id, {expression} AS x FROM (SELECT doc_id, coalesce({source}, '') AS t FROM documents))"""


@query("ws_tokens", positions_sql(fx.MARKED_EXPR, f"regexp_extract_all(t, '{NOT_WS}')", "token"))
def ws_tokens(spark, sf):
    return tokens_by_position(fx.texts(spark, sf, fx.MARKED_EXPR), tx.ws_tokens(F.col("text")), "token")


@query("sentences", positions_sql(fx.MARKED_EXPR, f"string_split_regex({STRIP}, '{END}')", "sentence"))
def sentences(spark, sf):
    return tokens_by_position(fx.texts(spark, sf, fx.MARKED_EXPR), tx.sentence_pieces(F.col("text")), "sentence")


@query("embed_tokens", positions_sql("text", r"""list_filter(regexp_extract_all(lower(t), '[\p{L}\p{Nl}\p{No}_]+'),
 lambda w: length(w) BETWEEN 2 AND 15 AND NOT starts_with(w, '_'))""", "token"))
def embed_tokens(spark, sf):
    return tokens_by_position(fx.texts(spark, sf), tk.embedding_tokens(F.col("text")), "token")


@query("word_terms", positions_sql("text", fx.word_list("t"), "term"))
def word_terms(spark, sf):
    return tokens_by_position(fx.texts(spark, sf), tk.word_tokens(F.col("text")), "term")


@query("stopword_removal", positions_sql("text", fx.kept_words("t"), "term"))
def stopword_removal(spark, sf):
    kept = tk.drop_stop_words(tk.word_tokens(F.col("text")), tk.ENGLISH_STOP_WORDS)
    return tokens_by_position(fx.texts(spark, sf), kept, "term")


@query("word_ngrams", f"""
WITH words AS (SELECT doc_id, {fx.kept_words('text')} AS w FROM documents),
grams AS (SELECT doc_id, unnest({fx.ngrams_sql('w', 2)}) AS term FROM words)
SELECT term, count(*) AS n, count(DISTINCT doc_id) AS docs FROM grams GROUP BY term""")
def word_ngrams(spark, sf):
    words = tk.drop_stop_words(tk.word_tokens(F.col("text")), tk.ENGLISH_STOP_WORDS)
    df = fx.texts(spark, sf).select("doc_id", words.alias("w"))
    grams = df.select(F.sort_array(tk.word_ngrams(F.col("w"), 1, 2)).alias("g"))
    # Equal n-grams of a text are neighbours, and the first of them stands for the text: one pass and one shuffle give both counts.
    # ``inline_outer``: Spark guards a plain explode of a column by a filter on its size,
    # which would bring the whole expression of ``g`` into every step of its own lambda.
    first = lambda x, i: F.struct(x.alias("term"), F.when(x.eqNullSafe(F.get("g", i - 1)), 0).otherwise(1).alias("first"))
    found = grams.select(F.inline_outer(F.transform("g", first))).where("term IS NOT NULL")
    return found.groupBy("term").agg(F.count("*").alias("n"), F.sum("first").alias("docs"))


@query("char_ngrams", f"""
WITH {fx.char_counts('documents')}
SELECT term, CAST(sum(tf) AS BIGINT) AS n, count(*) AS docs FROM counts GROUP BY term""")
def char_ngrams(spark, sf):
    return total_frequency(fx.texts(spark, sf), "doc_id", "text", CharTerms())
