"""The 33 stylometric features of one text, all native Column expressions.

The work is row-local: no shuffle and no Python. Intermediate values that several
features need (folded text, tokens, words per sentence, markers found) are columns
of an inner ``select``, so each regular expression runs once per text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkgrain.functions.text import WORD_CHAR, clean_text, count_words, fold_spaces, split_words

# Formal connectives counted and flagged, in output order.
MARKERS = (
    "furthermore",
    "moreover",
    "in conclusion",
    "notably",
    "it is worth noting",
    "it is important to note",
    "in summary",
    "to summarize",
    "in essence",
    "this underscores",
    "this highlights",
    "ultimately",
    "this demonstrates",
    "overall",
)

MARKER_COLUMNS = tuple("marker_" + m.replace(" ", "") for m in MARKERS)

GROUPS = {
    "length": ("char_len", "word_count", "sentence_count", "words_per_sentence", "log_char_len"),
    "lexical": ("type_token_ratio", "avg_word_len"),
    "sentence": ("sentence_count", "words_per_sentence", "sent_len_std"),
    "punct": ("punct_ratio", "comma_per_word", "exclamation_count", "question_count"),
    "caps": ("allcaps_word_count", "uppercase_char_ratio"),
    "typo": ("triple_consonant_count", "char_repeat_run_count", "alphanum_mix_count"),
    "markers": ("ai_marker_count", *MARKER_COLUMNS),
    "digits": ("digit_group_count",),
}

FEATURE_NAMES = (
    "char_len",
    "word_count",
    "sentence_count",
    "words_per_sentence",
    "type_token_ratio",
    "avg_word_len",
    "sent_len_std",
    "punct_ratio",
    "comma_per_word",
    "exclamation_count",
    "question_count",
    "allcaps_word_count",
    "uppercase_char_ratio",
    "triple_consonant_count",
    "char_repeat_run_count",
    "alphanum_mix_count",
    "ai_marker_count",
    *MARKER_COLUMNS,
    "digit_group_count",
    "log_char_len",
)

# Patterns below run on folded text, where the blank is the only white space.
_SENTENCE_END = r"[.!?]++(?: |\z)"
_NOT_LOWER = r"[^ \p{IsLowercase}\p{Lt}]"
_ALLCAPS_WORD = rf"(?<![^ ])(?={_NOT_LOWER}*\p{{IsUppercase}}){_NOT_LOWER}{{2,}}+(?![^ ])"
_MIXED_WORD = r"(?:[a-z][0-9]|[0-9][a-z])[^ ]*+"

_PUNCTUATION = r"[!-/:-@\[-`{-~]"
_TRIPLE_CONSONANT = r"([b-df-hj-np-tv-z])\1{2,}"
_REPEAT_RUN = r"([^\n])\1{2,}"

# No marker ends with a word another one starts with, and none contains another, so
# one alternation finds exactly the matches of the separate patterns.
_MARKER = rf"(?iu)(?<!{WORD_CHAR})(?:{'|'.join(MARKERS)})(?!{WORD_CHAR})"


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _markers_found(text: Column) -> Column:
    # Case-insensitive matching equates these four letters with i, i, s and k.
    plain = lambda m: F.lower(F.translate(m, "İıſK", "iisk"))
    return F.transform(F.regexp_extract_all(text, F.lit(_MARKER), F.lit(0)), plain)


def _population_std(counts: Column) -> Column:
    """Standard deviation of the non-zero entries in one pass over whole numbers."""
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("n"), zero.alias("s"), zero.alias("q"))

    def add(acc, x):
        return F.struct(
            (acc.n + F.when(x > 0, 1).otherwise(0)).alias("n"),
            (acc.s + x).alias("s"),
            (acc.q + x.cast("long") * x).alias("q"),
        )

    def finish(acc):
        spread = (acc.n * acc.q - acc.s * acc.s).cast("double")
        return F.when(acc.n > 1, F.sqrt(spread) / acc.n).otherwise(F.lit(0.0))

    return F.aggregate(counts, start, add, finish)


def with_scalar_features(df: DataFrame, text_col: str, names=FEATURE_NAMES) -> DataFrame:
    """Append the named feature columns, as doubles, to ``df``."""
    kept = df.columns
    t, n = F.col("__text"), F.col("__folded")
    stage = df.withColumn("__text", clean_text(F.col(text_col))).withColumn("__folded", fold_spaces(t))
    stage = stage.select(
        *kept,
        t,
        n,
        F.length(t).alias("__len"),
        count_words(n).alias("__words"),
        F.lower(n).alias("__lower"),
        F.transform(F.split(n, _SENTENCE_END), lambda s: count_words(F.trim(s))).alias("__per_sentence"),
        _markers_found(t).alias("__found"),
    )
    length, words = F.col("__len"), F.col("__words")
    sentences, found, lower = F.size("__per_sentence"), F.col("__found"), F.col("__lower")
    per_char = lambda c: c / F.greatest(length, F.lit(1))
    per_word = lambda c: F.when(words > 0, c / words).otherwise(F.lit(0.0))
    features = {
        "char_len": length,
        "word_count": words,
        "sentence_count": sentences,
        "words_per_sentence": words / sentences,
        "type_token_ratio": per_word(F.size(F.array_distinct(split_words(lower)))),
        "avg_word_len": per_word(F.length(F.replace(n, F.lit(" "), F.lit("")))),
        "sent_len_std": _population_std(F.col("__per_sentence")),
        "punct_ratio": per_char(_count(t, _PUNCTUATION)),
        "comma_per_word": _count(t, ",") / (words + 1),
        "exclamation_count": _count(t, "!"),
        "question_count": _count(t, r"\?"),
        "allcaps_word_count": _count(n, _ALLCAPS_WORD),
        "uppercase_char_ratio": per_char(_count(t, r"\p{IsUppercase}")),
        "triple_consonant_count": _count(t, _TRIPLE_CONSONANT),
        "char_repeat_run_count": _count(t, _REPEAT_RUN),
        "alphanum_mix_count": _count(lower, _MIXED_WORD),
        "ai_marker_count": F.size(found),
        **{c: F.array_contains(found, m).cast("int") for c, m in zip(MARKER_COLUMNS, MARKERS)},
        "digit_group_count": _count(t, r"\p{Nd}+"),
        "log_char_len": F.log1p(length),
    }
    return stage.select(*kept, *[features[c].cast("double").alias(c) for c in names])
