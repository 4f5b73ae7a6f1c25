"""Tokens, word n-grams and character n-grams as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkgrain.functions.text import WORD_CHAR

# The English stop words that Spark ML ships.
ENGLISH_STOP_WORDS = tuple(
    """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom this
that these those am is are was were be been being have has had having do does did doing a an
the and but if or because as until while of at by for with about against between into through
during before after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some such no nor not
only own same so than too very s t can will just don should now i'll you'll he'll she'll we'll
they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't
wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
there's what's when's where's who's why's would
""".split()
)


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_CHAR + "{2,}"), F.lit(0))


def embedding_tokens(text: Column, min_len: int = 2, max_len: int = 15) -> Column:
    """Lower-cased runs of letters and underscores, by length, none starting with ``_``."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{Nl}\p{No}_]+"), F.lit(0))
    return F.filter(runs, lambda w: F.length(w).between(min_len, max_len) & ~w.startswith("_"))


def drop_stop_words(tokens: Column, stop_words) -> Column:
    """Remove listed words, keeping the order and repeats of the others."""
    stop_words = list(stop_words)
    return F.filter(tokens, lambda w: ~w.isin(stop_words)) if stop_words else tokens


def word_ngrams(tokens: Column, lo: int, hi: int) -> Column:
    """All n-grams of ``lo`` to ``hi`` neighbouring tokens, joined by a blank.

    Pass a plain column: the array is read once per n-gram. Unfold the result with
    ``explode_outer`` or through another function; before a plain ``explode`` of a column
    Spark tests its size, and that test would copy the column's expression into the lambda.
    """
    parts = []
    for n in range(lo, hi + 1):
        if n == 1:
            parts.append(tokens)
            continue
        starts = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
        grams = F.transform(
            starts, lambda i: F.concat_ws(" ", *[F.element_at(tokens, (i + k).cast("int")) for k in range(n)])
        )
        parts.append(F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def char_ngram_sizes(padded_length: Column, lo: int, hi: int) -> Column:
    """n-gram sizes of one padded token: a token shorter than ``lo`` counts once."""
    return F.sequence(F.lit(lo), F.greatest(F.lit(lo), F.least(F.lit(hi), padded_length)))


def char_ngram_starts(padded_length: Column, size: Column) -> Column:
    return F.sequence(F.lit(1), F.greatest(F.lit(1), padded_length - size + 1))


def char_grams_of(tokens: Column, lo: int, hi: int) -> Column:
    """The character n-grams of the different tokens of an array, each token padded by a blank."""

    def grams(token: Column) -> Column:
        padded = F.concat(F.lit(" "), token, F.lit(" "))
        size = F.length(padded)
        return F.flatten(F.transform(char_ngram_sizes(size, lo, hi), lambda n: F.transform(char_ngram_starts(size, n), lambda i: F.substring(padded, i, n))))

    return F.flatten(F.transform(F.array_distinct(tokens), grams))
