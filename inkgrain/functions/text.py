"""Text cleaning and splitting as Column expressions.

Java's ``\\s``, ``.``, ``\\d`` and ``\\b`` are not Unicode-aware by default, so the
character classes are spelled out here once and used everywhere else.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Unicode calls white space.
WHITESPACE_RANGES = (
    (0x09, 0x0D),
    (0x1C, 0x20),
    (0x85, 0x85),
    (0xA0, 0xA0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
)

WHITESPACE = "".join(chr(c) for lo, hi in WHITESPACE_RANGES for c in range(lo, hi + 1))
WS_CLASS = "[" + "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in WHITESPACE_RANGES) + "]"
WORD_CHAR = r"[\p{L}\p{N}_]"
SENTENCE_END = rf"[.!?]+{WS_CLASS}+|[.!?]+\z"


def clean_text(text: Column) -> Column:
    """Null becomes the empty string, anything else its string form."""
    return F.coalesce(text.cast("string"), F.lit(""))


def strip(text: Column) -> Column:
    """Remove white space of every kind from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def fold_spaces(text: Column) -> Column:
    """Every run of white space becomes one blank; none is left at the ends.

    ``translate`` first: after it the patterns need only the plain blank, which
    Java matches several times faster than the full white-space class.
    """
    blanks = F.translate(text, WHITESPACE, " " * len(WHITESPACE))
    return F.trim(F.regexp_replace(blanks, " {2,}", " "))


def split_words(folded: Column) -> Column:
    """Tokens of a text that went through ``fold_spaces``."""
    return F.when(folded == "", F.array().cast("array<string>")).otherwise(F.split(folded, " "))


def count_words(folded: Column) -> Column:
    blanks = F.length(folded) - F.length(F.replace(folded, F.lit(" "), F.lit("")))
    return F.when(folded == "", F.lit(0)).otherwise(blanks + 1)


def ws_tokens(text: Column) -> Column:
    """White-space tokens of a raw text."""
    return split_words(fold_spaces(text))


def sentence_pieces(text: Column) -> Column:
    """Pieces between sentence ends; a closing mark leaves an empty last piece."""
    return F.split(strip(text), SENTENCE_END)
