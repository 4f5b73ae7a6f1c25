"""Term statistics as long tables ``(id, term, tf, weight)``.

Texts are shuffled by id once, before they are expanded into terms. All per-document
steps after that (term counts, row norms, vectors) find their rows in place, and the
per-term steps combine on the map side before they shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkgrain.functions import tokens as tk
from inkgrain.functions.text import clean_text, fold_spaces, split_words
from inkgrain.operators.batches import (
    Coded,
    char_lists,
    char_totals,
    class_sums,
    codable,
    coded_counts,
    coded_vocabulary,
    coded_words,
    found_column,
    split_repeats,
    weigher,
    weights,
    word_totals,
)
from inkgrain.operators.lookup import LookupLimits, lookup_join, table_bytes
from inkgrain.sources.tables import scanned_bytes, spread

#: Stored bytes of text per partition; as n-grams a text takes up to 40 times its size.
TEXT_PARTITION_BYTES = 16 * 1024 * 1024
#: Least number of partitions per core, for small inputs.
PARTITIONS_PER_CORE = 4


@dataclass(frozen=True)
class WordTerms:
    """Word n-grams built after stop words are gone."""

    lo: int = 1
    hi: int = 2
    stop_words: tuple[str, ...] = tk.ENGLISH_STOP_WORDS

    def fold(self, text: Column) -> Column:
        return tk.drop_stop_words(tk.word_tokens(clean_text(text)), self.stop_words)

    def folded(self, texts: DataFrame, text_col: str) -> DataFrame:
        """The texts as arrays of their words, stop words left out."""
        return texts.select(*[c for c in texts.columns if c != text_col], self.fold(F.col(text_col)).alias("__folded"))

    def _grams(self, texts: DataFrame, text_col: str) -> DataFrame:
        kept = [c for c in texts.columns if c != text_col]
        return self.folded(texts, text_col).select(
            *kept, tk.word_ngrams(F.col("__folded"), self.lo, self.hi).alias("__terms")
        )

    def distinct(self, texts: DataFrame, text_col: str) -> DataFrame:
        grams = self._grams(texts, text_col)
        kept = [c for c in grams.columns if c != "__terms"]
        return grams.select(*kept, F.explode(F.array_distinct("__terms")).alias("term"))

    def counted(self, texts: DataFrame, text_col: str, coded: Coded | None = None) -> DataFrame:
        """``coded``: rows are texts of their own, and each gives one row with its counts by the numbers of a vocabulary."""
        if coded is not None:
            return coded_counts(self.folded(texts, text_col), [c for c in texts.columns if c != text_col], "__folded", coded)
        grams = self._grams(texts, text_col)
        kept = [c for c in grams.columns if c != "__terms"]
        rows = grams.select(*kept, F.explode_outer("__terms").alias("term"))
        return rows.groupBy(*kept, "term").agg(F.count("term").alias("tf"))


@dataclass(frozen=True)
class CharTerms:
    """Character n-grams inside white-space tokens that are padded by one blank."""

    lo: int = 3
    hi: int = 5

    def _expand(self, tokens: DataFrame, outer: bool) -> DataFrame:
        explode = F.explode_outer if outer else F.explode
        kept = [c for c in tokens.columns if c != "__token"]
        padded = tokens.select(*kept, F.concat(F.lit(" "), "__token", F.lit(" ")).alias("__p"))
        length = F.length("__p")
        sized = padded.select(*kept, "__p", explode(tk.char_ngram_sizes(length, self.lo, self.hi)).alias("__n"))
        starts = tk.char_ngram_starts(length, F.col("__n"))
        placed = sized.select(*kept, "__p", "__n", explode(starts).alias("__i"))
        return placed.select(*kept, F.substring("__p", F.col("__i"), F.col("__n")).alias("term"))

    def fold(self, text: Column) -> Column:
        return F.lower(fold_spaces(clean_text(text)))

    def folded(self, texts: DataFrame, text_col: str) -> DataFrame:
        """The texts as tokens that are joined by one blank, in lower case."""
        kept = [c for c in texts.columns if c != text_col]
        return texts.select(*kept, self.fold(F.col(text_col)).alias("__folded"))

    def distinct(self, texts: DataFrame, text_col: str) -> DataFrame:
        """Each row by itself: no shuffle of the texts."""
        folded = self.folded(texts, text_col)
        kept = [c for c in texts.columns if c != text_col]
        tokens = folded.select(*kept, split_words(F.col("__folded")).alias("__tokens"))
        grams = tokens.select(*kept, tk.char_grams_of(F.col("__tokens"), self.lo, self.hi).alias("__terms"))
        return grams.select(*kept, F.explode(F.array_distinct("__terms")).alias("term"))

    def counted(self, texts: DataFrame, text_col: str, whole: bool | Coded = False) -> DataFrame:
        """``whole``: rows are texts of their own, and each gives one row with the array ``terms`` of its ``(term, tf)``, or with its counts by the numbers
        of a vocabulary."""
        if whole:
            folded, others = self.folded(texts, text_col), [c for c in texts.columns if c != text_col]
            return coded_counts(folded, others, "__folded", whole) if isinstance(whole, Coded) else char_lists(folded, others, "__folded", self.lo, self.hi)
        # Equal tokens of a text are counted first and expanded once.
        kept = [c for c in texts.columns if c != text_col]
        folded = texts.select(*kept, F.lower(fold_spaces(clean_text(F.col(text_col)))).alias("__folded"))
        tokens = folded.select(*kept, F.explode_outer(split_words(F.col("__folded"))).alias("__token"))
        tokens = tokens.groupBy(*kept, "__token").agg(F.count("__token").alias("__tf"))
        grams = self._expand(tokens, outer=True)
        return grams.groupBy(*kept, "term").agg(F.sum("__tf").alias("tf"))


def by_id(texts: DataFrame, id_col: str, partition_bytes: int = TEXT_PARTITION_BYTES) -> DataFrame:
    """The one shuffle of the raw texts that all per-document work builds on.

    The number of partitions grows with the input without bound, ``partition_bytes`` of it each. It is given,
    so that adaptive execution does not merge partitions by their size before the texts expand.
    """
    cores = texts.sparkSession.sparkContext.defaultParallelism
    n = max(-(-scanned_bytes(texts) // partition_bytes), PARTITIONS_PER_CORE * cores)
    return texts.repartition(n, F.col(id_col))


def in_small_parts(texts: DataFrame, partition_bytes: int = TEXT_PARTITION_BYTES) -> DataFrame:
    """``texts`` in parts of ``partition_bytes`` or less, so that what a task counts stays small; dealt anew only if they are not."""
    n = -(-scanned_bytes(texts) // partition_bytes)
    few = spread(texts)
    return texts.repartition(n) if few is texts and n > texts.rdd.getNumPartitions() else few


def term_counts(texts: DataFrame, id_col: str, text_col: str, terms, keep=()) -> DataFrame:
    """``(id, *keep, term, tf)``; a text without terms keeps one row with a null term."""
    slim = texts.select(id_col, *keep, text_col)
    return terms.counted(by_id(slim, id_col), text_col)


def nested_counts(texts: DataFrame, id_col: str, text_col: str, terms, keep=()) -> DataFrame:
    """``(id, *keep, terms)``: one row a text with an array of its ``(term, tf)``. A table to write once and use in many fits."""
    if isinstance(terms, CharTerms) and codable(terms.lo, terms.hi):
        single, rest = split_repeats(texts.select(id_col, *keep, text_col), id_col)
        found = terms.counted(spread(single), text_col, True)
        return found if rest is None else found.unionByName(_listed(rest, id_col, text_col, terms, keep))
    return _listed(texts, id_col, text_col, terms, keep)


def _listed(texts: DataFrame, id_col: str, text_col: str, terms, keep) -> DataFrame:
    counts = term_counts(texts, id_col, text_col, terms, keep)
    entry = F.when(F.col("term").isNotNull(), F.struct("term", "tf"))
    return counts.groupBy(id_col, *keep).agg(F.collect_list(entry).alias("terms"))


def unnested(nested: DataFrame, id_col: str, keep=()) -> DataFrame:
    """What :func:`term_counts` gives, from the nested table: rows are dealt by id before they expand, so per-text work needs no other shuffle."""
    return by_id(nested, id_col).select(id_col, *keep, F.inline_outer("terms"))


def group_frequency(nested: DataFrame, group_col: str) -> DataFrame:
    """``(term, group, n)``: in how many texts of each group a term is. Groups that are left out later need no new count."""
    return nested.select(group_col, F.inline("terms")).groupBy("term", group_col).agg(F.count("*").alias("n"))


def frequency_without(per_group: DataFrame, group_col: str, group, min_df: int) -> DataFrame:
    """``(term, df)`` over all groups but one."""
    rest = per_group.where(F.col(group_col) != group).groupBy("term").agg(F.sum("n").alias("df"))
    return rest.where(F.col("df") >= min_df)


def doc_frequency(texts: DataFrame, id_col: str, text_col: str, terms, min_df: int) -> DataFrame:
    """``(term, df)`` of the terms found in at least ``min_df`` texts."""
    slim = texts.select(id_col, text_col)
    if isinstance(terms, CharTerms) and codable(terms.lo, terms.hi):
        totals = char_totals(terms.folded(spread(slim), text_col), "__folded", terms.lo, terms.hi)
        return totals.select("term", F.col("docs").alias("df")).where(F.col("df") >= min_df)
    if isinstance(terms, WordTerms) and 1 <= terms.lo <= terms.hi <= 2:
        totals = word_totals(terms.folded(in_small_parts(slim), text_col), "__folded", terms.lo, terms.hi)
        return totals.select("term", F.col("docs").alias("df")).where(F.col("df") >= min_df)
    found = terms.distinct(in_small_parts(slim), text_col)
    return found.groupBy("term").agg(F.count("*").alias("df")).where(F.col("df") >= min_df)


def codable_terms(terms) -> bool:
    """Whether terms of this kind may have codes at all."""
    return codable(terms.lo, terms.hi) if isinstance(terms, CharTerms) else 1 <= terms.lo <= terms.hi <= 2


def grouped_frequency(texts: DataFrame, text_col: str, group_col: str, terms) -> DataFrame:
    """``(term, group, n)`` as in :func:`group_frequency`, of rows that are texts of their own and of terms that may have codes."""
    slim = texts.select(text_col, group_col)
    if isinstance(terms, CharTerms):
        totals = char_totals(terms.folded(spread(slim), text_col), "__folded", terms.lo, terms.hi, group_col)
    else:
        totals = word_totals(terms.folded(in_small_parts(slim), text_col), "__folded", terms.lo, terms.hi, group_col)
    return totals.select("term", group_col, F.col("docs").alias("n"))


def total_frequency(texts: DataFrame, id_col: str, text_col: str, terms: CharTerms) -> DataFrame:
    """``(term, n, docs)``: occurrences of each term, and ids that have it. Only rows of repeated ids are shuffled as texts."""
    if not codable(terms.lo, terms.hi):
        counts = term_counts(texts, id_col, text_col, terms).where("term IS NOT NULL")
        return counts.groupBy("term").agg(F.sum("tf").alias("n"), F.count("*").alias("docs"))
    single, rest = split_repeats(texts.select(id_col, text_col), id_col)
    totals = char_totals(terms.folded(spread(single), text_col), "__folded", terms.lo, terms.hi)
    if rest is None:
        return totals
    more = term_counts(rest, id_col, text_col, terms).where("term IS NOT NULL")
    more = more.groupBy("term").agg(F.sum("tf").alias("n"), F.count("*").alias("docs"))
    return totals.unionByName(more).groupBy("term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def coded_terms(vocabulary: DataFrame, terms, limits: LookupLimits, size: int) -> Coded | None:
    """The vocabulary as codes that a task can hold, or ``None`` if it is too large, has too many characters, or terms of more than two words."""
    if not codable_terms(terms):
        return None
    if isinstance(terms, CharTerms):
        return coded_vocabulary(vocabulary, terms.lo, terms.hi) if 0 < size <= limits.broadcast_bytes else None
    # a task holds codes, a fraction of what the estimate counts
    return coded_words(vocabulary, 2 * limits.broadcast_bytes, terms.lo, terms.hi) if size > 0 and limits.broadcast_bytes > 0 else None


def coded_groups(vocabulary: DataFrame, terms, limits: LookupLimits, groups: int) -> Coded | None:
    """:func:`coded_terms` of ``(term, docs)`` with the texts of each group that have the term."""
    gram_bytes = 8 + 4 * groups + 8 * groups  # codes, counts, and an idf without each group
    if isinstance(terms, CharTerms):
        return coded_vocabulary(vocabulary, terms.lo, terms.hi, "docs") if vocabulary.count() * gram_bytes <= limits.broadcast_bytes else None
    return coded_words(vocabulary, 2 * limits.broadcast_bytes, terms.lo, terms.hi, "docs", gram_bytes) if limits.broadcast_bytes > 0 else None


def coded_found(text: Column, terms, coded: Coded, slots: DataFrame) -> Column:
    """The weights with ``slots``, as a column beside the text."""
    return found_column(weigher(coded, [], slots), terms.fold(text))


def text_weights(
    texts: DataFrame, vocabulary: DataFrame, id_col: str, text_col: str, terms, keep=(), limits: LookupLimits = LookupLimits(), size: int | None = None, distinct: bool = False
) -> DataFrame:
    """``(id, *keep, term, tf, weight)`` of the vocabulary's terms: :func:`tfidf_weights` of counted texts, without rows that have no weight.

    The terms of a text whose id occurs once are weighted where the text lies, as long as a task can hold the vocabulary's codes.
    ``distinct``: the caller knows that every id occurs once.
    """
    size = table_bytes(vocabulary, "term") if size is None else size
    counted = lambda rows: tfidf_weights(term_counts(rows, id_col, text_col, terms, keep), vocabulary, id_col, limits, size, known=True)
    coded = coded_terms(vocabulary, terms, limits, size)
    if coded is None:
        return counted(texts)
    single, rest = _folded_singles(texts, id_col, text_col, terms, keep, distinct)
    found = weights(single, [id_col, *keep], "__folded", coded)
    return found if rest is None else found.unionByName(counted(rest).select(*found.columns))


def text_class_sums(
    texts: DataFrame, vocabulary: DataFrame, id_col: str, text_col: str, label_col: str, terms, limits: LookupLimits, size: int, coded: Coded | None, distinct: bool = False
) -> DataFrame:
    """``(term, label, o)``: the weights of :func:`text_weights` by term and label. Terms are added up where the texts lie, so those of a text are never rows."""
    counted = lambda rows: label_sums(tfidf_weights(term_counts(rows, id_col, text_col, terms, [label_col]), vocabulary, id_col, limits, size, known=True), label_col)
    if coded is None:
        return counted(texts)
    single, rest = _folded_singles(texts, id_col, text_col, terms, [label_col], distinct)
    found = class_sums(single, label_col, "__folded", coded)
    return found if rest is None else found.unionByName(counted(rest)).groupBy("term", "label").agg(F.sum("o").alias("o"))


def _folded_singles(texts: DataFrame, id_col: str, text_col: str, terms, keep, distinct: bool):
    """The folded texts of ids that occur once, and the rows of the others or ``None``."""
    slim = texts.select(id_col, *keep, text_col)
    single, rest = (slim, None) if distinct else split_repeats(slim, id_col)
    dealt = spread(single) if isinstance(terms, CharTerms) else in_small_parts(single)
    return terms.folded(dealt, text_col), rest


def label_sums(weights: DataFrame, label_col: str) -> DataFrame:
    """``(term, label, o)`` of weighted rows."""
    return weights.where(F.col("weight").isNotNull()).groupBy("term", F.col(label_col).alias("label")).agg(F.sum("weight").alias("o"))


def smooth_idf(frequencies: DataFrame, n_docs: int) -> DataFrame:
    """``(term, df, idf)`` with ``idf = ln((1 + n) / (1 + df)) + 1``."""
    return frequencies.withColumn("idf", F.log((1 + F.lit(n_docs)) / (1 + F.col("df"))) + 1)


def tfidf_weights(
    counts: DataFrame, vocabulary: DataFrame, id_col: str, limits: LookupLimits = LookupLimits(), size: int | None = None, known: bool = False
) -> DataFrame:
    """``counts`` plus ``weight``: sub-linear tf times idf, each text scaled to length 1.

    The norm covers every vocabulary term of the text; terms outside the vocabulary have
    a null weight, or are left out before the rows are sorted by text if only ``known`` ones are asked for. Any selection of terms has to come after this.
    """
    rows = lookup_join(counts, vocabulary, "term", limits, size, frequency="df")
    rows = rows.where(F.col("idf").isNotNull()) if known else rows
    raw = (1 + F.log("tf")) * F.col("idf")
    norm = F.sqrt(F.sum(F.col("__w") * F.col("__w")).over(Window.partitionBy(id_col)))
    return rows.withColumn("__w", raw).withColumn("weight", F.col("__w") / norm).drop("__w", "idf", "df")
