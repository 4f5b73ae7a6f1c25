"""The four feature blocks as pipeline stages.

Every fitted block offers ``features(rows) -> (id, features array)`` with one row per
id, and ``transform``, which appends the vector to its input. ``beside(text)`` gives the
features as a column, where a task can hold what the block has learned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkgrain.functions.scalar import FEATURE_NAMES, with_scalar_features
from inkgrain.functions.tokens import ENGLISH_STOP_WORDS
from inkgrain.operators import impchi
from inkgrain.operators.batches import class_sums, split_repeats, weights
from inkgrain.operators.embedding import mean, pooled_beside, pooled_vectors
from inkgrain.operators.lookup import LookupLimits, table_bytes
from inkgrain.operators.params import TableModel, TextParams, named_vector
from inkgrain.operators.store import write_table
from inkgrain.operators.terms import CharTerms, WordTerms, by_id, coded_found, coded_terms, doc_frequency, label_sums, smooth_idf, term_counts, text_class_sums, tfidf_weights, unnested
from inkgrain.sources.vectors import read_vectors


def class_counts(df: DataFrame, label_col: str) -> dict:
    """``{label: rows}``, one entry per class; nulls are an error."""
    rows = df.groupBy(label_col).agg(F.count("*").alias("n")).collect()
    if any(r[0] is None for r in rows):
        raise ValueError(f"{label_col} has nulls")
    return {r[0]: r["n"] for r in rows}


class _Block(TextParams):
    limits = LookupLimits()
    #: Whether the rows to fit on are known to have different ids.
    distinct = False

    def _append(self, dataset: DataFrame, features: DataFrame) -> DataFrame:
        id_col, out = self.value("idCol"), self.value("outputCol")
        vector, metadata = named_vector(F.col("__features"), self.get_feature_names_out())
        found = features.select(id_col, F.col("features").alias("__features"))
        joined = dataset.join(found, id_col, "left")
        return joined.select(*[F.col(c) for c in dataset.columns], vector.alias(out, metadata=metadata))


class ScalarTextFeatures(Transformer, _Block, DefaultParamsReadable, DefaultParamsWritable):
    """33 stylometric features per text; nothing to fit, nothing to shuffle."""

    def __init__(self, **params):
        super().__init__()
        self._text_defaults("scalar")
        self.set(**params)

    def get_feature_names_out(self):
        return list(FEATURE_NAMES)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        vector, metadata = named_vector(F.array(*FEATURE_NAMES), FEATURE_NAMES)
        named = with_scalar_features(dataset, self.value("textCol"))
        return named.select(*dataset.columns, vector.alias(self.value("outputCol"), metadata=metadata))


class _SelectorParams(_Block):
    kPerLabel = Param(Params._dummy(), "kPerLabel", "terms kept per class", TypeConverters.toInt)
    minDf = Param(Params._dummy(), "minDf", "least number of texts with a term", TypeConverters.toInt)
    ngramMin = Param(Params._dummy(), "ngramMin", "shortest n-gram", TypeConverters.toInt)
    ngramMax = Param(Params._dummy(), "ngramMax", "longest n-gram", TypeConverters.toInt)
    analyzer = Param(Params._dummy(), "analyzer", "'word' or 'char'", TypeConverters.toString)
    stopWords = Param(Params._dummy(), "stopWords", "words left out", TypeConverters.toListString)

    def terms(self):
        lo, hi = self.value("ngramMin"), self.value("ngramMax")
        if self.value("analyzer") == "char":
            return CharTerms(lo, hi)
        return WordTerms(lo, hi, tuple(self.value("stopWords")))


class TfidfSelector(Estimator, _SelectorParams, DefaultParamsReadable, DefaultParamsWritable):
    """TF-IDF of n-grams, reduced to the union of the ``kPerLabel`` best terms per class."""

    def __init__(self, **params):
        super().__init__()
        self._text_defaults("terms")
        self._setDefault(kPerLabel=50, minDf=3, ngramMin=1, ngramMax=2, analyzer="word", stopWords=list(ENGLISH_STOP_WORDS))
        self.set(**params)

    def _fit(self, dataset: DataFrame) -> "TfidfSelectorModel":
        id_col, text_col, label_col = (self.value(n) for n in ("idCol", "textCol", "labelCol"))
        terms = self.terms()
        counts = class_counts(dataset, label_col)
        frequencies = doc_frequency(dataset, id_col, text_col, terms, self.value("minDf"))
        add_up = lambda vocabulary, size, coded: text_class_sums(dataset, vocabulary, id_col, text_col, label_col, terms, self.limits, size, coded, self.distinct)
        return self._fit_sums(frequencies, add_up, counts)

    def fit_counts(self, frequencies: DataFrame, rows: DataFrame, counts: dict) -> "TfidfSelectorModel":
        """Fit on terms that are counted already: ``(term, df)``, ``(id, label, term, tf)`` and the rows of each class."""
        id_col, label_col = self.value("idCol"), self.value("labelCol")
        add_up = lambda vocabulary, size, coded: label_sums(tfidf_weights(rows, vocabulary, id_col, self.limits, size, known=True), label_col)
        return self._fit_sums(frequencies, add_up, counts)

    def fit_nested(self, frequencies: DataFrame, nested: DataFrame, counts: dict) -> "TfidfSelectorModel":
        """Fit on the nested table of texts that are counted already, each with an id of its own."""
        id_col, label_col = self.value("idCol"), self.value("labelCol")

        def add_up(vocabulary, size, coded):
            if coded is None:
                return label_sums(tfidf_weights(unnested(nested, id_col, [label_col]), vocabulary, id_col, self.limits, size, known=True), label_col)
            return class_sums(nested, label_col, "terms", coded)

        return self._fit_sums(frequencies, add_up, counts)

    def fit_folds(self, sums: DataFrame, per_fold: dict) -> list[list[str]]:
        """The terms that fits without each of the folds select, in the order of the features: from ``(term, label, o0, o1, ...)`` and the rows of each class in the fits."""
        tops = []
        for fold, counts in per_fold.items():
            own = sums.where(F.col(f"o{fold}") > 0).select("term", "label", F.col(f"o{fold}").alias("o"))
            tops.append(impchi.top_terms(impchi.chi2_of_sums(own, counts), self.value("kPerLabel")).select(F.lit(fold).alias("fold"), "term"))
        found = [set() for _ in per_fold]
        for r in reduce(DataFrame.unionByName, tops).collect():  # folds x classes x k rows
            found[r["fold"]].add(r["term"])
        if not all(found):
            raise ValueError(f"no term is in {self.value('minDf')} or more texts")
        return [sorted(terms, key=lambda t: t.encode()) for terms in found]

    def _fit_sums(self, frequencies: DataFrame, add_up, counts: dict) -> "TfidfSelectorModel":
        if not counts:
            raise ValueError("no rows to fit on")
        n_docs = sum(counts.values())
        vocabulary = write_table(smooth_idf(frequencies, n_docs), "vocabulary")
        size = table_bytes(vocabulary, "term")
        if not size:
            raise ValueError(f"no term is in {self.value('minDf')} or more texts")
        coded = coded_terms(vocabulary, self.terms(), self.limits, size)
        sums = write_table(add_up(vocabulary, size, coded), "sums")
        top = impchi.top_terms(impchi.chi2_of_sums(sums, counts), self.value("kPerLabel"))
        name = impchi.char_feature_name if self.value("analyzer") == "char" else impchi.word_feature_name
        selected = impchi.selected_vocabulary(top).withColumn("name", name())
        selected = write_table(selected.join(vocabulary.select("term", "idf"), "term"), "selected")
        names = [r["name"] for r in selected.select("idx", "name").orderBy("idx").collect()]
        model = TfidfSelectorModel(names=names, size=size, vocabulary=vocabulary, selected=selected)
        model.known_codes = self.limits, coded
        return self._copyValues(model)


class TfidfSelectorModel(Model, _SelectorParams, TableModel):
    _field_names = ("names", "size")
    _table_names = ("vocabulary", "selected")

    def __init__(self, names, size, vocabulary, selected):
        super().__init__()
        self._text_defaults("terms")
        self.names, self.size, self.vocabulary, self.selected = names, size, vocabulary, selected
        self.known_codes = None

    def codes(self):
        """The codes of the vocabulary, or ``None``: made once for given limits."""
        if self.known_codes is None or self.known_codes[0] != self.limits:
            self.known_codes = self.limits, coded_terms(self.vocabulary, self.terms(), self.limits, self.size)
        return self.known_codes[1]

    def get_feature_names_out(self):
        return list(self.names)

    def features(self, rows: DataFrame) -> DataFrame:
        id_col, text_col, terms = self.value("idCol"), self.value("textCol"), self.terms()
        counted = lambda some: self.features_of(term_counts(some, id_col, text_col, terms))
        coded = self.codes()
        if coded is None:
            return counted(rows)
        single, rest = split_repeats(rows.select(id_col, text_col), id_col)
        folded = terms.folded(by_id(single, id_col), text_col)
        found = weights(folded, [id_col], "__folded", coded, self.selected)
        found = found.select(id_col, impchi.dense(F.col("found"), F.lit(1.0), len(self.names)).alias("features"))
        return found if rest is None else found.unionByName(counted(rest))

    def beside(self, text: Column):
        """A column to put beside a text and what makes its features of that column, or ``None`` if a task cannot hold the vocabulary."""
        terms = self.terms()
        coded = self.codes()
        if coded is None:
            return None
        return coded_found(text, terms, coded, self.selected), lambda found: impchi.dense(found, F.lit(1.0), len(self.names))

    def features_of_nested(self, nested: DataFrame) -> DataFrame:
        """The features of a nested table of texts that are counted already, each with an id of its own."""
        id_col = self.value("idCol")
        coded = self.codes()
        if coded is None:
            return self.features_of(unnested(nested, id_col))
        found = weights(nested, [id_col], "terms", coded, self.selected)
        return found.select(id_col, impchi.dense(F.col("found"), F.lit(1.0), len(self.names)).alias("features"))

    def features_of(self, counts: DataFrame) -> DataFrame:
        """The features of texts whose terms are counted already."""
        id_col = self.value("idCol")
        return impchi.feature_arrays(counts, self.vocabulary, self.selected, id_col, len(self.names), self.limits, self.size)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self._append(dataset, self.features(dataset))


class WordTfidfSelector(TfidfSelector):
    """Word n-grams without stop words."""


class CharTfidfSelector(TfidfSelector):
    """Character n-grams inside padded tokens."""

    def __init__(self, **params):
        super().__init__()
        self._setDefault(kPerLabel=30, minDf=5, ngramMin=3, ngramMax=5, analyzer="char", outputCol="char_terms")
        self.set(**params)


class MeanVectorEmbedder(Estimator, _Block, DefaultParamsReadable, DefaultParamsWritable):
    """Mean of pretrained word vectors. Fitting reads the vector table, not the texts."""

    vectorsPath = Param(Params._dummy(), "vectorsPath", "word vectors", TypeConverters.toString)
    vectorsFormat = Param(Params._dummy(), "vectorsFormat", "'parquet', 'text' or 'word2vec' (binary)", TypeConverters.toString)

    def __init__(self, **params):
        super().__init__()
        self._text_defaults("embedding")
        self._setDefault(vectorsFormat="parquet")
        self.set(**params)

    def fit_vectors(self, spark) -> "MeanVectorEmbedderModel":
        vectors = read_vectors(spark, self.value("vectorsPath"), self.value("vectorsFormat"))
        if self.value("vectorsFormat") != "parquet":
            vectors = write_table(vectors, "vectors")
        stats = vectors.agg(
            F.count("*").alias("n"),
            F.min(F.size("vector")).alias("lo"),
            F.max(F.size("vector")).alias("hi"),
        ).first()
        if not stats["n"]:
            raise ValueError("the vector table is empty")
        if stats["lo"] != stats["hi"]:
            raise ValueError(f"vectors have {stats['lo']} to {stats['hi']} dimensions")
        if vectors.groupBy("word").count().where("count > 1").limit(1).count():
            raise ValueError("a word has more than one vector")
        model = MeanVectorEmbedderModel(dim=stats["hi"], size=table_bytes(vectors, "word"), vectors=vectors)
        return self._copyValues(model)

    def _fit(self, dataset: DataFrame) -> "MeanVectorEmbedderModel":
        return self.fit_vectors(dataset.sparkSession)


class MeanVectorEmbedderModel(Model, _Block, TableModel):
    _field_names = ("dim", "size")
    _table_names = ("vectors",)

    def __init__(self, dim, size, vectors):
        super().__init__()
        self._text_defaults("embedding")
        self.dim, self.size, self.vectors = dim, size, vectors

    def get_feature_names_out(self):
        return [f"glove_{i}" for i in range(self.dim)]

    def features(self, rows: DataFrame) -> DataFrame:
        return pooled_vectors(
            rows, self.value("idCol"), self.value("textCol"), self.vectors, self.dim, self.limits, self.size
        )

    def beside(self, text: Column):
        """As for term blocks."""
        sums = pooled_beside(text, self.vectors, self.dim, self.limits, self.size)
        return None if sums is None else (sums, lambda found: mean(found["sums"], found["n"], self.dim))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self._append(dataset, self.features(dataset))
