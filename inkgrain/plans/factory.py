"""The whole classifier as one Spark ML pipeline."""

from __future__ import annotations

from pyspark.ml import Pipeline

from inkgrain.operators.blocks import CharTfidfSelector, MeanVectorEmbedder, WordTfidfSelector
from inkgrain.operators.union import TextFeatures
from inkgrain.plans.registry import make_classifier


def word_block(params: dict | None = None) -> WordTfidfSelector:
    params = dict(params or {})
    stage = WordTfidfSelector()
    if "k_per_label" in params:
        stage.set(kPerLabel=params.pop("k_per_label"))
    if "min_df" in params:
        stage.set(minDf=params.pop("min_df"))
    if "ngram_range" in params:
        lo, hi = params.pop("ngram_range")
        stage.set(ngramMin=lo, ngramMax=hi)
    if "stop_words" in params:
        stage.set(stopWords=list(params.pop("stop_words")))
    if params:
        raise ValueError(f"unknown word parameters {sorted(params)}")
    return stage


def char_block(params: dict | None = None) -> CharTfidfSelector:
    params = dict(params or {})
    k = params.pop("k_per_label_char", params.pop("k_per_label", 30))
    min_df = params.pop("min_df_char", params.pop("min_df", 5))
    params.pop("k_per_label", None)
    params.pop("min_df", None)
    if params:
        raise ValueError(f"unknown char parameters {sorted(params)}")
    return CharTfidfSelector(kPerLabel=k, minDf=min_df)


def build_pipeline(
    text_col: str = "TEXT",
    label_col: str = "LABEL",
    id_col: str = "id",
    vectors=None,
    word_params: dict | None = None,
    char_params: dict | None = None,
    model: str = "gbt",
    model_params: dict | None = None,
    static_col: str | None = None,
    static_names=(),
) -> Pipeline:
    """Unfitted ``Pipeline(features, classifier)``.

    ``vectors`` is the path of a vector table or a fitted embedder. With ``static_col``,
    an array column that already holds the scalar and embedding blocks, only the two term
    blocks are fitted.
    """
    blocks = []
    if static_col is None and vectors is not None:
        blocks.append(MeanVectorEmbedder(vectorsPath=vectors) if isinstance(vectors, str) else vectors)
    blocks += [word_block(word_params), char_block(char_params)]
    columns = {"textCol": text_col, "labelCol": label_col, "idCol": id_col}
    features = TextFeatures(blocks, static_col=static_col, static_names=static_names, **columns)
    classifier = make_classifier(model, model_params)
    classifier._set(labelCol=label_col, idCol=id_col)
    return Pipeline(stages=[features, classifier])
