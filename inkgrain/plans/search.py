"""Seeded random search for hyper-parameters over distributed cross-validation."""

from __future__ import annotations

import json
import math
import random
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgrain.operators.splits import stratified_folds
from inkgrain.plans.evaluate import LEAST_DF, cross_validate, static_features
from inkgrain.plans.registry import ALIASES, MODELS

#: Columns of a kept trial.
STUDY = "trial_id int, params string, score double, kind string"
# Ranges to draw from.
SPACES = {
    "gbt": {
        "n_estimators": ("int", 100, 500, 50),
        "learning_rate": ("log", 0.01, 0.10),
        "max_depth": ("int", 3, 5, 1),
        "num_leaves": ("int", 10, 20, 1),
        "min_child_samples": ("int", 20, 60, 1),
        "reg_alpha": ("uniform", 0.1, 1.0),
        "reg_lambda": ("uniform", 1.0, 10.0),
        "min_split_gain": ("uniform", 0.05, 0.5),
        "colsample_bytree": ("uniform", 0.4, 0.8),
        "subsample": ("uniform", 0.5, 0.8),
    },
    "random_forest": {
        "n_estimators": ("int", 200, 600, 50),
        "max_depth": ("int", 3, 8, 1),
        "min_samples_leaf": ("int", 5, 30, 1),
        "max_features": ("choice", ["sqrt", "log2", 0.3]),
    },
    "linear_svc": {
        "estimator__C": ("log", 1e-3, 2.0),
        "estimator__loss": ("choice", ["hinge", "squared_hinge"]),
        "estimator__tol": ("log", 1e-6, 1e-3),
    },
    "gbt_plain": {
        "n_estimators": ("int", 100, 500, 50),
        "learning_rate": ("log", 0.01, 0.10),
        "max_depth": ("int", 3, 5, 1),
        "min_child_weight": ("int", 10, 50, 1),
        "subsample": ("uniform", 0.5, 0.8),
        "colsample_bytree": ("uniform", 0.4, 0.8),
        "reg_alpha": ("uniform", 0.1, 5.0),
        "reg_lambda": ("uniform", 1.0, 10.0),
        "gamma": ("uniform", 0.1, 2.0),
    },
    "ensemble": {},
}
FEATURE_SPACE = {
    "k_per_label": ("int", 10, 30, 1),
    "min_df": ("int", 3, 7, 1),
    "ngram_range": ("choice", ["unigram", "bigram"]),
    "k_per_label_char": ("int", 10, 30, 1),
    "min_df_char": ("int", 4, 9, 1),
}


def draw(space: dict, rng: random.Random) -> dict:
    out = {}
    for name, (kind, *spec) in space.items():
        if kind == "int":
            lo, hi, step = spec
            out[name] = lo + step * rng.randrange((hi - lo) // step + 1)
        elif kind == "uniform":
            out[name] = rng.uniform(*spec)
        elif kind == "log":
            out[name] = math.exp(rng.uniform(math.log(spec[0]), math.log(spec[1])))
        elif kind == "choice":
            out[name] = rng.choice(spec[0])
        else:
            raise ValueError(f"unknown kind of range {kind!r}")
    return out


def least_of(spec) -> int:
    """The least value that a range of whole numbers gives."""
    return min(spec[1]) if spec[0] == "choice" else spec[1]


def trial_settings(model: str, clf_params: dict, feature_params: dict) -> dict:
    """Arguments of ``build_pipeline`` for one trial."""
    span = {"unigram": (1, 1), "bigram": (1, 2)}[feature_params["ngram_range"]]
    return {
        "model": model,
        "model_params": clf_params,
        "word_params": {**{k: feature_params[k] for k in ("k_per_label", "min_df")}, "ngram_range": span},
        "char_params": {k: feature_params[k] for k in ("k_per_label_char", "min_df_char")},
    }


def best_trial(trials: DataFrame) -> DataFrame:
    """The trial with the highest score; the first id among equals."""
    return trials.orderBy(F.desc("score"), "trial_id").limit(1)


def finished_trials(spark, study: str, kind: str) -> dict[int, float]:
    """Scores of the trials that a study folder holds; a trial that was being written when its driver was lost does not count."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(study)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    marks = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, "trial-*/_SUCCESS"))
    paths = [str(m.getPath().getParent()) for m in marks or ()]
    if not paths:
        return {}
    rows = spark.read.schema(STUDY).parquet(*paths).collect()
    if any(r["kind"] != kind for r in rows):
        raise ValueError(f"{study} holds a study of other settings")
    return {r["trial_id"]: r["score"] for r in rows}


def search(
    rows: DataFrame,
    embedder,
    text_col: str,
    label_col: str,
    id_col: str,
    model: str = "gbt",
    n_trials: int = 7,
    k: int = 5,
    seed: int = 42,
    metric: str = "f1_macro",
    timeout_sec: float | None = None,
    parallelism: int = 1,
    space: dict | None = None,
    feature_space: dict | None = None,
    study: str | None = None,
):
    """``(settings, score, trials)``: the best arguments for ``build_pipeline``, their mean
    score, and one row per trial ``(trial_id, params, score)``.

    No further trial starts after ``timeout_sec``. ``study`` names a shared folder that keeps every finished trial: a search that was
    stopped goes on after the last of them, with the draws it would have made, and refuses a folder of other settings.
    """
    model = ALIASES.get(model, model)
    if model not in MODELS:
        raise ValueError(f"unknown model {model!r}: use one of {', '.join(MODELS)}")
    if n_trials < 1:
        raise ValueError("at least one trial is needed")
    dealt = stratified_folds(rows.select(id_col, text_col, label_col), label_col, id_col, k, seed)
    table, names = static_features(dealt, embedder, text_col, label_col, id_col, keep=["fold"])
    rng, started, done = random.Random(seed), time.monotonic(), []
    # term tables, by kind of terms: trials read them instead of the texts
    trials_features = {**FEATURE_SPACE, **(feature_space or {})}
    shared: dict = {LEAST_DF: {"word": least_of(trials_features["min_df"]), "char": least_of(trials_features["min_df_char"])}}
    spark = rows.sparkSession
    kind = json.dumps({"model": model, "k": k, "seed": seed, "metric": metric, "space": space, "feature_space": feature_space}, sort_keys=True)
    known = finished_trials(spark, study, kind) if study else {}
    for trial in range(n_trials):
        if done and trial not in known and timeout_sec is not None and time.monotonic() - started > timeout_sec:
            break
        clf_params = draw(SPACES[model] if space is None else space, rng)
        feature_params = draw(trials_features, rng)
        settings = trial_settings(model, clf_params, feature_params)
        params = json.dumps({**clf_params, **feature_params}, sort_keys=True)
        if trial in known:
            done.append((trial, params, known[trial], settings))
            continue
        scores = cross_validate(table, names, text_col, label_col, id_col, k, settings, metric, parallelism, shared)
        done.append((trial, params, float(scores.agg(F.avg("score")).first()[0]), settings))
        if study:
            spark.createDataFrame([(*done[-1][:3], kind)], STUDY).coalesce(1).write.mode("overwrite").parquet(f"{study}/trial-{trial:06d}")
    trials = spark.createDataFrame([d[:3] for d in done], "trial_id int, params string, score double")
    best = best_trial(trials).first()
    return done[best["trial_id"]][3], best["score"], trials
