"""Classifier presets by name, with parameter names translated to Spark's."""

from __future__ import annotations

from inkgrain.operators.boosting import SoftmaxTrees
from inkgrain.operators.classifiers import BoostedTrees, CalibratedSvc, Forest, SoftVoting

# Accepted parameter names and what they are called here.
BOOSTING_NAMES = {
    "n_estimators": "rounds",
    "learning_rate": "rate",
    "max_depth": "depth",
    "num_leaves": "num_leaves",
    "min_child_samples": "min_rows",
    "min_child_weight": "min_hessian",
    "min_split_gain": "min_gain",
    "gamma": "min_gain",
    "reg_alpha": "l1",
    "reg_lambda": "l2",
    "subsample": "bag",
    "subsample_freq": "bag_every",
    "colsample_bytree": "columns",
    "max_bin": "bins",
    "random_state": "seed",
}
# Objectives by name; the first kind is one joint log loss, the second a model per class.
JOINT = ("multiclass", "softmax", "multi:softprob", "multi:softmax")
PER_CLASS = ("multiclassova", "ova")
# Settings that say how to run or report, not what to fit.
NO_EFFECT = ("boosting_type", "class_weight", "eval_metric", "metric", "n_jobs", "num_class", "verbosity")
# The same for one-vs-rest trees, which are Spark's own.
GBT_NAMES = {
    "n_estimators": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "min_child_samples": "minInstancesPerNode",
    "min_child_weight": "minInstancesPerNode",
    "min_split_gain": "totalGain",
    "gamma": "totalGain",
    "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "random_state": "seed",
}
FOREST_NAMES = {
    "n_estimators": "numTrees",
    "max_depth": "maxDepth",
    "min_samples_leaf": "minInstancesPerNode",
    "max_features": "featureSubsetStrategy",
    "random_state": "seed",
}
SVC_NAMES = {"C": "C", "loss": "loss", "tol": "tol", "max_iter": "maxIter", "random_state": "seed"}

# Settings used unless others are given.
GBT_DEFAULTS = {
    "n_estimators": 300,
    "learning_rate": 0.05,
    "max_depth": 4,
    "num_leaves": 15,
    "min_child_samples": 40,
    "min_split_gain": 0.1,
    "reg_alpha": 0.5,
    "reg_lambda": 5.0,
    "colsample_bytree": 0.6,
    "subsample": 0.7,
    "subsample_freq": 5,
    "random_state": 42,
}
PLAIN_GBT_DEFAULTS = {
    "n_estimators": 300,
    "learning_rate": 0.05,
    "max_depth": 4,
    "min_child_weight": 30,
    "gamma": 0.5,
    "reg_alpha": 1.0,
    "reg_lambda": 5.0,
    "colsample_bytree": 0.6,
    "subsample": 0.7,
    "subsample_freq": 1,
    "random_state": 42,
}
# Settings of the pipeline that is built without a search.
PIPELINE_GBT = {
    "objective": "multiclass",
    "class_weight": "balanced",
    "metric": "multi_logloss",
    "n_estimators": 400,
    "boosting_type": "gbdt",
    "random_state": 42,
    "learning_rate": 0.05,
    "num_leaves": 63,
    "max_depth": 6,
    "min_child_samples": 20,
    "reg_alpha": 0.1,
    "reg_lambda": 2.0,
    "min_split_gain": 0.01,
    "colsample_bytree": 0.6,
    "subsample": 0.8,
    "subsample_freq": 5,
}
FOREST_DEFAULTS = {"n_estimators": 100, "max_depth": 30, "max_features": "sqrt", "random_state": 42}
SVC_DEFAULTS = {"C": 1.0, "loss": "squared_hinge", "max_iter": 5000, "random_state": 42}
#: Losses that the planes know.
SVC_LOSSES = ("hinge", "squared_hinge")
ENSEMBLE_SVC = {"C": 0.1}


def translate(params: dict, names: dict, model: str) -> dict:
    """Spark settings; a parameter that Spark's trees do not have is an error, never ignored."""
    unknown = sorted(set(params) - set(names))
    if unknown:
        raise ValueError(f"{model} has no parameter {', '.join(unknown)}; known are {', '.join(sorted(names))}")
    out = {names[k]: v for k, v in params.items()}
    if "featureSubsetStrategy" in out:
        out["featureSubsetStrategy"] = str(out["featureSubsetStrategy"])
    return out


def boosted(params: dict, defaults: dict, model: str, balanced: bool):
    """Joint softmax trees, or Spark's own trees per class, which know fewer settings."""
    params = {k: v for k, v in params.items() if k not in NO_EFFECT}
    objective = params.pop("objective", JOINT[0])
    if objective in JOINT:
        return SoftmaxTrees(translate({**defaults, **params}, BOOSTING_NAMES, model), balanced=balanced)
    if objective not in PER_CLASS:
        raise ValueError(f"{model} has no objective {objective!r}; known are {', '.join(JOINT + PER_CLASS)}")
    known = {k: v for k, v in defaults.items() if k in GBT_NAMES}
    return BoostedTrees(translate({**known, **params}, GBT_NAMES, model), balanced=balanced)


def gbt(params: dict):
    return boosted(params, GBT_DEFAULTS, "gbt", balanced=params.get("class_weight", "balanced") == "balanced")


def gbt_plain(params: dict):
    """The second boosted preset: no class weights."""
    return boosted(params, PLAIN_GBT_DEFAULTS, "gbt_plain", balanced=False)


def random_forest(params: dict):
    return Forest(translate({**FOREST_DEFAULTS, **params}, FOREST_NAMES, "random_forest"))


def linear_svc(params: dict):
    plain = {k.removeprefix("estimator__"): v for k, v in params.items()}
    settings = translate({**SVC_DEFAULTS, **plain}, SVC_NAMES, "linear_svc")
    if settings["loss"] not in SVC_LOSSES:
        raise ValueError(f"linear_svc knows no loss {settings['loss']!r}; known are {', '.join(SVC_LOSSES)}")
    return CalibratedSvc(settings)


def ensemble(params: dict):
    """Soft vote of both boosted presets and the calibrated planes.

    The members keep their own settings. ``n_estimators`` alone may be given, for the size
    of both boosted members.
    """
    extra = sorted(set(params) - {"n_estimators"})
    if extra:
        raise ValueError(f"ensemble members have fixed settings; it has no parameter {', '.join(extra)}")
    return SoftVoting([gbt(params), gbt_plain(params), linear_svc(ENSEMBLE_SVC)])


MODELS = {
    "gbt": gbt,
    "random_forest": random_forest,
    "linear_svc": linear_svc,
    "gbt_plain": gbt_plain,
    "ensemble": ensemble,
}
ALIASES = {"lgbm": "gbt", "xgboost": "gbt_plain"}


def make_classifier(name: str, params: dict | None = None):
    name = ALIASES.get(name, name)
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}: use one of {', '.join(MODELS)}")
    return MODELS[name](dict(params or {}))
