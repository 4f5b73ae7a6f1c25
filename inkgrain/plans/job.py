"""End-to-end job: read both tables (CSV, or Parquet by the ending of the path), tune, evaluate, pseudo-label, write predictions.

    spark-submit --conf spark.checkpoint.dir=<shared folder> -m inkgrain.plans.job \\
        --train train.csv --test test.csv --vectors vectors.parquet --out predictions
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from inkgrain.operators import metrics as mt
from inkgrain.operators.blocks import MeanVectorEmbedder
from inkgrain.operators.rowid import dense_row_id, require_unique
from inkgrain.operators.store import write_table
from inkgrain.operators.splits import stratified_split
from inkgrain.plans.evaluate import score_by
from inkgrain.plans.factory import build_pipeline
from inkgrain.plans.pseudo import pseudo_label_round
from inkgrain.plans.search import search
from inkgrain.sources import csv


#: Column for the place of a row in its files, until rows have ids.
PLACE = "__place"


@dataclass
class Config:
    train_path: str = "./dataset/train.csv"
    test_path: str = "./dataset/test.csv"
    out_path: str = "./predictions"
    vectors_path: str | None = None
    vectors_format: str = "parquet"
    text_col: str = "TEXT"
    label_col: str = "LABEL"
    id_col: str = "id"
    multi_line: bool = True
    model: str = "gbt"
    model_params: dict = field(default_factory=dict)
    cv_folds: int = 5
    cv_metric: str = "f1_macro"
    run_tuning: bool = True
    n_trials: int = 7
    timeout_sec: float | None = None
    parallelism: int = 1
    test_size: float = 0.15
    threshold: float = 0.90
    seed: int = 42
    space: dict | None = None
    feature_space: dict | None = None
    study_path: str | None = None


def exists(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def run(spark: SparkSession, cfg: Config) -> dict:
    """Checks the input and the output path before any training. Returns the tables of the run; the predictions are written to ``out_path``."""
    text, label, key = cfg.text_col, cfg.label_col, cfg.id_col
    if exists(spark, cfg.out_path):
        raise ValueError(f"{cfg.out_path} is there already")
    how = {"multi_line": cfg.multi_line, "split": True}
    given = csv.read_labelled(spark, cfg.train_path, text, label, **how, place_col=PLACE)
    # the files are read once: what follows reads the written table
    train = write_table(dense_row_id(given, key, order_by=PLACE).drop(PLACE), "train")
    unlabelled = train.where(F.col(label).isNull()).count()
    if unlabelled:
        raise ValueError(f"{unlabelled} rows of {cfg.train_path} have no {label}")
    if csv.has_column(spark, cfg.test_path, key):
        test = write_table(csv.read_unlabelled(spark, cfg.test_path, text, key, **how), "test")
        require_unique(test, key)
    else:
        unnamed = csv.read_unlabelled(spark, cfg.test_path, text, **how, place_col=PLACE)
        test = write_table(dense_row_id(unnamed, key, order_by=PLACE).drop(PLACE), "test")

    embedder = None
    if cfg.vectors_path:
        stage = MeanVectorEmbedder(vectorsPath=cfg.vectors_path, vectorsFormat=cfg.vectors_format)
        embedder = stage.fit_vectors(spark)

    parts = write_table(stratified_split(train, label, key, cfg.test_size, cfg.seed), "parts")
    fit_part = parts.where("NOT is_test").drop("is_test")

    settings = {"model": cfg.model, "model_params": cfg.model_params}
    best_score, trials = None, None
    if cfg.run_tuning:
        settings, best_score, trials = search(
            fit_part,
            embedder,
            text,
            label,
            key,
            cfg.model,
            cfg.n_trials,
            cfg.cv_folds,
            cfg.seed,
            cfg.cv_metric,
            cfg.timeout_sec,
            cfg.parallelism,
            cfg.space,
            cfg.feature_space,
            study=cfg.study_path,
        )

    def fresh_pipeline():
        return build_pipeline(text, label, key, vectors=embedder, **settings)

    held = fresh_pipeline().fit(fit_part).transform(parts.where("is_test"))
    held = write_table(held.select(label, "prediction"), "held")

    predictions, summary = pseudo_label_round(train, test, fresh_pipeline, text, label, key, cfg.threshold)
    csv.write_predictions(predictions, cfg.out_path, key, label)
    written = csv.read_predictions(spark, cfg.out_path, dict(test.dtypes)[key], dict(train.dtypes)[label])
    return {
        "labels": mt.label_distribution(train, label),
        "settings": settings,
        "best_score": best_score,
        "trials": trials,
        "macro_f1": score_by(held, label, "prediction", "f1_macro"),
        "report": mt.classification_report(held, label, "prediction"),
        "summary": summary,
        "distribution": mt.label_distribution(written, "label"),
    }


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--train", required=True)
    parser.add_argument("--test", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--vectors")
    parser.add_argument("--vectors-format", default="parquet")
    parser.add_argument("--model", default="gbt")
    parser.add_argument("--trials", type=int, default=7)
    parser.add_argument("--folds", type=int, default=5)
    parser.add_argument("--metric", default="f1_macro")
    parser.add_argument("--no-tuning", action="store_true")
    parser.add_argument("--timeout-sec", type=float)
    parser.add_argument("--study", help="shared folder that keeps finished trials, so that a stopped job goes on after them")
    parser.add_argument("--parallelism", type=int, default=1)
    parser.add_argument("--threshold", type=float, default=0.90, help="1.01 turns pseudo-labels off")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("inkgrain").getOrCreate()
    result = run(
        spark,
        Config(
            train_path=args.train,
            test_path=args.test,
            out_path=args.out,
            vectors_path=args.vectors,
            vectors_format=args.vectors_format,
            model=args.model,
            n_trials=args.trials,
            cv_folds=args.folds,
            cv_metric=args.metric,
            run_tuning=not args.no_tuning,
            timeout_sec=args.timeout_sec,
            study_path=args.study,
            parallelism=args.parallelism,
            threshold=args.threshold,
        ),
    )
    for name in ("labels", "trials", "macro_f1", "report", "summary", "distribution"):
        if result[name] is not None:
            print(name)
            result[name].show(100, truncate=False)


if __name__ == "__main__":
    main(sys.argv[1:])
