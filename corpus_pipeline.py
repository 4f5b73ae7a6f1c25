"""From raw documents to packed training sequences; each stage reads what the one before has written."""

from __future__ import annotations

import functools
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkgrain.llm.exact import drop_exact
from inkgrain.llm.neardup import drop_near
from inkgrain.llm.packing import pack
from inkgrain.llm.shared import bucket, collected, drop_unread, table, written
from inkgrain.llm.spans import remove_repeats
from inkgrain.llm.toxicity import score_toxicity, train_toxicity

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


#: Working tables of the stages that ran, by application.
_working: dict[str, list[str]] = {}


def stage(function):
    """A stage first deletes the working tables of stages before it that its input does not read any more."""

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        stay = drop_unread(_working.pop(app, []), docs)
        with collected() as paths:
            out = function(spark, docs, sf_dir)
        _working[app] = stay + paths
        return out

    return run_stage


@stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half. The machine learns from labelled rows whose crc32(doc_id) mod 5 is not 0."""
    labels = table(spark, sf_dir, "labels")
    machine = train_toxicity(docs, labels.where(bucket(F.col("doc_id"), 5) != 0))
    rows = docs.select("doc_id", "text", F.struct("*").alias("_row"))
    return score_toxicity(rows, machine, also=("_row",)).where("predicted = 0").select("_row.*")


@stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for blanks, the longest (then smallest id) stays."""
    return drop_exact(docs)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a class of near duplicates, the document with the smallest id stays."""
    return drop_near(docs)


@stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words that an earlier document holds; texts that lose nothing stay as they are."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_row")
    cut = remove_repeats(docs.select("doc_id", "text", rest), also=("_row",), as_is=True)
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("_row.n_chars"))
    new = {"text": F.col("kept"), "n_chars": n_chars}
    return cut.select(*[(new[c] if c in new else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 ids, with the ids (little-endian, 32 bits each) and their crc32."""
    return pack(docs, f"{TOKENIZERS}/byte_bpe_50k.tiktoken").withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("packing", packing),
]

#: Learnt scores, similarity classes and token ids are not expressible in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    app = spark.sparkContext.applicationId
    _working.pop(app, None)  # the result of a call before may still be read
    for name, function in STAGES[:-1]:
        result = function(spark, docs, sf_dir)
        with collected() as paths:
            docs = written(result, name.replace(" ", "_"))
        _working[app] += paths
    return STAGES[-1][1](spark, docs, sf_dir)
