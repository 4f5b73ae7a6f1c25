"""Importance resampling towards a target corpus, with an exact cutoff found by weighted medians of medians."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgrain.llm.shared import ship, written
from inkgrain.operators.rowid import dense_row_id

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: Keys still undecided that the driver may sort itself; a fixed bound (24 bytes a key).
FINISH = 4_096
#: Keys are written anew once the undecided ones are this fraction of the table, so that all rounds together read a multiple of it.
SHRINK = 8
CACHE_WORDS = 300_000

#: A-Z become lower case; bytes of no word become blanks. All bytes of other code points than ASCII belong to words.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(_FOLD).split() if raw else []


class FeatureBuckets:
    """Buckets of all runs of ``shortest`` to ``longest`` words, repeats included."""

    def __init__(self, shortest: int, longest: int, buckets: int):
        self.sizes, self.buckets, self.known = range(shortest, longest + 1), buckets, {}

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = Counter(words) if self.sizes == range(1, 2) else Counter(b" ".join(words[i : i + k]) for k in self.sizes for i in range(len(words) - k + 1))
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        for feature in found:
            if feature not in self.known:
                self.known[feature] = zlib.crc32(feature) % self.buckets
        at = np.fromiter(map(self.known.__getitem__, found), dtype=np.int64, count=len(found))
        return at, np.fromiter(found.values(), dtype=np.int64, count=len(found))


def feature_counts(texts: DataFrame, text_col: str = "text", runs: tuple[int, int] = (1, 1), buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket. Each task sends its sums, one row a bucket at most."""
    ship(texts.sparkSession)

    def count(batches):
        place, total = FeatureBuckets(*runs, buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                at, n = place(words_of(raw))
                np.add.at(total, at, n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    sums = texts.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in sums.collect():  # bounded by the number of buckets
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed share in the target and in the corpus, rounded down."""
    k, s, t = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000.0 * math.log((b + 1.0) * (s + k) / ((a + 1.0) * (t + k)))) for a, b in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def importance(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", runs: tuple[int, int] = (1, 1), seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score``: one pass, the gains are sent along (one number a bucket)."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(gain)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def weigh(batches):
        value = sent.value
        place = FeatureBuckets(*runs, len(value))
        for batch in batches:
            words, sizes, weights = [], [], []
            for raw in batch.column("text").to_pylist():
                found = words_of(raw)
                at, n = place(found)
                size = int(n.sum())
                words.append(len(found))
                sizes.append(size)
                weights.append(int((value[at] * n).sum()) // size if size else 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(weights, pa.int64())], ["doc_id", "n_words", "n_features", "weight"])

    weighed = rows.mapInArrow(weigh, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000.0 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", F.col("weight") + noise)


Key = tuple[int, int, int]


def _before(columns, key: Key, strictly: bool = True):
    mine, other = F.struct(*columns), F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(columns, key)])
    return mine < other if strictly else mine <= other


def weighted_median(medians: list[tuple[Key, int]]) -> Key:
    """The key at which half of the weight is reached."""
    half, seen = sum(n for _, n in medians) / 2, 0
    for key, n in sorted(medians):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def smallest(keys: DataFrame, count: int, finish: int = FINISH) -> Key:
    """The ``count``-th smallest of the distinct keys ``(a, b, c)``, three long columns without nulls.

    Every task gives the median of its undecided keys, and how many these are. The weighted median of the medians has at least a quarter of the
    undecided keys on either side of it, so each round discards at least that share. A round is one job, in which each task
    splits its keys at the pivot and finds the medians of both sides: the driver learns from the counts which side
    holds the cutoff, and has its next pivot at once. Only one row a task reaches the driver, and at the end ``finish`` keys.
    """
    columns = ["a", "b", "c"]
    low: Key | None = None
    high: Key | None = None
    pivot: Key | None = None
    size = None
    while True:

        def split(batches, pivot=pivot):
            parts = [np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]) for batch in batches if batch.num_rows]
            if not parts:
                return
            k = np.concatenate(parts)
            k = k[np.lexsort((k[:, 2], k[:, 1], k[:, 0]))]
            at, end = len(k), len(k)
            if pivot is not None:
                less, same = np.zeros(len(k), dtype=bool), np.ones(len(k), dtype=bool)
                for i in range(3):
                    less |= same & (k[:, i] < pivot[i])
                    same &= k[:, i] == pivot[i]
                at = int(less.sum())
                end = at + int(same.sum())
            left, right = k[:at], k[end:]
            mid = lambda part: part[(len(part) - 1) // 2].tolist() if len(part) else None
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(left)], pa.int64()), pa.array([mid(left)], pa.list_(pa.int64())), pa.array([len(right)], pa.int64()), pa.array([mid(right)], pa.list_(pa.int64()))],
                ["n_left", "left", "n_right", "right"],
            )

        open_keys = keys
        if low is not None:
            open_keys = open_keys.where(~_before(columns, low, strictly=False))
        if high is not None:
            open_keys = open_keys.where(_before(columns, high))
        found = open_keys.mapInArrow(split, "n_left long, left array<long>, n_right long, right array<long>").collect()
        left, right = sum(r["n_left"] for r in found), sum(r["n_right"] for r in found)
        if pivot is None:
            size, left_side = left, True
        elif count == left + 1:
            return pivot
        else:
            left_side = count <= left
            if left_side:
                high = pivot
            else:
                low, count = pivot, count - left - 1
        n = left if left_side else right
        if n <= finish:
            rest = keys
            if low is not None:
                rest = rest.where(~_before(columns, low, strictly=False))
            if high is not None:
                rest = rest.where(_before(columns, high))
            return sorted(tuple(r) for r in rest.collect())[count - 1]
        pivot = weighted_median([(tuple(r["left"]), r["n_left"]) for r in found if r["n_left"]] if left_side else [(tuple(r["right"]), r["n_right"]) for r in found if r["n_right"]])
        if n * SHRINK <= size:
            if low is not None:
                keys = keys.where(~_before(columns, low, strictly=False))
            if high is not None:
                keys = keys.where(_before(columns, high))
            keys, size = written(keys, "undecided"), n


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    runs: tuple[int, int] = (1, 1),
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Draw ``percent`` of the documents of ``least_words`` or more words, likelier the more they resemble the target texts.

    Returns ``doc_id, n_features, weight, score, rank`` of every row. Words are runs of a-z, 0-9 and all code points beyond ASCII after lower-casing
    A-Z; features are runs of words, hashed into buckets. The weight is the mean gain of a document's features, the score adds Gumbel noise that
    depends on seed and id alone, and the highest scores are drawn; ties go to the smaller id. The exact cutoff comes from :func:`smallest`;
    only winners are sorted (by range), all other rows pass without a shuffle.

    Null or empty texts have no feature, weight 0 and no rank. A null id hashes as the empty text and comes after all others in ties.
    Repeated rows count each; if the cutoff falls among rows alike in score and id, their place in the table decides. Empty tables
    give no rows, and an empty target gives gains from the corpus alone. Other columns are not read. Ids are integers.
    """
    gain = gains(feature_counts(docs, text_col, runs, buckets), feature_counts(target, target_text_col, runs, buckets))
    scored = importance(docs, gain, id_col, text_col, runs, seed)
    rows = written(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    rows = rows.withColumn("a", -F.col("score")).withColumn("b", F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))).withColumn("c", F.col("row"))
    fit = F.col("n_words") >= least_words
    count = rows.where(fit).count() * percent // 100
    out = ["doc_id", "n_features", "weight", "score"]
    undrawn = F.lit(None).cast("long").alias("rank")
    if not count:
        return rows.select(*out, undrawn)
    cut = smallest(rows.where(fit).select("a", "b", "c"), count)
    won = fit & _before(["a", "b", "c"], cut, strictly=False)
    ranked = dense_row_id(rows.where(won), "rank", ["a", "b", "c"])
    return rows.where(~won).select(*out, undrawn).unionByName(ranked.select(*out, (F.col("rank") + 1).alias("rank")))
