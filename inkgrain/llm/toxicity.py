"""Toxicity scores from a factorization machine over hashed terms."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgrain.llm.shared import bucket, ship

HASH_BITS = 20
#: Bound of the training sample: labelled rows, taken by a hash of the id.
SAMPLE_ROWS = 20_000
#: Association with the label, in standard deviations, at which a term learns at a quarter of the full rate; without it the fit would learn
#: single documents by heart.
EVEN_Z = 4.5
#: Least rate of a term: no term of the sample is left out.
LEAST_RATE = 1e-3
#: Terms are partners, whose pairs with all other terms are looked at, if their association is as large as the largest one that so many terms
#: without any would show by chance, times this.
PARTNER_Z = 1.0
STEPS = 4_000
#: One row in so many is held out to tell when to stop; a fit ends when its loss has not fallen by this share for so many steps.
HELD = 10
LEAST_FALL = 5e-3
PATIENCE = 100
RANK = 8
CACHE_WORDS = 200_000

WORD = re.compile(r"\w+")


def hashed_terms(word: str) -> tuple[int, ...]:
    """Buckets of a word and of its beginnings of four and five letters (inflected and compound forms share them)."""
    forms = [word] if len(word) <= 3 else [word, f"{word[:4]}*"] if len(word) == 4 else [word, f"{word[:4]}*", f"{word[:5]}*"]
    return tuple(zlib.crc32(f.encode()) >> (32 - HASH_BITS) for f in forms)


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


@dataclass
class Machine:
    """score = sigmoid(bias + sum of weights + sum over pairs of terms of the product of their factors)."""

    terms: dict[int, int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logit(self, present) -> float:
        v = self.factors[present].astype(float)
        total = v.sum(axis=0)
        return self.bias + self.weights[present].sum(dtype=float) + 0.5 * float((total * total).sum() - (v * v).sum())

    def score(self, present) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(present), -35, 35))))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def rates(z2: np.ndarray) -> np.ndarray:
    return np.maximum((z2 / (z2 + EVEN_Z**2)) ** 2, LEAST_RATE).astype(np.float32)


def sums(n: int, flat: np.ndarray, cuts: np.ndarray, rows: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Per term, how many of ``rows`` hold it and the sums of their values; in blocks, so that temporary arrays stay small."""
    out = [np.zeros(n) for _ in range(len(values) + 1)]
    sizes = cuts[rows + 1] - cuts[rows]
    block = np.cumsum(sizes) >> 19
    for part in np.split(rows, np.flatnonzero(np.diff(block)) + 1):
        held = np.concatenate([flat[cuts[i] : cuts[i + 1]] for i in part])
        out[0] += np.bincount(held, minlength=n)
        for total, x in zip(out[1:], values):
            total += np.bincount(held, np.repeat(x[part], cuts[part + 1] - cuts[part]), n)
    return out


def pair_evidence(n: int, flat: np.ndarray, cuts: np.ndarray, labels: np.ndarray, p: np.ndarray, partners: np.ndarray) -> np.ndarray:
    """Per term, how far the labels of rows that it shares with a partner are from ``p``, the fit by single terms.

    It is the largest deviance over its pairs (a squared number of standard deviations, exact for small counts), as far as the
    other rows of either term do not explain it, less what the number of pairs brings by chance.
    """
    everything = np.arange(len(labels))
    seen, said, due = sums(n, flat, cuts, everything, labels, p)
    asked = np.zeros(n, dtype=bool)
    asked[partners] = True
    spots = np.flatnonzero(asked[flat])
    spots = spots[np.argsort(flat[spots], kind="stable")]
    first = np.searchsorted(flat[spots], np.append(partners, n))
    best, tested = np.zeros(n), 0
    for k, start, end in zip(partners, first[:-1], first[1:]):
        rows = np.searchsorted(cuts, spots[start:end], side="right") - 1
        if len(rows) < 3:
            continue
        sizes = cuts[rows + 1] - cuts[rows]
        if sizes.sum() < 1 << 17:
            at, held = np.unique(np.concatenate([flat[cuts[i] : cuts[i + 1]] for i in rows]), return_inverse=True)
            c, o, e = np.bincount(held), np.bincount(held, np.repeat(labels[rows], sizes)), np.bincount(held, np.repeat(p[rows], sizes))
        else:
            at, (c, o, e) = np.arange(n), sums(n, flat, cuts, rows, labels, p)
        keep = (c >= 3) & (c < seen[at])
        at, c, o, e = at[keep], c[keep], o[keep], e[keep]
        tested += len(at)
        apart = [(said[t] - o + 0.5) / (due[t] - e + 0.5) for t in (k, at)]  # their rows without each other
        both = np.stack([np.ones(len(at)), *apart])
        more = o >= e
        e = np.clip(np.where(more, e * both.max(axis=0), e * both.min(axis=0)), 1e-3 * c, (1 - 1e-3) * c)
        with np.errstate(divide="ignore", invalid="ignore"):
            d = 2 * (np.where(o > 0, o * np.log(o / e), 0) + np.where(o < c, (c - o) * np.log((c - o) / (c - e)), 0))
        d[(more != (o >= e)) | (at == k)] = 0  # the single terms say as much or more
        best[at] = np.maximum(best[at], d)
        if len(d):
            best[k] = max(best[k], d.max())
    return np.maximum(best - 2 * np.log(max(tested, 1)), 0)


def fit_machine(terms: list[int], rows: list, labels: np.ndarray, rank: int = RANK, steps: int = STEPS, seed: int = 7) -> Machine:
    """Logistic loss, AdaGrad on mini-batches. ``rows`` hold positions in ``terms``.

    Every term has a weight and factors. What curbs overfitting is the rate at which a term learns: it grows with the association of the
    term with the label, or of its pairs with what the weights leave unexplained, so that terms without any stay near zero.
    """
    rng = np.random.default_rng(seed)
    n = len(terms)
    place = {t: i for i, t in enumerate(terms)}
    w, v = np.zeros(n, dtype=np.float32), rng.normal(0, 0.01, (n, rank)).astype(np.float32)
    share = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-3, 1 - 1e-3))
    start = float(np.log(share / (1 - share)))
    if not len(labels) or labels.min() == labels.max():
        return Machine(place, start, w, v * 0)
    cuts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    flat = np.concatenate([np.asarray(r, dtype=np.int32) for r in rows])
    del rows  # a caller that hands them over keeps no second copy in the driver
    everything = np.arange(len(labels))
    seen, said = sums(n, flat, cuts, everything, labels)
    seen = np.maximum(seen, 1)
    z = (said - seen * share) / np.sqrt(seen * share * (1 - share))
    spot = np.zeros(n, dtype=np.int32)

    def deal(rows):
        """Sort a batch by term once: its rows and labels, the row of each sorted place, its terms and where each begins, and per row the term places."""
        idx = np.concatenate([flat[cuts[i] : cuts[i + 1]] for i in rows])
        sizes = cuts[rows + 1] - cuts[rows]
        by_term = np.argsort(idx, kind="stable")
        first = np.flatnonzero(np.diff(idx[by_term], prepend=-1))
        u = idx[by_term[first]]
        spot[u] = np.arange(len(u))
        return labels[rows], sizes, np.repeat(np.arange(len(rows), dtype=np.int16), sizes)[by_term], u, first.astype(np.int32), spot[idx]

    def logits(batch, w, v, b, pairs):
        _, sizes, _, u, _, at = batch
        some, starts = sizes > 0, (np.cumsum(sizes) - sizes)[sizes > 0]
        total = np.zeros((len(sizes), rank + 2 if pairs else 1), dtype=np.float32)
        if pairs:
            vu = v[u]
            held = np.column_stack([vu, (vu * vu).sum(axis=1), w[u]])
        else:
            held = w[u][:, None]
        total[some] = np.add.reduceat(held[at], starts, axis=0)
        z = b + total[:, -1].astype(float)
        return (z + 0.5 * ((total[:, :rank] ** 2).sum(axis=1) - total[:, rank]), total[:, :rank], vu) if pairs else (z, None, None)

    def held_loss(w, v, b, pairs):
        total = 0.0
        for batch in held:
            z = np.clip(logits(batch, w, v, b, pairs)[0], -35, 35)
            total += float((np.logaddexp(0, z) - batch[0] * z).sum())
        return total

    def descend(w, v, b, rate, epochs, pairs):
        """Adaptive steps over the batches, until the loss of the held-out rows has not fallen for ``PATIENCE`` steps. A last round from the
        best state takes in the held-out rows, so that their terms learn as well."""
        gw, gv, gb = np.full(n, 1e-2, dtype=np.float32), np.full((n, rank), 1e-2, dtype=np.float32), 1e-2
        best, since = (held_loss(w, v, b, pairs), w.copy(), v.copy(), b), 0
        for left in range(epochs, -1, -1):
            if not left or since >= PATIENCE:
                _, w, v, b = best
                left = 0
            for k in rng.permutation(len(batches) + (len(held) if not left else 0)):
                batch = batches[k] if k < len(batches) else held[k - len(batches)]
                y, sizes, r, u, first, _ = batch
                z, sums, vu = logits(batch, w, v, b, pairs)
                miss = sigmoid(z) - y
                each = (miss / len(y)).astype(np.float32)
                if pairs:
                    pull = np.add.reduceat(np.column_stack([sums * each[:, None], each])[r], first, axis=0)
                    d_v = pull[:, :rank] + (np.float32(1e-5) - pull[:, rank:]) * vu
                    g = gv[u] + d_v * d_v
                    gv[u] = g
                    v[u] = vu - 0.05 * rate[u, None] * d_v / np.sqrt(g)
                d_w = (pull[:, rank] if pairs else np.add.reduceat(each[r], first)) + np.float32(1e-5) * w[u]
                g = gw[u] + d_w * d_w
                gw[u] = g
                w[u] -= 0.5 * rate[u] * d_w / np.sqrt(g)
                d_b = miss.mean()
                gb += d_b * d_b
                b -= 0.5 * d_b / np.sqrt(gb)
            if not left:
                return w, v, float(b)
            loss = held_loss(w, v, b, pairs)
            if loss < best[0] * (1 - LEAST_FALL):
                best, since = (loss, w.copy(), v.copy(), float(b)), 0
            else:
                since += len(batches)

    order = rng.permutation(len(labels))
    n_held = len(labels) // HELD
    parts = lambda rows: [deal(rows[at : at + 128]) for at in range(0, len(rows), 128)]
    held, batches = parts(order[:n_held]), parts(order[n_held:])
    epochs = max(8, -(-steps // len(batches)))
    own = z * z
    w1, _, b1 = descend(w.copy(), v, start, rates(own), -(-epochs // 4), False)
    p = sigmoid(b1 + np.array([w1[flat[cuts[i] : cuts[i + 1]]].sum(dtype=float) for i in everything]))
    linked = pair_evidence(n, flat, cuts, labels, p, np.flatnonzero(np.abs(z) >= PARTNER_Z * np.sqrt(2 * np.log(max(n, 2)))))
    w, v, b = descend(w, v, start, rates(np.maximum(own, linked)), epochs, True)
    return Machine(place, b, w, v)


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> Machine:
    """Fit on at most about ``sample_rows`` labelled rows, whole texts; null labels and null ids do not count.

    Every hashed term that the sample holds takes part. The driver gets four bytes a row and term of the sample. If an id has several
    labels, the highest counts; if it has several texts, the least of them in the order of strings.
    """
    ship(docs.sparkSession)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_y"))
    total = known.count()
    if total > sample_rows:
        known = known.where(F.pmod(F.xxhash64("_id", F.lit(11)), F.lit(1 << 30)) < int(sample_rows / total * (1 << 30)))
    pairs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(F.broadcast(known), "_id").groupBy("_id").agg(F.min("_t").alias("_t"), F.max("_y").alias("_y"))

    def expand(batches):
        for batch in batches:
            held = [np.array(sorted({t for w in words_of(x) for t in hashed_terms(w)}), dtype="<i4").tobytes() for x in batch.column("_t").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_y"), pa.array(held, pa.binary())], ["y", "terms"])

    rows = pairs.mapInArrow(expand, "y int, terms binary").toArrow()
    y, rows = rows.column("y").to_pylist(), rows.column("terms").to_pylist()
    order = sorted(range(len(y)), key=lambda i: (y[i], rows[i]))
    place = np.full(1 << HASH_BITS, -1, dtype=np.int32)
    for r in rows:
        place[np.frombuffer(r, dtype="<i4")] = 0
    terms = np.flatnonzero(place == 0)
    place[terms] = np.arange(len(terms))
    terms, labels = terms.tolist(), np.array([y[i] for i in order], dtype=float)
    held = [place[np.frombuffer(rows[i], dtype="<i4")] for i in order]
    del rows, y, order, place
    handed = [held]
    del held
    return fit_machine(terms, handed.pop(), labels)


def score_toxicity(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, score, predicted`` and the columns ``also`` of every row; null and empty texts get the score of no term.

    One pass without shuffle; only ``machine`` (bounded by the number of buckets) goes to the executors. Repeated rows and null
    ids each get a row; an empty table gives none.
    """
    ship(docs.sparkSession)
    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), *also)
    types = dict(kept.dtypes)
    names = ["doc_id", *also]
    schema = ", ".join(f"`{n}` {types[n]}" for n in names) + ", score double, predicted int"
    place = np.full(1 << HASH_BITS, -1, dtype=np.int32)
    place[list(machine.terms)] = list(machine.terms.values())
    sent = docs.sparkSession.sparkContext.broadcast((place, Machine({}, machine.bias, machine.weights, machine.factors)))

    def run(batches):
        place, machine = sent.value
        cache: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            scores = []
            for text in batch.column("_text").to_pylist():
                present: set[int] = set()
                for w in words_of(text):
                    held = cache.get(w)
                    if held is None:
                        if len(cache) >= CACHE_WORDS:
                            cache.clear()
                        held = cache[w] = tuple(int(place[t]) for t in hashed_terms(w) if place[t] >= 0)
                    present.update(held)
                scores.append(machine.score(np.sort(np.fromiter(present, dtype=np.int64, count=len(present)))))
            columns = [batch.column(n) for n in names] + [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "score", "predicted"])

    return kept.mapInArrow(run, schema)


def judged_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document; labels of rows whose crc32(doc_id) mod 5 is 0 are never learnt."""
    rows = labels.where(bucket(F.col("doc_id"), 5) != 0)
    return score_toxicity(docs, train_toxicity(docs, rows)).select("doc_id", F.coalesce(bucket(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
