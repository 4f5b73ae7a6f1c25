"""Near duplicates: consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard similarity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgrain.llm.components import components
from inkgrain.llm.shared import ship, unused, written
from inkgrain.llm.words import mix, runs, signed, text_key, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
#: With 12 bands of 4 samples a pair of similarity 0.8 shares a band with probability 0.998, one of 0.9 almost surely.
BANDS, ROWS = 12, 4
#: Document frequencies are counted over all documents in this many buckets of hashed words.
BUCKET_BITS = 18
#: Keys of candidates are broadcast up to this many bytes, else joined by shuffle.
BROADCAST_BYTES = 32 << 20
TABLE_BITS = 16


class Sampler:
    """Improved consistent weighted sampling. The random numbers of an element are read from tables by a hash of it.

    Sampling sees weights on a grid of 1/16 in their logarithm (verification sees them as they are), so that what an element draws for a
    weight is one look-up: ``draws[level, place]`` = log c - r (t - beta + 1) with t = floor(log w / r + beta).
    """

    GRID, LEVELS = 16, 256

    def __init__(self, samples: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        size = 1 << TABLE_BITS
        self.r, self.beta, self.log_c = rng.gamma(2.0, 1.0, size), rng.random(size), np.log(rng.gamma(2.0, 1.0, size))
        self.odd = rng.integers(0, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.salt = mix(np.arange(1, samples + 1, dtype=np.uint64))
        self.draws = np.zeros((self.LEVELS, size), dtype=np.float32)
        self.drawn = np.zeros(self.LEVELS, dtype=bool)

    def steps(self, level: np.ndarray, place: np.ndarray) -> np.ndarray:
        return np.floor(level / self.GRID / self.r[place] + self.beta[place])

    def sample(self, elements: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 64-bit sample per function. ``elements`` are sorted and distinct; ties go to the first."""
        level = np.clip(np.rint(np.log(weights) * self.GRID), 0, self.LEVELS - 1).astype(np.int64)
        for x in np.unique(level[~self.drawn[level]]):
            every = np.arange(1 << TABLE_BITS)
            self.draws[x] = self.log_c - self.r * (self.steps(x, every) - self.beta + 1)
            self.drawn[x] = True
        k, flat = len(self.odd), self.draws.ravel()
        best = np.full(k, np.inf, dtype=np.float32)
        chosen, row = np.zeros(k, dtype=np.int64), np.arange(k)
        with np.errstate(over="ignore"):
            for at in range(0, len(elements), 2048):
                place = (elements[None, at : at + 2048] * self.odd[:, None]) >> np.uint64(64 - TABLE_BITS)
                place = place.view(np.int64) + (level[None, at : at + 2048] << TABLE_BITS)
                a = flat.take(place)
                least = a.argmin(axis=1)
                value = a[row, least]
                better = value < best
                best[better] = value[better]
                chosen[better] = at + least[better]
            place = ((elements[chosen] * self.odd) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
            t = self.steps(level[chosen], place).astype(np.int64).view(np.uint64)
            return mix(elements[chosen] + mix(t ^ self.salt))


def bands_of(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(ROWS):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + samples.reshape(BANDS, ROWS)[:, j])
    return out


def weighted_shingles(raw: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles and their weights: count times the mean idf of the words. A text of fewer words is one shingle."""
    h = word_hashes(raw)
    if not len(h):
        return h, np.empty(0)
    size = min(SHINGLE, len(h))
    each = idf[(h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
    total = np.concatenate([[0.0], np.cumsum(each)])
    mean = (total[size:] - total[:-size]) / size
    found, first, count = np.unique(runs(h, size), return_index=True, return_counts=True)
    # a shingle's weight must not depend on rounding of running sums, so it is kept to few digits
    return found, count * np.round(mean[first], 4)


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of smaller weights by sum of larger ones."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    total = a[1].sum() + b[1].sum() - shared
    return float(shared / total) if total else 0.0


def word_idf(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Smoothed idf by bucket of hashed words, over all documents. The result is bounded by the number of buckets."""
    ship(docs.sparkSession)
    size = 1 << BUCKET_BITS

    def count(batches):
        sums, n = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column("_text").to_pylist():
                n += 1
                if text:
                    sums[np.unique((word_hashes(text.encode()) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))] += 1
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(sums[at], n), pa.int64())], ["bucket", "n"])

    rows = docs.select(F.col(text_col).alias("_text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = rows.toArrow()
    bucket, n = got["bucket"].to_numpy(), got["n"].to_numpy()
    df = np.zeros(size)
    df[bucket[bucket >= 0]] = n[bucket >= 0]
    total = float(n[bucket < 0].sum())
    return np.log((1 + total) / (1 + df)) + 1


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size, kept, text_hash``.

    Documents are linked if they share a band and the weighted Jaccard similarity of their shingles is at least ``similarity``; a class is
    what links connect, named by its smallest doc_id, whose (first) row has ``kept``. ``text_hash`` is xxhash64 of the text.

    Equal word sequences are one node from the start. In each bucket of a band, every node is verified against the bucket's
    middle one. Only buckets whose nodes are not connected then are looked at again: there every pair of nodes from different components is
    verified too, unless the weights that the two could share rule the similarity out. So no link that could change a class is left
    out, and a bucket of one class costs one comparison a node, whatever its size. Only texts of candidates are fetched, by key.

    Documents without words (null, empty or blank) are classes of their own. Rows that repeat an id are rows of their own. Null ids count as
    larger than any other. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    idf = spark.sparkContext.broadcast(word_idf(docs, text_col))
    kept = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_hash"), F.col(text_col).alias("_text"))
    id_type = dict(kept.dtypes)["doc_id"]

    def sign(batches):
        sampler = Sampler(BANDS * ROWS)
        for batch in batches:
            keys, totals, bands = [], [], []
            for text in batch.column("_text").to_pylist():
                raw = text.encode() if text else b""
                found, weights = weighted_shingles(raw, idf.value)
                keys.append(text_key(raw) if len(found) else None)
                totals.append(float(weights.sum()))
                bands.append(signed(bands_of(sampler.sample(found, weights))) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(keys, pa.binary()), pa.array(totals, pa.float64()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "key", "total", "bands"],
            )

    signed_docs = kept.mapInArrow(sign, f"doc_id {id_type}, text_hash long, key binary, total double, bands array<long>")
    signed_docs = written(signed_docs.withColumn("rid", F.monotonically_increasing_id()), "signatures")
    nodes = signed_docs.where(F.col("key").isNotNull()).groupBy("key").agg(F.first("total").alias("total"), F.first("bands").alias("bands"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    member = nodes.select("node", F.posexplode("bands").alias("band", "value"))
    shared = written(member.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    member = written(member.join(shared, ["band", "value"]), "members")
    # the node that meets most others in its buckets is likely to be near to most of them
    met = written(member.groupBy("node").agg(F.sum("n").alias("met")), "met")
    member = member.join(met, "node").select("node", "band", "value", "met")
    middle = member.groupBy("band", "value").agg(F.max(F.struct("met", (-F.col("node")).alias("neg")))["neg"].alias("neg"))
    middle = written(middle.select("band", "value", (-F.col("neg")).alias("middle")), "middles")
    member = written(member.drop("met").join(middle, ["band", "value"]), "members")
    star = member.where("node != middle").select(F.least("node", "middle").alias("a"), F.greatest("node", "middle").alias("b"))
    star = written(star.distinct(), "star")

    def wanted(ids):
        ids = written(nodes.join(ids.distinct(), "node").select("node", "key"), "wanted")
        return fetch(docs, ids, text_col, broadcast_bytes)

    ends = star.select(F.col("a").alias("node")).unionByName(star.select(F.col("b").alias("node")))
    texts = wanted(ends)
    links = written(verify(star, texts, idf, similarity), "links")
    at = unsettled(member, links, nodes)
    more = unjoined(open_nodes(at, texts, idf, similarity), star, nodes, similarity)
    links = links.unionByName(written(verify(more, texts, idf, similarity), "links"))

    labels = written(components(links), "labels")
    node_rows = signed_docs.join(nodes.select("key", "node"), "key", "left").select("doc_id", "text_hash", "rid", "node")
    node_rows = node_rows.join(labels, "node", "left").select("doc_id", "text_hash", "rid", F.coalesce("component", "node", -1 - F.col("rid")).alias("component"))
    node_rows = written(node_rows, "rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")).alias("first")
    classes = written(node_rows.groupBy("component").agg(first, F.count(F.lit(1)).alias("class_size")), "classes")
    return node_rows.join(classes, "component").select(
        "doc_id", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("rid") == F.col("first.rid")).alias("kept"), "text_hash"
    )


def unsettled(member: DataFrame, links: DataFrame, nodes: DataFrame) -> DataFrame:
    """``band, value, node, component, total`` of the buckets whose nodes lie in several components."""
    labels = written(components(links), "labels")
    at = member.join(labels, "node", "left").select("band", "value", "node", F.coalesce("component", "node").alias("component"))
    at = several(written(at, "at"))
    return written(at.join(nodes.select("node", "total"), "node"), "unsettled")


def several(at: DataFrame) -> DataFrame:
    mixed = at.groupBy("band", "value").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("band", "value")
    return at.join(mixed, ["band", "value"])


def open_nodes(at: DataFrame, texts: DataFrame, idf, similarity: float) -> DataFrame:
    """The rows of ``at`` that may still link, with ``most``: the weight that a node can share with any other.

    A shingle that no other node of ``at`` has is shared with none. The similarity of a node is therefore at most its other weight by its total; below
    ``similarity`` it is settled. In a large group of edited copies this settles all copies with many edits of their own, without a pair.
    """

    def expand(batches):
        for batch in batches:
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
                found, weights = weighted_shingles(text, idf.value)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), node)), pa.array(signed(found)), pa.array(weights)], ["node", "shingle", "weight"])

    nodes = at.select("node", "total").distinct()
    each = written(texts.join(nodes, "node").select("node", "text").mapInArrow(expand, "node long, shingle long, weight double"), "shingles")
    for _ in range(2):  # a settled node shares with none, so what only it and one other had is then the other's own
        own = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"), F.min("weight").alias("weight")).where("n = 1")
        own = own.groupBy("node").agg(F.sum("weight").alias("own"))
        most = (F.col("total") - F.coalesce("own", F.lit(0.0))) * 1.0001
        left = nodes.join(own, "node", "left").withColumn("most", most).where(F.col("most") >= F.col("total") * similarity)
        left = written(left.select("node", "total", "most"), "left")
        nodes, each = left.select("node", "total"), each.join(left.select("node"), "node")
    return several(at.join(left.select("node", "most"), "node"))


def unjoined(at: DataFrame, star: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Pairs that share a bucket, lie in different components, are not in ``star``, and whose shareable weights allow the similarity.

    Nodes meet components first (of a component of one node all is known), and then the nodes of those that may hold a partner. A
    pair counts in the first band that it shares only.
    """
    at = written(at.join(nodes.select("node", "bands"), "node"), "at")
    parts = at.groupBy("band", "value", F.col("component").alias("other")).agg(
        F.min("total").alias("low"), F.max("most").alias("high"), F.min("node").alias("b"), F.count(F.lit(1)).alias("n"), F.min("bands").alias("bands_b")
    )
    parts = written(parts, "parts")

    def first_band(x, y):
        return F.array_position(F.zip_with(x, y, lambda p, q: p == q), True) == F.col("band") + 1

    def may(most, total):
        """Whether a node can be as similar to one that shares at most ``most`` and weighs ``total`` at least."""
        both = F.least("most", most)
        return both >= similarity * (F.col("total") + total - both)

    alone = F.col("n") == 1
    meet = (F.col("component") != F.col("other")) & may(F.col("high"), F.col("low")) & (~alone | ((F.col("node") < F.col("b")) & first_band(F.col("bands"), F.col("bands_b"))))
    same = ["band", "value"]
    left = at.select(*same, "node", "component", "total", "most", "bands")
    asks = join_on(left, parts, same, meet)
    single = asks.where("n = 1").select(F.col("node").alias("a"), "b")
    asks = asks.where("n > 1").select(*same, "other", "node", "total", "most", "bands")
    other = at.select(*same, F.col("component").alias("other"), F.col("node").alias("b"), F.col("total").alias("tb"), F.col("most").alias("mb"), F.col("bands").alias("bands_b"))
    # a component of one node has met this one from its own side only if it has the smaller id, so both orders count here
    fits = may(F.col("mb"), F.col("tb")) & first_band(F.col("bands"), F.col("bands_b"))
    several_ = join_on(asks, other, [*same, "other"], fits).select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))
    pairs = single.unionByName(several_).distinct()
    return written(pairs.join(star, ["a", "b"], "left_anti"), "pairs")


def join_on(left: DataFrame, right: DataFrame, keys: list[str], condition) -> DataFrame:
    """Inner join on ``keys`` and a condition, evaluated inside the join. Other columns must differ in name."""
    renamed = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"_{k}"))
    return left.join(renamed, condition).drop(*[f"_{k}" for k in keys])


def fetch(docs: DataFrame, wanted: DataFrame, text_col: str, broadcast_bytes: int) -> DataFrame:
    """``node, text`` for the keys in ``wanted``."""

    def key(batches):
        for batch in batches:
            raws = [t.encode() if t else b"" for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([text_key(r) for r in raws], pa.binary()), pa.array(raws, pa.binary())], ["key", "text"])

    keyed = docs.select(F.col(text_col).alias("_text")).mapInArrow(key, "key binary, text binary")
    small = wanted.count() * 64 <= broadcast_bytes
    found = keyed.join(F.broadcast(wanted) if small else wanted, "key")
    return written(found.groupBy("node").agg(F.first("text").alias("text")), "texts", "lz4")


def verify(pairs: DataFrame, texts: DataFrame, idf, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose weighted Jaccard similarity is at least ``similarity``."""

    def check(batches):
        last, held = None, None
        for batch in batches:
            right = []
            for a, x, y in zip(batch.column("a").to_pylist(), batch.column("ta").to_pylist(), batch.column("tb").to_pylist()):
                if a != last:
                    last, held = a, weighted_shingles(x, idf.value)
                right.append(jaccard(held, weighted_shingles(y, idf.value)) >= similarity)
            mask = pa.array(right, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    return both.select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long")


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class, with all columns. Rows equal in id and text stay together, so drop exact copies before."""
    judged = near_groups(docs, id_col, text_col)
    name, hashed = unused(docs, "_id"), unused(docs, "_hash")
    gone = judged.where("NOT kept").select(F.col("doc_id").alias(name), F.col("text_hash").alias(hashed))
    same = F.col(id_col).eqNullSafe(F.col(name)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(hashed))
    return docs.join(gone, same, "left_anti")
