"""Nearest neighbours by a forest of random-projection trees, searched through one priority queue."""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkgrain.llm.shared import ship, written

#: Bound of the sample that the trees are fitted on; every row is indexed.
SAMPLE_ROWS = 20_000
TREES = 24
DEPTH = 8
#: A query visits leaves, nearest border first over all trees, until they hold this share of the rows (a row counts in every tree).
SHARE = 1.0
#: Bound of the rounding error of a cosine taken by a matrix product, in either order of its sums.
MARGIN = 1e-9
#: Most rows of a leaf in one group; larger leaves are dealt out to several groups.
GROUP_ROWS = 4096


@dataclass
class Forest:
    """Complete binary trees of one depth; node k has the children 2k+1 and 2k+2."""

    depth: int
    normals: np.ndarray  # trees x nodes x dimensions
    borders: np.ndarray  # trees x nodes

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """rows x trees: the leaf of each row."""
        out = np.zeros((len(x), len(self.normals)), dtype=np.int64)
        for t, (w, b) in enumerate(zip(self.normals, self.borders)):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", x, w[node]) > b[node]
                node = 2 * node + 1 + side
            out[:, t] = node - (2**self.depth - 1)
        return out

    def search(self, x: np.ndarray, sizes: np.ndarray, rows: float) -> list[tuple[int, int]]:
        """Leaves (tree, leaf) in the order of the nearest border that parts them from the query, until they hold ``rows`` rows."""
        margin = np.einsum("tnd,d->tn", self.normals, x) - self.borders
        inner = 2**self.depth - 1
        queue = [(0.0, t, 0) for t in range(len(self.normals))]
        found, held = [], 0
        while queue and held < rows:
            far, t, node = heapq.heappop(queue)
            while node < inner:
                m = margin[t, node]
                near = 2 * node + 1 + (m > 0)
                heapq.heappush(queue, (max(far, abs(m)), t, 4 * node + 3 - near))
                node = near
            leaf = node - inner
            if sizes[t, leaf]:
                found.append((t, int(leaf)))
                held += sizes[t, leaf]
        return found


def fit_forest(x: np.ndarray, trees: int, depth: int, seed: int = 5) -> Forest:
    """Each node parts its rows of the sample at the median of their projection on the difference of two of them."""
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    normals, borders = rng.normal(size=(trees, 2**depth - 1, d)), np.zeros((trees, 2**depth - 1))
    normals /= np.linalg.norm(normals, axis=2, keepdims=True)
    for t in range(trees):
        held = {0: np.arange(len(x))}
        for node in range(2**depth - 1):
            rows = held.pop(node)
            if len(rows) > 1:
                a, b = x[rng.choice(rows, 2, replace=False)]
                size = np.linalg.norm(a - b)
                if size > 1e-9:
                    normals[t, node] = (a - b) / size
            along = x[rows] @ normals[t, node]
            borders[t, node] = np.median(along) if len(rows) else 0.0
            held[2 * node + 1], held[2 * node + 2] = rows[along <= borders[t, node]], rows[along > borders[t, node]]
    return Forest(depth, normals, borders)


def unpack(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), dtype="<f8").reshape(len(raw), -1) if raw else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def scaled(x: np.ndarray) -> np.ndarray:
    """A vector divided by the power of two that brings its largest part to at least one half and below one."""
    x = x + 0.0  # no negative zeros, which would part equal vectors
    return np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))


def nearest(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query: str = "vec_id % 50 = 0",
    k: int = 5,
    trees: int = TREES,
    depth: int = DEPTH,
    share: float = SHARE,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: of every row that ``query`` names, the ``k`` rows of largest cosine found among all others.

    Rows with equal vectors are one class; a class keeps its k+1 smallest ids, which is all that a result can need, so
    copies meet no query twice. Vectors are divided by a power of two first, which changes no cosine and lets no sum overflow. Classes and
    queries meet in leaves; a leaf with many rows is dealt to several groups. In a group one matrix product ranks, and all that could be
    among the best are scored again by an exact sum. The forest is bounded by trees and depth.

    Null and zero vectors, vectors with null or non-finite parts and null ids take no part. Vectors of another length are a
    space of their own. Repeated rows count once. Ties go to the smaller id; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    v = F.col(vector_col)
    sound = v.isNotNull() & F.col(id_col).isNotNull() & (F.size(v) > 0) & F.forall(v, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf"))) & F.exists(v, lambda a: a != 0)
    rows = vectors.where(F.coalesce(sound, F.lit(False))).select(F.col(id_col).alias("vec_id"), v.cast("array<double>").alias("v"))
    schema = "query_id long, rank int, vec_id long, score double"

    def binary(batches):
        for batch in batches:
            packed = [scaled(np.asarray(x, dtype="<f8")).tobytes() for x in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(packed, pa.binary())], ["vec_id", "v"])

    rows = written(rows.mapInArrow(binary, f"vec_id {dict(rows.dtypes)['vec_id']}, v binary").distinct(), "vectors")
    out = spark.createDataFrame([], schema)
    for r in rows.groupBy(F.length("v").alias("width")).count().orderBy("width").collect():
        out = out.unionByName(_nearest(rows.where(F.length("v") == r["width"]), query, k, trees, depth, share, sample_rows))
    return out


def _nearest(rows: DataFrame, query: str, k: int, trees: int, depth: int, share: float, sample_rows: int) -> DataFrame:
    """``nearest`` among vectors of one length."""
    spark = rows.sparkSession
    first = Window.partitionBy("v").orderBy("vec_id")
    asked = rows.where(query).select("v").distinct().withColumn("asks", F.lit(True))
    few = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    classes = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = classes.join(asked, "v", "left").select("v", "ids", F.coalesce("asks", F.lit(False)).alias("asks"))
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    total = classes.count()

    part = F.pmod(F.xxhash64("v", F.lit(23)), F.lit(1 << 30)) < int(min(1.0, sample_rows / total) * (1 << 30))
    sample = unit(unpack([r["v"] for r in classes.where(part).orderBy("v").select("v").collect()] or [r["v"] for r in classes.limit(1).collect()]))
    depth = max(1, min(depth, int(math.log2(max(2, total / 16)))))
    forest = spark.sparkContext.broadcast(fit_forest(sample, trees, depth))

    def index(batches):
        for batch in batches:
            if batch.num_rows:
                leaves = forest.value.leaves(unit(unpack(batch.column("v").to_pylist())))
                yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(leaves.astype(np.int32).tolist(), pa.list_(pa.int32()))], ["cid", "leaves"])

    codes = written(classes.select("cid", "v").mapInArrow(index, "cid long, leaves array<int>"), "leaves")
    at = codes.select("cid", F.posexplode("leaves").alias("tree", "leaf"))
    counts = np.zeros((trees, 2**depth), dtype=np.int64)
    for r in at.groupBy("tree", "leaf").count().collect():
        counts[r["tree"], r["leaf"]] = r["count"]
    sizes = spark.sparkContext.broadcast(counts)
    wanted = share * total + trees * (k + 1)  # the second part holds k+1 classes at least, as a class counts once a tree

    def search(batches):
        for batch in batches:
            cid, raw, first, tree, leaf, group = [], [], [], [], [], []
            for c, v, i in zip(*(batch.column(n).to_pylist() for n in ("cid", "v", "id"))):
                for t, x in forest.value.search(unit(unpack([v]))[0], sizes.value, wanted):
                    for g in range(-(-int(sizes.value[t, x]) // GROUP_ROWS)):
                        cid.append(c)
                        raw.append(v)
                        first.append(i)
                        tree.append(t)
                        leaf.append(x)
                        group.append(g)
            yield pa.RecordBatch.from_arrays([pa.array(cid, pa.int64()), pa.array(raw, pa.binary()), pa.array(first, pa.int64()), *(pa.array(x, pa.int32()) for x in (tree, leaf, group))], ["cid", "v", "id", "tree", "leaf", "part"])

    place = "cid long, v binary, id long, tree int, leaf int, part int"
    least = F.element_at("ids", 1).cast("long").alias("id")
    queries = classes.where("asks").select("cid", "v", least).repartition("cid").mapInArrow(search, place)

    def deal(batches):
        for batch in batches:
            c = np.asarray(batch.column("cid"))
            groups = -(-sizes.value[np.asarray(batch.column("tree")), np.asarray(batch.column("leaf"))] // GROUP_ROWS)
            part = (c.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % groups
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("cid", "v", "id", "tree", "leaf")), pa.array(part, pa.int32())], ["cid", "v", "id", "tree", "leaf", "part"])

    stored = codes.join(classes.select("cid", "v", least), "cid").select("cid", "v", "id", F.posexplode("leaves").alias("tree", "leaf")).mapInArrow(deal, place)
    top = k + 1

    def meet(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"q": [], "c": [], "score": []})
        a, b = unpack(list(q["v"])), unpack(list(c["v"]))
        same = q["cid"].to_numpy()[:, None] == c["cid"].to_numpy()[None, :]
        rough = np.where(same, -9.0, unit(a) @ unit(b).T)
        # what the rounding of the product could have put below the best is scored as well, so that ties are seen whole
        edge = np.partition(rough, -min(top, rough.shape[1]), axis=1)[:, -min(top, rough.shape[1])]
        qi, ci = np.nonzero((rough >= edge[:, None] - MARGIN) & ~same)
        score = np.empty(len(qi))
        for s in range(0, len(qi), 1 << 16):
            x, y = a[qi[s : s + (1 << 16)]], b[ci[s : s + (1 << 16)]]
            score[s : s + (1 << 16)] = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
        order = np.lexsort((c["id"].to_numpy()[ci], -score, qi))
        ahead = np.searchsorted(qi[order], np.arange(len(a)))
        order = order[np.arange(len(order)) - ahead[qi[order]] < top]
        qi, ci, score = qi[order], ci[order], score[order]
        return pd.DataFrame({"q": q["cid"].to_numpy()[qi], "c": c["cid"].to_numpy()[ci], "score": score})

    keys = ["tree", "leaf", "part"]
    pairs = queries.groupBy(*keys).cogroup(stored.groupBy(*keys)).applyInPandas(meet, "q long, c long, score double")
    pairs = pairs.groupBy("q", "c").agg(F.max("score").alias("score"))
    own = classes.where("asks").select(F.col("cid").alias("q"), F.col("cid").alias("c"), F.lit(1.0).alias("score"))
    named = pairs.join(classes.select(F.col("cid").alias("c"), "ids"), "c")
    ranked = Window.partitionBy("q").orderBy(F.desc("score"), F.element_at("ids", 1))
    best = named.withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= top).select("q", "score", "ids")
    best = best.unionByName(own.join(classes.select(F.col("cid").alias("q"), "ids"), "q").select("q", "score", "ids"))
    best = written(best, "best")
    one = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    best = best.select("q", "score", F.explode("ids").alias("id")).withColumn("n", F.row_number().over(one)).where(F.col("n") <= top)
    best = written(best.groupBy("q").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))).alias("found")), "found")

    members = rows.where(query).join(classes.select("v", "cid"), "v").select(F.col("vec_id").alias("query_id"), F.col("cid").alias("q"))
    out = members.join(best, "q").select("query_id", F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k).alias("found"))
    out = out.select("query_id", F.posexplode("found").alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.s")).alias("score"))
