"""Softmax gradient boosting on Spark's regression trees, with regularised leaf values and a bound on leaves.

One round: softmax of the carried scores gives gradients and Hessians; a regression tree per class is fitted to the Newton steps; one grouped sum
per (class, leaf) gives each leaf its value ``-T(G) / (H + l2)``, where ``T`` moves G towards zero by ``l1``; the tree is cut back
to its best splits; the scores move on. All that reaches the driver is the trees.
"""

from __future__ import annotations

import heapq
import random
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from inkgrain.operators.classifiers import _Classifier, _FittedClassifier
from inkgrain.operators.params import TableModel
from inkgrain.operators.store import write_table

#: Hessians are not taken below this share of a row's weight.
LEAST_HESSIAN = 1e-6
#: The scores are written, and their lineage ends, after this many rounds.
CUT_EVERY = 8
#: Parts of a bag's hash range.
BAG_PARTS = 1 << 30

TREE_SCHEMA = "round int, class int, node int, feature int, threshold double, `left` int, `right` int, value double"


# --- expressions


def softmax(scores: Column) -> Column:
    """Array of probabilities from an array of scores."""
    top = F.array_max(scores)
    raised = F.transform(scores, lambda s: F.exp(s - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def gradients(scores: Column, y: Column, weight: Column) -> Column:
    """Per class the struct ``(g, h)`` of the weighted log loss; ``y`` is a position from 0."""

    def one(p, k):
        return F.struct(
            (weight * (p - F.when(k == y, 1.0).otherwise(0.0))).alias("g"),
            (weight * F.greatest(p * (1.0 - p), F.lit(LEAST_HESSIAN))).alias("h"),
        )

    return F.transform(softmax(scores), one)


def soft_threshold(g: Column, l1: float) -> Column:
    """``g`` moved towards zero by ``l1``."""
    return F.signum(g) * F.greatest(F.abs(g) - F.lit(float(l1)), F.lit(0.0))


def leaf_value(g: Column, h: Column, l1: float, l2: float) -> Column:
    return F.when(h + l2 > 0, -soft_threshold(g, l1) / (h + F.lit(float(l2)))).otherwise(0.0)


def leaf_table(rows: DataFrame, keys: list[str], l1: float, l2: float) -> DataFrame:
    """Newton values of leaves: ``keys, g, h, n, value`` from rows with ``keys, g, h``. Sums combine on the map side."""
    sums = rows.groupBy(*keys).agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n"))
    return sums.withColumn("value", leaf_value(F.col("g"), F.col("h"), l1, l2))


def in_bag(id_col: Column, share: float, seed: int, draw: int) -> Column:
    """Whether a row belongs to bag ``draw``: depends on id, seed and draw alone, not on partitions."""
    return F.pmod(F.xxhash64(id_col, F.lit(seed), F.lit(draw)), F.lit(BAG_PARTS)) < int(share * BAG_PARTS)


# --- trees on the driver


@dataclass
class Node:
    """A node of a fitted tree, with the sums of its rows. ``leaf`` is the position of a leaf from left to right."""

    feature: int = -1
    threshold: float = 0.0
    left: "Node | None" = None
    right: "Node | None" = None
    leaf: int = -1
    g: float = 0.0
    h: float = 0.0


def fitted_nodes(model, features: list[int]) -> Node:
    """The nodes of a Spark tree; ``features`` names the columns that the tree was given."""
    count = iter(range(1 << 30))

    def walk(node) -> Node:
        if "Internal" not in node.getClass().getSimpleName():
            return Node(leaf=next(count))
        split = node.split()
        left = walk(node.leftChild())
        return Node(features[split.featureIndex()], split.threshold(), left, walk(node.rightChild()))

    return walk(model._java_obj.rootNode())


def leaf_of(node: Node, values: Column) -> Column:
    """The leaf that a row with these feature values reaches."""
    if node.left is None:
        return F.lit(node.leaf)
    return F.when(F.get(values, F.lit(node.feature)) <= F.lit(float(node.threshold)), leaf_of(node.left, values)).otherwise(leaf_of(node.right, values))


def with_sums(node: Node, sums: dict[int, tuple[float, float]]) -> Node:
    """Fill in the sums of all nodes from those of the leaves."""
    if node.left is None:
        node.g, node.h = sums.get(node.leaf, (0.0, 0.0))
    else:
        with_sums(node.left, sums)
        with_sums(node.right, sums)
        node.g, node.h = node.left.g + node.right.g, node.left.h + node.right.h
    return node


def _objective(node: Node, l1: float, l2: float) -> float:
    g = max(abs(node.g) - l1, 0.0)
    return g * g / (node.h + l2) if node.h + l2 > 0 else 0.0


def split_gain(node: Node, l1: float, l2: float) -> float:
    """By how much the split of this node lowers the (doubled) regularised loss."""
    return _objective(node.left, l1, l2) + _objective(node.right, l1, l2) - _objective(node, l1, l2)


def best_first(root: Node, num_leaves: int, l1: float, l2: float, min_gain: float) -> set[int]:
    """Python ids of the nodes that stay split: the leaf whose split gains most is split next, while leaves are fewer than
    ``num_leaves`` and the gain exceeds ``min_gain``; of equal gains the node that was reached first."""
    kept, frontier, order = set(), [], iter(range(1 << 30))

    def offer(node):
        if node.left is not None:
            gain = split_gain(node, l1, l2)
            if gain > min_gain:
                heapq.heappush(frontier, (-gain, next(order), node))

    offer(root)
    leaves = 1
    while frontier and leaves < num_leaves:
        node = heapq.heappop(frontier)[2]
        kept.add(id(node))
        leaves += 1
        offer(node.left)
        offer(node.right)
    return kept


def node_rows(root: Node, kept: set[int], l1: float, l2: float, rate: float) -> list[tuple]:
    """``(node, feature, threshold, left, right, value)`` of the tree cut back to the kept splits; leaves have feature -1."""
    out = []

    def walk(node) -> int:
        at = len(out)
        out.append(None)
        if id(node) in kept:
            left = walk(node.left)
            right = walk(node.right)
            out[at] = (at, node.feature, float(node.threshold), left, right, 0.0)
        else:
            shrunk = max(abs(node.g) - l1, 0.0) * (1 if node.g > 0 else -1)
            value = -rate * shrunk / (node.h + l2) if node.h + l2 > 0 else 0.0
            out[at] = (at, -1, 0.0, -1, -1, value)
        return at

    walk(root)
    return out


def leaf_values(root: Node, rows: list[tuple]) -> list[float]:
    """The value that each leaf of the uncut tree gets from the cut one."""
    out = []

    def walk(node, at):
        _, feature, _, left, right, value = rows[at]
        if node.left is None:
            out.append(value)
        elif feature < 0:
            walk(node.left, at)
            walk(node.right, at)
        else:
            walk(node.left, left)
            walk(node.right, right)

    walk(root, 0)
    return out


# --- the estimator


class SoftmaxTrees(_Classifier):
    """Multinomial boosting: in every round one tree per class on the gradients of one joint log loss.

    ``settings``: ``rounds, rate, depth, num_leaves, min_rows`` (rows of a leaf), ``min_hessian`` (sum of Hessians of a leaf), ``min_gain`` (in
    summed loss), ``l1, l2, columns`` (share of columns a tree sees), ``bag`` (share of rows), ``bag_every`` (rounds until the next draw; 0: no
    bags), ``bins, seed``. The trees of a round are fitted side by side. Scores are a column of the training rows; the rows of a
    round are cached, and written every few rounds.
    """

    def _train(self, rows, labels, counts):
        s = {**SETTINGS, **self.settings}
        k = len(labels)
        width = rows.select(F.size(vector_to_array("x")).alias("n")).first()["n"]
        weights = {r["y"]: r["w"] for r in rows.groupBy("y").agg(F.sum("w").alias("w")).collect()}
        total = sum(weights.values())
        start = [float(np.log(weights[float(c)] / total)) for c in range(k)]
        now = rows.withColumn("s", F.array(*[F.lit(v) for v in start]))
        bagged = F.lit(True)
        trees, losses, held = [], [], None
        for number in range(s["rounds"]):
            if number and number % CUT_EVERY == 0:
                now = write_table(now, "scores")
            if s["bag_every"] and s["bag"] < 1:
                bagged = in_bag(F.col("id"), s["bag"], s["seed"], number // s["bag_every"])
            now = now.withColumn("gh", gradients(F.col("s"), F.col("y"), F.col("w"))).withColumn("bagged", bagged).persist(StorageLevel.MEMORY_AND_DISK)
            chance = F.element_at(softmax(F.col("s")), F.col("y").cast("int") + 1)
            in_class = [F.sum(F.when(F.col("bagged"), F.col("gh")[c]["h"])) for c in range(k)]
            loss, n_bag, *hessians = now.agg(F.sum(-F.col("w") * F.log(chance)) / total, F.count_if("bagged"), *in_class).first()
            losses.append(loss)
            if held is not None:
                held.unpersist()
            held, bag = now, now.where("bagged")
            if not n_bag:
                break
            picks = [self._columns(width, s, number, c) for c in range(k)]
            fit = lambda c: self._tree(bag, c, picks[c], hessians[c], s)
            with ThreadPoolExecutor(max(1, self.parallelism)) as pool:
                models = list(pool.map(fit, range(k)))
            roots = [fitted_nodes(m, p) for m, p in zip(models, picks)]
            reached = F.array(*[leaf_of(root, F.col("v")) for root in roots])
            now = now.withColumn("v", vector_to_array("x")).withColumn("leaves", reached)
            placed = now.where("bagged").select(F.posexplode("leaves").alias("class", "leaf"), "gh")
            placed = placed.select("class", "leaf", F.element_at("gh", F.col("class") + 1).alias("e")).select("class", "leaf", "e.g", "e.h")
            sums = [{} for _ in range(k)]
            for r in leaf_table(placed, ["class", "leaf"], s["l1"], s["l2"]).collect():
                sums[r["class"]][r["leaf"]] = (r["g"], r["h"])
            values = []
            for c, root in enumerate(roots):
                with_sums(root, sums[c])
                cut = node_rows(root, best_first(root, s["num_leaves"], s["l1"], s["l2"], s["min_gain"]), s["l1"], s["l2"], s["rate"])
                trees += [(number, c, *row) for row in cut]
                values.append(leaf_values(root, cut))
            steps = [F.element_at(F.array(*[F.lit(v) for v in values[c]]), F.col("leaves")[c] + 1) for c in range(k)]
            moved = F.array(*[F.col("s")[c] + steps[c] for c in range(k)])
            now = now.select("id", "y", "w", "x", moved.alias("s"))
        if held is not None:
            held.unpersist()
        table = write_table(rows.sparkSession.createDataFrame(trees, TREE_SCHEMA).coalesce(1), "trees")
        return SoftmaxTreesModel(labels=labels, start=start, losses=losses, trees=table)

    @staticmethod
    def _columns(width: int, s: dict, number: int, c: int) -> list[int]:
        n = max(1, round(width * s["columns"]))
        return sorted(random.Random(f"{s['seed']}-{number}-{c}").sample(range(width), n)) if n < width else list(range(width))

    @staticmethod
    def _tree(bag: DataFrame, c: int, pick: list[int], hessian: float, s: dict):
        e = F.col("gh")[c]
        rows = bag.select("x", (-e["g"] / e["h"]).alias("step"), e["h"].alias("h"))
        rows = VectorSlicer(inputCol="x", outputCol="slice", indices=pick).transform(rows).select("slice", "step", "h")
        share = s["min_hessian"] / hessian if hessian else 0.0
        depth = s["depth"] if share < 0.5 else 0  # no split leaves enough on both sides
        return DecisionTreeRegressor(
            featuresCol="slice", labelCol="step", weightCol="h", maxDepth=depth, minInstancesPerNode=s["min_rows"],
            minWeightFractionPerNode=min(share, 0.499), maxBins=s["bins"], seed=s["seed"], minInfoGain=0.0,
        ).fit(rows)


#: Settings that apply unless others are given.
SETTINGS = {
    "rounds": 100, "rate": 0.1, "depth": 4, "num_leaves": 1 << 30, "min_rows": 1, "min_hessian": 0.0, "min_gain": 0.0, "l1": 0.0, "l2": 0.0,
    "columns": 1.0, "bag": 1.0, "bag_every": 1, "bins": 64, "seed": 42,
}


class SoftmaxTreesModel(TableModel, _FittedClassifier):
    """The trees as a table, ``round, class, node, feature, threshold, left, right, value``; values carry the learning rate."""

    _field_names = ("labels", "start", "losses")
    _table_names = ("trees",)

    def __init__(self, labels, start, losses, trees):
        super().__init__(labels, [])
        self.start, self.losses, self.trees = list(start), list(losses), trees

    def _probabilities(self, rows: DataFrame, features: str, out: str) -> DataFrame:
        return rows.withColumn(out, self._chances(rows, features))

    def _chances(self, rows: DataFrame, features: str) -> Column:
        """Array of class probabilities. The trees are sent to the tasks (their size does not depend on the rows), which get only the
        columns that some tree asks for."""
        nodes = self.trees.orderBy("round", "class", "node").toPandas()
        used = sorted(set(nodes["feature"]) - {-1})
        start, k = np.array(self.start), len(self.labels)
        place = {f: i for i, f in enumerate(used)}
        grouped = [
            (int(c), *(t[n].to_numpy() for n in ("threshold", "left", "right", "value")), np.array([place.get(f, -1) for f in t["feature"]]))
            for (_, c), t in nodes.groupby(["round", "class"], sort=True)
        ]
        sent = rows.sparkSession.sparkContext.broadcast(grouped)

        def score(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for cells in columns:
                x = np.stack(cells.to_numpy()) if len(cells) else np.zeros((0, 1))
                total = np.tile(start, (len(x), 1))
                for c, threshold, left, right, value, feature in sent.value:
                    at = np.zeros(len(x), dtype=np.int64)
                    while True:
                        f = feature[at]
                        inner = np.flatnonzero(f >= 0)
                        if not len(inner):
                            break
                        here = at[inner]
                        at[inner] = np.where(x[inner, f[inner]] <= threshold[here], left[here], right[here])
                    total[:, c] += value[at]
                raised = np.exp(total - total.max(axis=1, keepdims=True))
                yield pd.Series(list(raised / raised.sum(axis=1, keepdims=True)))

        dense = vector_to_array(features)
        asked = F.transform(F.array(*[F.lit(int(f)) for f in used or [0]]), lambda i: F.get(dense, i))
        return F.pandas_udf(score, "array<double>")(asked)
