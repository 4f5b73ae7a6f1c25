"""Softmax boosting against a run without Spark, and its parts against closed forms."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from inkgrain.operators import boosting
from inkgrain.operators.boosting import Node, SoftmaxTrees, SoftmaxTreesModel, best_first, in_bag, leaf_table, leaf_values, node_rows, split_gain, with_sums
from inkgrain.operators.store import new_path, write_table
from inkgrain.plans.registry import PIPELINE_GBT, make_classifier
from inkgrain.plans.search import SPACES, draw

LABELS = [3, 7, 20]


def drawn(n=500, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 20, (n, 4)).astype(float)
    y = (x[:, 0] > 9).astype(int) + (x[:, 1] + x[:, 2] > 22)
    return x, np.where(rng.random(n) < 0.1, rng.integers(0, 3, n), y)


@pytest.fixture(scope="module")
def points(spark):
    x, y = drawn()
    rows = [(i, [float(v) for v in x[i]], LABELS[y[i]]) for i in range(len(x))]
    df = spark.createDataFrame(rows, "id long, v array<double>, LABEL int")
    return write_table(df.select("id", "LABEL", array_to_vector("v").alias("features")), "points")


def plain_tree(x, z, h, depth, min_rows, least):
    """The split with the largest fall of the weighted variance, among midpoints of neighbouring values; the first of equals."""
    best, best_gain = None, 1e-12
    if depth:
        spread = lambda m: (h[m] * z[m] ** 2).sum() - (h[m] * z[m]).sum() ** 2 / h[m].sum()
        everything = np.ones(len(z), dtype=bool)
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for t in (values[1:] + values[:-1]) / 2:
                left = x[:, f] <= t
                if min(left.sum(), (~left).sum()) < min_rows or min(h[left].sum(), h[~left].sum()) < least:
                    continue
                gain = spread(everything) - spread(left) - spread(~left)
                if gain > best_gain * (1 + 1e-9):
                    best, best_gain = (f, t), gain
    if best is None:
        return None
    left = x[:, best[0]] <= best[1]
    return best, plain_tree(x[left], z[left], h[left], depth - 1, min_rows, least), plain_tree(x[~left], z[~left], h[~left], depth - 1, min_rows, least)


def plain_boost(x, y, w, bags, s):
    """Scores of all rows and the loss of every round."""
    k = 3
    scores = np.tile(np.log([w[y == c].sum() / w.sum() for c in range(k)]), (len(x), 1))
    losses = []
    for bag in bags:
        p = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
        losses.append(-(w * np.log(p[np.arange(len(x)), y])).sum() / w.sum())
        moved = scores.copy()
        for c in range(k):
            g, h = w * (p[:, c] - (y == c)), w * np.maximum(p[:, c] * (1 - p[:, c]), 1e-6)
            tree = plain_tree(x[bag], (-g / h)[bag], h[bag], s["depth"], s["min_rows"], s["min_hessian"])

            def part(m):
                q = max(abs(g[m & bag].sum()) - s["l1"], 0)
                return q * q / (h[m & bag].sum() + s["l2"])

            def value(m):
                q = g[m & bag].sum()
                return -s["rate"] * math.copysign(max(abs(q) - s["l1"], 0), q) / (h[m & bag].sum() + s["l2"])

            leaves = [(np.ones(len(x), dtype=bool), tree)]
            while len(leaves) < s["num_leaves"]:
                gains = []
                for m, t in leaves:
                    if t is None:
                        gains.append(-1.0)
                        continue
                    left = m & (x[:, t[0][0]] <= t[0][1])
                    gains.append(part(left) + part(m & ~left) - part(m))
                at = int(np.argmax(gains))
                if gains[at] <= s["min_gain"]:
                    break
                m, t = leaves[at]
                left = m & (x[:, t[0][0]] <= t[0][1])
                leaves[at : at + 1] = [(left, t[1]), (m & ~left, t[2])]
            for m, _ in leaves:
                moved[m, c] += value(m)
        scores = moved
    return np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True), losses


@pytest.mark.parametrize(
    "settings,balanced,cut",
    [
        ({"depth": 3, "min_rows": 5}, False, 8),
        ({"depth": 3, "l1": 0.5, "l2": 3.0, "num_leaves": 5, "min_gain": 0.2}, True, 2),
        ({"depth": 2, "l2": 1.0, "min_hessian": 6.0, "bag": 0.7, "bag_every": 2}, True, 8),
    ],
)
def test_probabilities_match_a_run_without_spark(points, settings, balanced, cut, monkeypatch):
    monkeypatch.setattr(boosting, "CUT_EVERY", cut)
    s = {**boosting.SETTINGS, "rounds": 4, "rate": 0.3, **settings}
    x, y = drawn()
    w = np.array([len(x) / (3 * (y == c).sum()) for c in range(3)])[y] if balanced else np.ones(len(x))
    bags = []
    for number in range(4):
        member = np.ones(len(x), dtype=bool)
        if s["bag"] < 1:
            member[:] = False
            member[[r["id"] for r in points.where(in_bag(F.col("id"), s["bag"], s["seed"], number // s["bag_every"])).collect()]] = True
        bags.append(member)
    want, losses = plain_boost(x, y, w, bags, s)
    model = SoftmaxTrees(s, balanced=balanced).fit(points)
    got = np.array([r["probability"] for r in model.transform(points).orderBy("id").collect()])
    assert np.abs(got - want).max() < 1e-6
    assert model.losses == pytest.approx(losses, abs=1e-9)
    assert all(a > b for a, b in zip(losses, losses[1:]))
    sizes = {r["n"] for r in model.trees.where("feature = -1").groupBy("round", "class").agg(F.count("*").alias("n")).collect()}
    assert max(sizes) <= s["num_leaves"]


def test_bags_follow_rate_and_draw(spark):
    ids = spark.range(20_000)
    share = lambda draw: {r["id"] for r in ids.where(in_bag(F.col("id"), 0.7, 42, draw)).collect()}
    first, again, other = share(0), share(0), share(1)
    assert first == again and abs(len(first) - 14_000) < 400 and abs(len(first & other) - 9_800) < 400


def test_scores_are_cut(points, monkeypatch):
    written = []
    monkeypatch.setattr(boosting, "CUT_EVERY", 1)
    monkeypatch.setattr(boosting, "write_table", lambda df, name: written.append(name) or write_table(df, name))
    model = SoftmaxTrees({"rounds": 3, "depth": 1}).fit(points)
    assert written == ["scores", "scores", "trees"]
    path = new_path(points.sparkSession, "model")
    model.save(path)
    again = SoftmaxTreesModel.load(path)
    assert again.labels == LABELS and again.losses == model.losses
    want = [r["probability"] for r in model.transform(points).orderBy("id").collect()]
    assert [r["probability"] for r in again.transform(points).orderBy("id").collect()] == want


def test_leaf_values_have_the_closed_form(spark):
    rows = [(0, 0, 3.0, 1.0), (0, 0, 1.0, 0.5), (0, 1, -0.2, 1.0), (1, 0, -5.0, 0.0), (1, 2, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "class int, leaf int, g double, h double")
    got = {(r["class"], r["leaf"]): r["value"] for r in leaf_table(df, ["class", "leaf"], 0.5, 2.0).collect()}
    assert got == {(0, 0): pytest.approx(-3.5 / 3.5), (0, 1): 0.0, (1, 0): pytest.approx(4.5 / 2), (1, 2): 0.0}
    bare = {(r["class"], r["leaf"]): r["value"] for r in leaf_table(df, ["class", "leaf"], 0.0, 0.0).collect()}
    assert bare[1, 2] == 0.0 and bare[0, 0] == pytest.approx(-4 / 1.5)


def full_tree(rng, depth, leaf=itertools.count):
    count = leaf()

    def make(d):
        return Node(leaf=next(count)) if d == 0 else Node(rng.randrange(4), rng.random(), make(d - 1), make(d - 1))

    return make(depth)


def test_best_first_equals_enumeration():
    """Of all ways to cut a depth-3 tree to L leaves, the one that is reached by always splitting the leaf with the largest gain."""
    rng = random.Random(3)
    for _ in range(60):
        root = with_sums(full_tree(rng, 3), {i: (rng.gauss(0, 4), rng.random() * 5) for i in range(8)})
        l1, l2, least = rng.choice([0, 0.7]), rng.choice([0.1, 2]), rng.choice([0.0, 1.5])
        inner, stack = [], [root]
        while stack:
            node = stack.pop()
            if node.left:
                inner.append(node)
                stack += [node.left, node.right]
        gain = {id(n): split_gain(n, l1, l2) for n in inner}
        parent = {id(c): n for n in inner for c in (n.left, n.right)}
        for leaves in range(1, 9):
            kept = best_first(root, leaves, l1, l2, least)
            legal = []
            for size in range(len(inner) + 1):
                for chosen in itertools.permutations(inner, size) if size <= 2 else [p for c in itertools.combinations(inner, size) for p in [sorted(c, key=lambda n: -min_path(n, parent, gain))]]:
                    ids = {id(n) for n in chosen}
                    if all(n is root or id(parent[id(n)]) in ids for n in chosen):
                        legal.append(ids)
            assert kept in legal and len(kept) < max(leaves, 1)
            frontier = [n for n in inner if id(n) not in kept and (n is root or id(parent[id(n)]) in kept)]
            open_gains = [gain[id(n)] for n in frontier]
            if len(kept) + 1 < leaves:
                assert all(g <= least for g in open_gains)
            for n in inner:  # a kept split has a path whose weakest gain beats whatever stayed open above or beside it
                if id(n) in kept:
                    assert all(min_path(n, parent, gain) >= min_path(f, parent, gain) or min_path(n, parent, gain) > g for f, g in zip(frontier, open_gains))
            cut = node_rows(root, kept, l1, l2, 0.5)
            assert sum(r[1] < 0 for r in cut) == len(kept) + 1
            spread = leaf_values(root, cut)
            assert len(spread) == 8 and set(spread) == {r[5] for r in cut if r[1] < 0}


def min_path(node, parent, gain):
    out = gain[id(node)]
    while id(node) in parent:
        node = parent[id(node)]
        out = min(out, gain[id(node)])
    return out


def test_settings_of_the_presets_are_accepted():
    stage = make_classifier("lgbm", PIPELINE_GBT)
    assert isinstance(stage, SoftmaxTrees) and stage.balanced
    assert stage.settings["l1"] == 0.1 and stage.settings["l2"] == 2.0 and stage.settings["num_leaves"] == 63 and stage.settings["bag_every"] == 5
    assert make_classifier("xgboost", {"objective": "multi:softprob", "reg_alpha": 2}).settings["l1"] == 2
    rng = random.Random(1)
    for name in ("gbt", "gbt_plain"):
        assert {"reg_alpha", "reg_lambda"} <= set(SPACES[name])
        make_classifier(name, draw(SPACES[name], rng))
    with pytest.raises(ValueError, match="objective"):
        make_classifier("gbt", {"objective": "regression"})


def test_trees_without_a_split(spark):
    df = spark.createDataFrame([(i, 3 if i < 6 else 7, [1.0]) for i in range(8)], "id long, LABEL int, v array<double>")
    df = df.select("id", "LABEL", array_to_vector("v").alias("features"))
    row = SoftmaxTrees({"rounds": 2}, balanced=False).fit(df).transform(df).first()
    assert row["probability"] == pytest.approx([0.75, 0.25])
