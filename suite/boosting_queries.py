"""Steps of softmax boosting on real rows: gradients, leaf values, the choice of splits, and the probabilities of given trees."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from inkgrain.operators.boosting import TREE_SCHEMA, Node, SoftmaxTreesModel, best_first, gradients, leaf_table, node_rows, with_sums
from inkgrain.operators.store import write_table
from inkgrain.sources.tables import read_table
from suite.registry import query

L1, L2, RATE = 0.5, 2.0, 0.1

# Three classes, scores from three components of the vector, leaves from two thresholds.
POINTS_SQL = """
    SELECT vec_id, label % 3 AS y, CASE WHEN label % 3 = 0 THEN 1.5::DOUBLE ELSE 1 END AS w, embedding AS e,
           exp(embedding[1]::DOUBLE) AS a, exp(2 * embedding[2]::DOUBLE) AS b, exp(-embedding[3]::DOUBLE) AS c
    FROM embeddings"""
STEPS_SQL = f"""
p AS ({POINTS_SQL}),
chances AS (SELECT vec_id, y, w, e, unnest([0, 1, 2]) AS class, unnest([a / (a + b + c), b / (a + b + c), c / (a + b + c)]) AS p FROM p),
steps AS (SELECT vec_id, class, e, w * (p - CASE WHEN y = class THEN 1 ELSE 0 END) AS g, w * greatest(p * (1 - p), 0.000001::DOUBLE) AS h FROM chances)"""


def scored_points(spark, sf):
    rows = read_table(spark, sf, "embeddings")
    e = lambda i: F.col("embedding")[i].cast("double")
    y = (F.col("label") % 3).alias("y")
    weight = F.when(F.col("label") % 3 == 0, 1.5).otherwise(1.0).alias("w")
    return rows.select("vec_id", y, weight, "embedding", F.array(e(0), 2 * e(1), -e(2)).alias("s"))


def steps(spark, sf):
    rows = scored_points(spark, sf)
    rows = rows.select("vec_id", "embedding", F.posexplode(gradients(F.col("s"), F.col("y"), F.col("w"))).alias("class", "e"))
    return rows.select("vec_id", "embedding", "class", "e.g", "e.h")


@query("softmax_gradients", f"WITH {STEPS_SQL} SELECT vec_id, class, round(g, 9) AS g, round(h, 9) AS h FROM steps")
def softmax_gradients(spark, sf):
    return steps(spark, sf).select("vec_id", "class", F.round("g", 9).alias("g"), F.round("h", 9).alias("h"))


LEAF_SQL = "CASE WHEN e[4] <= 0.05 THEN CASE WHEN e[5] <= -0.02 THEN 0 ELSE 1 END ELSE CASE WHEN e[6] <= 0 THEN 2 ELSE 3 END END"
SUMS_SQL = f"sums AS (SELECT class, {LEAF_SQL} AS leaf, sum(g) AS g, sum(h) AS h, count(*) AS n FROM steps GROUP BY class, leaf)"


def leaf_of(e):
    left = F.when(e[4] <= F.lit(-0.02).cast("double"), 0).otherwise(1)
    right = F.when(e[5] <= 0, 2).otherwise(3)
    return F.when(e[3] <= F.lit(0.05).cast("double"), left).otherwise(right)


def leaf_sums(spark, sf):
    e = F.transform("embedding", lambda c: c.cast("double"))
    return leaf_table(steps(spark, sf).select("class", leaf_of(e).alias("leaf"), "g", "h"), ["class", "leaf"], L1, L2)


@query("leaf_refit", f"""
WITH {STEPS_SQL}, {SUMS_SQL}
SELECT class, leaf, n, round(g, 6) AS g, round(h, 6) AS h, round(-sign(g) * greatest(abs(g) - {L1}, 0) / (h + {L2}), 8) AS value FROM sums""")
def leaf_refit(spark, sf):
    sums = leaf_sums(spark, sf)
    return sums.select("class", "leaf", "n", F.round("g", 6).alias("g"), F.round("h", 6).alias("h"), F.round("value", 8).alias("value"))


def part(g, h):
    return f"power(greatest(abs({g}) - {L1}, 0), 2) / ({h} + {L2})"


@query("leaf_selection", f"""
WITH {STEPS_SQL}, {SUMS_SQL},
wide AS (
    SELECT class, {', '.join(f'sum(g) FILTER (leaf = {i}) AS g{i}, sum(h) FILTER (leaf = {i}) AS h{i}' for i in range(4))} FROM sums GROUP BY class),
gains AS (
    SELECT *, {part('g0', 'h0')} + {part('g1', 'h1')} - {part('g0 + g1', 'h0 + h1')} >= {part('g2', 'h2')} + {part('g3', 'h3')} - {part('g2 + g3', 'h2 + h3')} AS left_first
    FROM wide),
leaves AS (
    SELECT class, unnest(CASE WHEN left_first THEN ['LL', 'LR', 'R'] ELSE ['L', 'RL', 'RR'] END) AS leaf,
           unnest(CASE WHEN left_first THEN [g0, g1, g2 + g3] ELSE [g0 + g1, g2, g3] END) AS g,
           unnest(CASE WHEN left_first THEN [h0, h1, h2 + h3] ELSE [h0 + h1, h2, h3] END) AS h FROM gains)
SELECT class, leaf, round(-{RATE} * sign(g) * greatest(abs(g) - {L1}, 0) / (h + {L2}), 8) AS value FROM leaves""")
def leaf_selection(spark, sf):
    """A tree of four leaves is cut to three: the split below the root that gains more stays."""
    sums = {}
    for r in leaf_sums(spark, sf).collect():  # four rows a class
        sums.setdefault(r["class"], {})[r["leaf"]] = (r["g"], r["h"])
    out = []
    for c, of_class in sums.items():
        root = Node(3, 0.05, Node(4, -0.02, Node(leaf=0), Node(leaf=1)), Node(5, 0.0, Node(leaf=2), Node(leaf=3)))
        with_sums(root, of_class)
        rows = node_rows(root, best_first(root, 3, L1, L2, float("-inf")), L1, L2, RATE)
        paths = {0: ""}
        for at, feature, _, left, right, value in rows:
            if feature < 0:
                out.append((c, paths[at], value))
            else:
                paths[left], paths[right] = paths[at] + "L", paths[at] + "R"
    return spark.createDataFrame(out, "class int, leaf string, value double").withColumn("value", F.round("value", 8))


#: Two rounds of trees for three classes: feature, threshold, and the values of both sides.
STUMPS = [(r, c, (5 * r + 2 * c) % 9, 0.02 * (c - 1) + 0.01 * r, 0.4 - 0.3 * c + 0.1 * r, -0.2 + 0.25 * c) for r in range(2) for c in range(3)]
START = (-1.0, -1.2, -1.1)


def stump_sql(c):
    terms = [f"CASE WHEN embedding[{f + 1}]::DOUBLE <= {t!r}::DOUBLE THEN {a!r}::DOUBLE ELSE {b!r}::DOUBLE END" for _, k, f, t, a, b in STUMPS if k == c]
    return f"exp({START[c]}::DOUBLE + {' + '.join(terms)})"


@query("tree_probabilities", f"""
WITH raised AS (SELECT vec_id, {', '.join(f'{stump_sql(c)} AS e{c}' for c in range(3))} FROM embeddings)
SELECT vec_id, CASE WHEN e0 >= e1 AND e0 >= e2 THEN 0 WHEN e1 >= e2 THEN 10 ELSE 20 END AS prediction,
       {', '.join(f'round(e{c} / (e0 + e1 + e2), 9) AS p{c}' for c in range(3))} FROM raised""")
def tree_probabilities(spark, sf):
    nodes = []
    for r, c, feature, threshold, low, high in STUMPS:
        nodes += [(r, c, 0, feature, threshold, 1, 2, 0.0), (r, c, 1, -1, 0.0, -1, -1, low), (r, c, 2, -1, 0.0, -1, -1, high)]
    trees = write_table(spark.createDataFrame(nodes, TREE_SCHEMA), "trees")
    model = SoftmaxTreesModel(labels=[0, 10, 20], start=list(START), losses=[], trees=trees)
    rows = read_table(spark, sf, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return model.transform(rows).select("vec_id", "prediction", *[F.round(F.col("probability")[c], 9).alias(f"p{c}") for c in range(3)])
