"""Squared hinge planes against Newton's method without Spark."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from inkgrain.operators import hinge
from inkgrain.operators.hinge import fit_planes, loss_and_gradient, row_blocks, spark_planes
from inkgrain.operators.store import new_path


def drawn(n=300, d=6, seed=0):
    rng = np.random.default_rng(seed)
    x, y = rng.normal(size=(n, d)), rng.choice(3, n, p=[0.7, 0.2, 0.1])
    x[:, 0] += y
    x[:, 1] -= 2 * (y == 1)
    return x, y, 1.0 + (np.arange(n) % 3) * 0.5


def frame(spark, x, y, w):
    rows = [(int(b), float(c), [float(v) for v in a]) for a, b, c in zip(x, y, w)]
    return spark.createDataFrame(rows, "y int, w double, v array<double>").select("y", "w", array_to_vector("v").alias("x")).repartition(4)


def objective(v, x, side, w, cost):
    short = np.maximum(1 - side * (np.c_[x, np.ones(len(x))] @ v), 0)
    return 0.5 * v @ v + cost * (w * short * short).sum()


def newton(x, side, w, cost):
    a = np.c_[x, np.ones(len(x))]
    v = np.zeros(a.shape[1])
    for _ in range(100):
        short = 1 - side * (a @ v)
        on = short > 0
        g = v - 2 * cost * a[on].T @ (w * side * short)[on]
        v = v - np.linalg.solve(np.eye(len(v)) + 2 * cost * (a[on] * w[on, None]).T @ a[on], g)
    return v


@pytest.mark.parametrize("cost", [0.01, 0.7, 2.0])
def test_planes_match_newton(spark, cost, monkeypatch):
    monkeypatch.setattr(hinge, "BLOCK_VALUES", 200)
    x, y, w = drawn()
    got = fit_planes(frame(spark, x, y, w), 3, cost, tol=1e-6)
    for c in range(3):
        side = np.where(y == c, 1.0, -1.0)
        want = newton(x, side, w, cost)
        assert np.abs(got[:, c] - want).max() < 1e-4
        assert objective(got[:, c], x, side, w, cost) <= objective(want, x, side, w, cost) * (1 + 1e-9)


def test_gradient_is_that_of_the_loss(spark):
    x, y, w = drawn(40, 3)
    blocks = row_blocks(frame(spark, x, y, w))
    at = np.random.default_rng(1).normal(size=(4, 3))
    loss, gradient = loss_and_gradient(blocks, at, 0.3)
    for c in range(3):
        side = np.where(y == c, 1.0, -1.0)
        assert loss[c] == pytest.approx(objective(at[:, c], x, side, w, 0.3))
        for k in range(4):
            step = np.eye(4)[k] * 1e-6
            slope = (objective(at[:, c] + step, x, side, w, 0.3) - objective(at[:, c] - step, x, side, w, 0.3)) / 2e-6
            assert gradient[k, c] == pytest.approx(slope, rel=1e-4, abs=1e-4)


def test_planes_are_spark_models(spark):
    planes = np.array([[1.0, -2.0], [0.5, 0.0], [0.25, 3.0]])
    for c, model in enumerate(spark_planes(spark, planes)):
        path = new_path(spark, "plane")
        model.save(path)
        again = type(model).load(path)
        assert again.coefficients.toArray().tolist() == planes[:-1, c].tolist() and again.intercept == planes[-1, c]
        row = again.transform(spark.createDataFrame([([2.0, 4.0],)], "v array<double>").select(array_to_vector("v").alias("features"))).first()
        assert row["rawPrediction"][1] == pytest.approx(planes[:-1, c] @ [2, 4] + planes[-1, c])
