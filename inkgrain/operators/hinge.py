"""Linear planes under the squared hinge loss, all classes in the same passes over the rows."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVCModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgrain.operators.store import write_table

#: Steps that the search direction remembers.
MEMORY = 10
#: A step must win at least this share of what the slope promises.
ARMIJO = 1e-4
#: Values of a block of rows.
BLOCK_VALUES = 1 << 17


def row_blocks(rows: DataFrame) -> DataFrame:
    """``(y, w, x)`` rows as written blocks of doubles: per row the class position, the weight, and the features with a 1 for the intercept."""

    def pack(batches):
        for batch in batches:
            xs = batch.column("x")
            n = batch.num_rows
            if not n:
                continue
            flat = xs.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            whole = np.column_stack([batch.column("y").to_numpy(), batch.column("w").to_numpy(), flat, np.ones(n)])
            for at in range(0, n, max(1, BLOCK_VALUES // whole.shape[1])):
                part = whole[at : at + max(1, BLOCK_VALUES // whole.shape[1])]
                yield pa.RecordBatch.from_arrays([pa.array([whole.shape[1]], pa.int32()), pa.array([part.astype("<f8").tobytes()], pa.binary())], ["width", "block"])

    dense = rows.select(F.col("y").cast("double").alias("y"), F.col("w").cast("double").alias("w"), vector_to_array("x").alias("x"))
    return write_table(dense.mapInArrow(pack, "width int, block binary"), "blocks")


def loss_and_gradient(blocks: DataFrame, planes: np.ndarray, cost: float) -> tuple[np.ndarray, np.ndarray]:
    """Per class ``|v|^2 / 2 + cost * sum of w * max(0, 1 - s * v.x)^2`` with s = 1 for the class and -1 for the others, and its gradient.

    One pass: every task adds up its blocks, a grouped sum adds up the tasks, and the driver gets classes x width numbers.
    """
    sent = blocks.sparkSession.sparkContext.broadcast(planes)

    def run(batches):
        v, out = sent.value, None
        for batch in batches:
            for width, raw in zip(batch.column("width").to_pylist(), batch.column("block").to_pylist()):
                part = np.frombuffer(raw, dtype="<f8").reshape(-1, width)
                y, w, x = part[:, 0].astype(int), part[:, 1], part[:, 2:]
                side = np.where(y[:, None] == np.arange(v.shape[1]), 1.0, -1.0)
                short = np.maximum(1 - side * (x @ v), 0) * w[:, None]
                loss = (short * short / np.where(w > 0, w, 1)[:, None]).sum(axis=0)
                total = np.vstack([loss, x.T @ (-2 * side * short)])
                out = total if out is None else out + total
        if out is not None:
            flat = out.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat, pa.float64())], ["slot", "value"])

    total = np.zeros(planes.size + planes.shape[1])
    for r in blocks.mapInArrow(run, "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value")).collect():
        total[r["slot"]] = r["value"]
    sent.destroy()
    total = total.reshape(-1, planes.shape[1])
    return 0.5 * (planes * planes).sum(axis=0) + cost * total[0], planes + cost * total[1:]


@dataclass
class Descent:
    """Limited-memory quasi-Newton state of one class."""

    at: np.ndarray
    loss: float
    gradient: np.ndarray
    goal: float
    steps: list = field(default_factory=list)
    direction: np.ndarray | None = None
    length: float = 1.0
    done: bool = False

    def aim(self) -> None:
        """The next direction, by the two loops over the remembered steps."""
        q, shares = self.gradient.copy(), []
        for s, d in reversed(self.steps):
            share = (s @ q) / (s @ d)
            shares.append(share)
            q -= share * d
        if self.steps:
            s, d = self.steps[-1]
            q *= (s @ d) / (d @ d)
        for (s, d), share in zip(self.steps, reversed(shares)):
            q += s * (share - (d @ q) / (s @ d))
        self.direction = -q
        self.length = 1.0 if self.steps else min(1.0, 1.0 / max(np.linalg.norm(q), 1e-300))

    def candidate(self) -> np.ndarray:
        return self.at if self.done else self.at + self.length * self.direction

    def judge(self, loss: float, gradient: np.ndarray) -> None:
        """Take the step if it wins enough, else shorten it."""
        if self.done:
            return
        slope = self.gradient @ self.direction
        if loss > self.loss + ARMIJO * self.length * slope:
            # The lowest point of the parabola through both losses and the slope, but not too near either end.
            best = -slope * self.length**2 / (2 * (loss - self.loss - slope * self.length))
            self.length = min(max(best, 0.1 * self.length), 0.5 * self.length)
            self.done = self.length < 1e-12
            return
        moved = self.length * self.direction
        change = gradient - self.gradient
        if moved @ change > 1e-14 * (change @ change):
            self.steps = [*self.steps, (moved, change)][-MEMORY:]
        self.at, self.loss, self.gradient = self.at + moved, loss, gradient
        self.done = np.linalg.norm(gradient) <= self.goal
        if not self.done:
            self.aim()


def fit_planes(rows: DataFrame, classes: int, cost: float, tol: float = 1e-4, max_iter: int = 1000) -> np.ndarray:
    """Planes (width + 1) x classes of the one-vs-rest problems; the last row is the intercept, which is penalised like a weight.

    ``rows`` have ``y, w, x``. All classes move in step, so a pass serves all of them, whether one takes a step or shortens it. A class
    is done when the norm of its gradient has fallen to ``tol`` times the first one, weighed by the rarer side as usual. Nothing is kept on executors between passes.
    """
    blocks = row_blocks(rows)
    width = blocks.select("width").first()["width"] - 2
    counts = {int(r["y"]): r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n = sum(counts.values())
    loss, gradient = loss_and_gradient(blocks, np.zeros((width, classes)), cost)
    state = []
    for c in range(classes):
        own = counts.get(c, 0)
        goal = tol * max(min(own, n - own), 1) / n * np.linalg.norm(gradient[:, c])
        state.append(Descent(np.zeros(width), loss[c], gradient[:, c], goal, done=not np.linalg.norm(gradient[:, c])))
        state[-1].aim()
    for _ in range(max_iter):
        if all(s.done for s in state):
            break
        loss, gradient = loss_and_gradient(blocks, np.column_stack([s.candidate() for s in state]), cost)
        for c, s in enumerate(state):
            s.judge(loss[c], gradient[:, c])
    return np.column_stack([s.at for s in state])


def spark_planes(spark, planes: np.ndarray) -> list[LinearSVCModel]:
    """The planes as Spark's own models, which score without Python and are saved like others."""
    sc = spark.sparkContext
    make = sc._jvm.org.apache.spark.ml.classification.LinearSVCModel
    out = []
    for c in range(planes.shape[1]):
        java = make(f"plane_{c}", _py2java(sc, DenseVector(planes[:-1, c])), float(planes[-1, c]))
        out.append(LinearSVCModel(java))
    return out
