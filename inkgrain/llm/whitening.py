"""Whitening of embeddings: singular values and vectors by Golub-Kahan-Lanczos bidiagonalisation over distributed rows."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgrain.llm.shared import ship, written

SCALE = 64.0
SHIFT = 1_000_000
#: Larger entries count as this one, so that every entry is a long.
LARGEST = float(1 << 60)
COMPONENTS = 16
#: Rows of the fit list are kept in blocks of about this many bytes.
BLOCK_BYTES = 1 << 20
#: Singular values below this share of the norm count as zero while the basis grows.
ZERO = 1e-12
#: Components whose deviation is below this share of the largest one cannot be whitened.
RANK = 1e-9


def grid(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x``: entries on the integer grid, of the rows whose vector has finite entries only."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    step = lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))) + F.lit(SHIFT).cast("long")
    kept = vectors.where(F.coalesce(fine, F.lit(False)))
    return kept.select(F.col(id_col).alias("vec_id"), F.transform(v, step).alias("x"))


def fit_blocks(rows: DataFrame) -> DataFrame:
    """``width, n, block``: each distinct vector once, many to a row as little-endian longs; written."""

    def pack(batches):
        held, size = {}, 0
        for batch in batches:
            xs = batch.column("x")
            widths = np.diff(xs.offsets.to_numpy())
            flat = xs.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(widths)
            for d in np.unique(widths).tolist():
                pick = np.flatnonzero(widths == d)
                cells = (ends[pick] - d)[:, None] + np.arange(d)
                held.setdefault(d, []).append(flat[cells].astype("<i8"))
                size += 8 * d * len(pick)
            if size >= BLOCK_BYTES:
                yield from flush(held)
                held, size = {}, 0
        yield from flush(held)

    def flush(held):
        for d, parts in held.items():
            whole = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([len(whole)], pa.int64()), pa.array([whole.tobytes()], pa.binary())], ["width", "n", "block"])

    return written(rows.where(F.size("x") > 0).select("x").distinct().mapInArrow(pack, "width int, n long, block binary"), "fit")


def _blocks(batches):
    for batch in batches:
        for d, raw in zip(batch.column("width").to_pylist(), batch.column("block").to_pylist()):
            yield np.frombuffer(raw, dtype="<i8").reshape(-1, d)


def slot_sums(blocks: DataFrame, function) -> np.ndarray:
    """Sum over all rows of what ``function`` makes of a block of rows: an array of doubles of one length.

    A task adds up its blocks first; the rest is a grouped sum, so the driver gets one row a slot."""

    def run(batches):
        total = None
        for x in _blocks(batches):
            part = function(x)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total, pa.float64())], ["slot", "value"])

    sums = blocks.mapInArrow(run, "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(sums))
    for r in sums:
        out[r["slot"]] = r["value"]
    return out


def column_sums(blocks: DataFrame) -> tuple[int, list[int]]:
    """Rows of the fit list and the exact sum of each dimension, as two halves of 32 bits each."""

    def run(batches):
        high = low = None
        n = 0
        for x in _blocks(batches):
            h, w = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            high, low, n = (h, w, len(x)) if high is None else (high + h, low + w, n + len(x))
        if high is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(high)), pa.int32()), pa.array(high), pa.array(low), pa.array([n] * len(high), pa.int64())], ["dim", "high", "low", "n"])

    sums = blocks.mapInArrow(run, "dim int, high long, low long, n long").groupBy("dim").agg(*[F.sum(c).alias(c) for c in ("high", "low", "n")])
    rows = sorted(sums.collect(), key=lambda r: r["dim"])
    return rows[0]["n"], [(r["high"] << 32) + r["low"] for r in rows]


@dataclass
class Centre:
    """The exact mean of a column is ``base + rest / n``, with 0 <= rest < n."""

    n: int
    base: np.ndarray
    rest: np.ndarray

    @staticmethod
    def of(n: int, sums: list[int]) -> "Centre":
        return Centre(n, np.array([s // n for s in sums], dtype=np.int64), np.array([s % n for s in sums], dtype=np.int64))

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Rows less the mean; the integers are subtracted before anything is rounded."""
        return (x - self.base).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*x - S)^2 of each row, exact; null where it exceeds a long."""
        gap = x - self.base
        most = int(np.abs(gap).max(initial=0)) + 1
        if (most * self.n) ** 2 * max(1, x.shape[1]) < 1 << 63:
            return ((gap * self.n - self.rest) ** 2).sum(axis=1).tolist()
        exact = [sum((g * self.n - r) ** 2 for g, r in zip(row, self.rest.tolist())) for row in gap.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


@dataclass
class Bidiagonal:
    """State of the recurrence, on the driver: at most four matrices of width x width.

    ``v``: orthonormal right vectors (columns). ``w``: the left vectors are X @ w, so they are never stored, and no lost executor can lose
    them. ``z``: X' times the left vectors. ``r``: left' X right, bidiagonal but for rounding and restarts.
    """

    v: np.ndarray
    w: np.ndarray
    z: np.ndarray
    columns: list[np.ndarray] = field(default_factory=list)

    @property
    def r(self) -> np.ndarray:
        out = np.zeros((self.w.shape[1], len(self.columns)))
        for k, c in enumerate(self.columns):
            out[: len(c), k] = c
        return out


def _fresh(v: np.ndarray, z: np.ndarray, rng) -> np.ndarray | None:
    """``z`` made orthogonal to the columns of ``v`` and scaled, or None if nothing is left of it."""
    before = np.linalg.norm(z)
    for _ in range(3):
        z = z - v @ (v.T @ z)
    size = np.linalg.norm(z)
    return z / size if size > 1e-8 * before else None


def bidiagonalise(blocks: DataFrame, width: int, centre: Centre, steps: int | None = None, seed: int = 7) -> tuple[Bidiagonal, float]:
    """Golub-Kahan-Lanczos steps on the centred rows X, and the sum of all squared entries.

    A step is one job: with the next right vector v it forms p = Xv less its part in the earlier left vectors U, and in the same pass X'p
    and U'p. The second takes out of p what rounding left in U (full reorthogonalisation of the left side); X'u is then orthogonalised
    against all right vectors on the driver. Where the recurrence ends early (a singular value repeats, or the rows fill a smaller space) it
    goes on with a random direction. ``steps`` defaults to the width, which makes the result complete; fewer approximate the leading part.
    """
    sent = blocks.sparkSession.sparkContext
    rng = np.random.default_rng(seed)
    state = Bidiagonal(np.zeros((width, 0)), np.zeros((width, 0)), np.zeros((width, 0)))
    v, total = _fresh(state.v, rng.standard_normal(width), rng), None
    for _ in range(min(width, steps or width)):
        known = state.z.T @ v
        p = v - state.w @ known
        shared = sent.broadcast((centre, p, state.w))

        def products(x, shared=shared):
            mean, direction, lefts = shared.value
            rows = mean.apply(x)
            image = rows @ direction
            return np.concatenate([[image @ image, (rows * rows).sum()], rows.T @ image, (rows @ lefts).T @ image])

        sums = slot_sums(blocks, products)
        shared.destroy()
        total, back, left_over = sums[1], sums[2 : 2 + width], sums[2 + width :]
        alpha = np.sqrt(max(0.0, sums[0] - left_over @ left_over))
        column = known + left_over
        state.v = np.column_stack([state.v, v])
        following = None
        if alpha > ZERO * np.sqrt(total):
            left = (p - state.w @ left_over) / alpha
            image = (back - state.z @ left_over) / alpha
            state.w, state.z = np.column_stack([state.w, left]), np.column_stack([state.z, image])
            column = np.append(column, alpha)
            rest = image - state.v @ (state.v.T @ image)
            if np.linalg.norm(rest) > ZERO * np.sqrt(total):
                following = _fresh(state.v, rest, rng)
        state.columns.append(column)
        while following is None and state.v.shape[1] < width:
            following = _fresh(state.v, rng.standard_normal(width), rng)
        v = following
    return state, total


@dataclass
class Whitening:
    """Means, components (columns, falling deviation) and the figures of one width."""

    centre: Centre
    components: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray
    identity_error: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centre.apply(x) @ self.components / self.deviations


def fit_width(blocks: DataFrame, width: int, components: int = COMPONENTS, steps: int | None = None) -> Whitening:
    """The leading components of the rows of one width; fewer than asked for if the rows span a smaller space."""
    n, sums = column_sums(blocks)
    centre = Centre.of(n, sums)
    state, total = bidiagonalise(blocks, width, centre, steps)
    empty = Whitening(centre, np.zeros((width, 0)), np.zeros(0), np.zeros(0), 0.0)
    if not state.w.shape[1]:
        return empty
    _, singular, right = np.linalg.svd(state.r)
    singular = singular[: min(components, len(singular))]
    singular = singular[singular > RANK * singular[0]]
    vectors = state.v @ right[: len(singular)].T
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])
    fitted = Whitening(centre, vectors, singular / np.sqrt(n), singular**2 / total, 0.0)
    shared = blocks.sparkSession.sparkContext.broadcast(fitted)

    def moments(x):
        y = shared.value.apply(x)
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    sums = slot_sums(blocks, moments)
    k = len(singular)
    mean = sums[:k] / n
    covariance = sums[k:].reshape(k, k) / n - np.outer(mean, mean)
    fitted.identity_error = float(np.abs(covariance - np.eye(k)).max())
    shared.destroy()
    return fitted


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, steps: int | None = None) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row and component.

    Entries are put on the grid floor(64*c) + 1000000; the fit list holds each distinct grid vector once, and means, covariance and
    components are those of the fit list. ``width`` passes over it find the components; a pass sends one number a slot to the
    driver. Copies meet on the map side before the shuffle of the fit list, so a vector that fills a third of the table costs no more than another.

    Null vectors, vectors with null or non-finite entries, and empty vectors give no rows. Vectors of another width are another space and are
    fitted by themselves. Where the fit list spans fewer dimensions than components are asked for (always when it holds one vector),
    the components without deviation are left out. Entries beyond 2^60 / 64 count as that; a deviation beyond a long is null.
    Repeated rows and null ids each get their rows. An empty table gives none. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = grid(vectors, id_col, vector_col)
    blocks = fit_blocks(rows)
    widths = [r["width"] for r in blocks.select("width").distinct().orderBy("width").collect()]
    fitted = {d: fit_width(blocks.where(F.col("width") == d), d, components, steps) for d in widths}
    shared = spark.sparkContext.broadcast(fitted)

    def run(batches):
        known = shared.value
        for batch in batches:
            xs = batch.column("x")
            widths = np.diff(xs.offsets.to_numpy())
            flat = xs.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(widths)
            for d in np.unique(widths).tolist():
                if d not in known or not len(known[d].deviations):
                    continue
                model = known[d]
                pick = np.flatnonzero(widths == d)
                x = flat[(ends[pick] - d)[:, None] + np.arange(d)]
                k, m = len(model.deviations), len(pick)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(np.repeat(pick, k))),
                        pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                        pa.array(np.full(m * k, model.centre.n), pa.int64()),
                        pa.array([v for v in model.centre.deviations(x) for _ in range(k)], pa.int64()),
                        pa.array(model.apply(x).ravel(), pa.float64()),
                        pa.array(np.tile(model.explained, m), pa.float64()),
                        pa.array(np.full(m * k, model.identity_error), pa.float64()),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    schema = f"vec_id {dict(rows.dtypes)['vec_id']}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.mapInArrow(run, schema)
