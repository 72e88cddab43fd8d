"""Whitening of vectors by Jacobi-Davidson, without forming a covariance matrix.

The leading eigenvectors are sought in a growing subspace. A step multiplies a
narrow block by the covariance in one distributed pass over the distinct
vectors, centred first; the correction equations of all open eigenvectors are
solved side by side by a few steps of MINRES, orthogonal to what is already
found. Converged vectors are locked in falling order of their values, and all
are checked once more together at the end.

The driver holds blocks of dimension x subspace alone; partial products of many
tasks are summed in a tree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tecframe.llm.graphs import settle

SCALE = 64
WANTED = 16
LARGEST = 1 << 44  # scaled entries beyond are set to it
TOLERANCE = 2.0**-45  # of a residual, relative to the largest eigenvalue
INNER, OUTER = 8, 60  # steps of MINRES for one correction; corrections before giving up
FAN_IN = 64
PACKED = "vec_id long, d int, x binary"
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scaled vectors of finite entries as bytes: two or eight an entry, as the vector's range needs."""
    for batch in batches:
        lists = batch.column("embedding")
        off = np.asarray(lists.offsets, np.int64)
        values = lists.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
        odd = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        good = np.flatnonzero(np.asarray(lists.is_valid()) & (odd[off[1:]] == odd[off[:-1]]))
        with np.errstate(all="ignore"):
            y = np.clip(np.floor(values * SCALE), -LARGEST, LARGEST)
        out = []
        for i in good.tolist():
            row = y[off[i]: off[i + 1]]
            out.append(row.astype("<i2" if (np.abs(row) < 1 << 15).all() else "<i8").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(good)), pa.array(np.diff(off)[good], pa.int32()), pa.array(out, pa.binary())], ["vec_id", "d", "x"])


def _unpacked(column: pa.Array, d: int) -> np.ndarray:
    raw = column.to_pylist()
    out = np.empty((len(raw), d), np.int64)
    short = np.array([len(x) == 2 * d for x in raw], bool)
    for rows, kind in ((np.flatnonzero(short), "<i2"), (np.flatnonzero(~short), "<i8")):
        out[rows] = np.frombuffer(b"".join(raw[i] for i in rows.tolist()), kind).reshape(-1, d)
    return out


class Centre:
    """Means of the scaled vectors, S / n, as whole part and rest."""

    def __init__(self, sums: list[int], n: int) -> None:
        self.sums, self.n = sums, n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def __call__(self, y: np.ndarray) -> np.ndarray:
        return (y - self.whole) - self.rest / self.n

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """Sum of (n * y - S) ** 2 of each row, exact; None where a long can't hold it."""
        rough = ((self(y) * self.n) ** 2).sum(1)
        out = (((y - self.whole) * self.n - self.rest) ** 2).sum(1).tolist()
        for i in np.flatnonzero(rough >= 2.0**62).tolist():
            exact = sum((self.n * v - s) ** 2 for v, s in zip(y[i].tolist(), self.sums))
            out[i] = exact if exact < 1 << 63 else None
        return out


def _sums(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * d, 0
        for batch in batches:
            y = _unpacked(batch.column("x"), d)
            total, n = [a + b for a, b in zip(total, y.sum(0).tolist())], n + len(y)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), pa.array([Decimal(v) for v in [n, *total]], pa.decimal128(38, 0))], ["dim", "total"])

    return run


def blockwise(fit: DataFrame, d: int, centre: Centre, fn: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of fn(centred rows), an array of fixed shape."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                one = fn(centre(_unpacked(batch.column("x"), d)))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.astype("<f8").tobytes()], pa.binary())], ["part", "block"])

    def together(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part")
        total = sum(np.frombuffer(x, "<f8") for x in rows["block"].to_pylist())
        return pa.table({"part": pa.array([rows["part"][0].as_py() // FAN_IN], pa.int64()), "block": pa.array([total.tobytes()], pa.binary())})

    shape = fn(np.zeros((1, d))).shape
    parts, blocks = fit.rdd.getNumPartitions(), fit.mapInArrow(part, "part long, block binary")
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        blocks = blocks.groupBy(F.expr(f"part div {FAN_IN}")).applyInArrow(together, "part long, block binary")
    return sum(np.frombuffer(r.block, "<f8") for r in sorted(blocks.collect(), key=lambda r: r.part)).reshape(shape)


def orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of `new` add to the orthonormal bases; what rounding leaves is dropped."""
    known, out = [b for b in bases if b.shape[1]], []
    for v in new.T:
        size = np.linalg.norm(v)
        for _ in range(3):
            for b in known:
                v = v - b @ (b.T @ v)
            for u in out:
                v = v - u * (u @ v)
        left = np.linalg.norm(v)
        if size and left > 1e-10 * size:
            out.append(v / left)
    return np.array(out).T.reshape(new.shape[0], len(out))


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Columns x of least residual of apply(x) = b, side by side, until all residuals fell by `enough`."""
    start = np.linalg.norm(b, axis=0)
    over = lambda a, c: np.divide(a, c, out=np.zeros(np.broadcast_shapes(a.shape, c.shape)), where=c > 0)
    v, v_before, x = over(b, start), np.zeros_like(b), np.zeros_like(b)
    w, w_before = np.zeros_like(b), np.zeros_like(b)
    beta, left = np.zeros(b.shape[1]), start.copy()
    cos, cos_before, sin, sin_before = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        p = apply(v) - beta * v_before
        alpha = (v * p).sum(0)
        p -= alpha * v
        following = np.linalg.norm(p, axis=0)
        diagonal = cos * alpha - cos_before * sin * beta
        size = np.hypot(diagonal, following)
        step = over(v - sin_before * beta * w_before - (sin * alpha + cos_before * cos * beta) * w, size)
        w_before, w = w, step
        cos_before, sin_before, cos, sin = cos, sin, over(diagonal, size), over(following, size)
        x += cos * left * step
        left = -sin * left
        v_before, v, beta = v, over(p, following), following
        if (np.abs(left) <= enough * start).all():
            break
    return x


def leading(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Largest `wanted` eigenvalues of the symmetric operator, falling, with eigenvectors as columns."""
    rng = np.random.default_rng(seed)
    most = max(4 * wanted, wanted + 8)
    locked, values = np.zeros((d, 0)), []
    space = orthonormal(rng.standard_normal((d, min(d, wanted + 4))))
    image = product(space)
    for _ in range(OUTER):
        theta, turn = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        open_ = wanted - len(values)
        rest = image[:, :open_] - space[:, :open_] * theta[:open_]
        rest -= locked @ (locked.T @ rest)
        size = np.linalg.norm(rest, axis=0)
        largest = max([*values, theta[0], 0.0])
        done = 0
        while done < open_ and size[done] <= TOLERANCE * largest:
            done += 1
        locked, values = np.hstack([locked, space[:, :done]]), [*values, *theta[:done].tolist()]
        if len(values) == wanted:  # all at once, with fresh products
            space = orthonormal(np.hstack([locked, space[:, done:]]))
            image = product(space)
            theta, turn = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
            theta, turn = theta[::-1][:wanted], turn[:, ::-1][:, :wanted]
            vectors = space @ turn
            if (np.linalg.norm(image @ turn - vectors * theta, axis=0) <= 2 * TOLERANCE * max(theta[0], 0.0)).all():
                return theta, vectors
            locked, values = np.zeros((d, 0)), []
            continue
        space, image, theta, rest = space[:, done:], image[:, done:], theta[done:], rest[:, done:]
        keep = space.shape[1] if space.shape[1] + open_ - done <= most else 2 * wanted
        space, image, theta = space[:, :keep], image[:, :keep], theta[:keep]
        if locked.shape[1] + space.shape[1] == d:  # the whole space: only rounding is left
            space = orthonormal(space, locked)
            image = product(space)
            image -= locked @ (locked.T @ image)
            continue
        found = np.hstack([locked, space[:, : rest.shape[1]]])
        project = lambda t: t - found @ (found.T @ t)
        shift = theta[: rest.shape[1]]
        new = minres(lambda t: project(product(project(t)) - project(t) * shift), -project(rest), INNER, 0.05)
        new = orthonormal(new, locked, space)
        if not new.shape[1]:
            new = orthonormal(rng.standard_normal((d, 1)), locked, space)
        space, image = np.hstack([space, new]), np.hstack([image, product(new)])
    raise ArithmeticError(f"{wanted - len(values)} eigenvectors did not converge in {OUTER} corrections")


def components(fit: DataFrame, d: int, wanted: int = WANTED) -> tuple[Centre, np.ndarray, np.ndarray, float]:
    """Centre, eigenvalues (falling), eigenvectors and trace of the covariance of the distinct vectors fit (x)."""
    totals = {r.dim: int(r.total) for r in fit.mapInArrow(_sums(d), "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total")).collect()}
    centre = Centre([totals[i] for i in range(d)], totals[-1])
    trace = float(blockwise(fit, d, centre, lambda c: np.array([(c * c).sum()]))[0]) / centre.n
    if not trace:
        return centre, np.zeros(0), np.zeros((d, 0)), trace

    def product(block: np.ndarray) -> np.ndarray:
        return blockwise(fit, d, centre, lambda c: c.T @ (c @ block)) / centre.n

    values, vectors = leading(product, d, min(wanted, d))
    some = values > 2.0**-40 * values[0]
    return centre, values[some], vectors[:, some], trace


def whiten(vectors: DataFrame, wanted: int = WANTED) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every usable row of vectors and component.

    Rows whose vector is null or holds null or non-finite entries are left out;
    of vectors of several lengths, those of the commonest (the longer one of
    equals). Equal vectors count once in the covariance and each row gets its
    own result, also where vec_id is null or repeated. Components without
    variance (relative to the first, 2 ** -40) are left out; where all vectors
    are equal, or there are none, there are no rows. Scaled entries beyond 2 ** 44
    are set to that; a deviation that a long can't hold is null.
    """
    spark = vectors.sparkSession
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = settle(given.mapInArrow(_packed, PACKED).where("d > 0"), "vectors")
    common = rows.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], OUT)
    d = common.d
    rows = rows.where(F.col("d") == d)
    fit = settle(rows.select("x").distinct(), "fit")
    centre, values, basis, trace = components(fit, d, wanted)
    k = len(values)
    if not k:
        return spark.createDataFrame([], OUT)
    scaled, share = basis / np.sqrt(values), values / trace

    def spread(c: np.ndarray) -> np.ndarray:
        z = c @ scaled
        return np.vstack([z.T @ z, z.sum(0)])

    moments = blockwise(fit, d, centre, spread) / centre.n
    identity_error = float(np.abs(moments[:k] - np.outer(moments[k], moments[k]) - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, m = _unpacked(batch.column("x"), d), batch.num_rows
            ids = batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), k)))
            deviation = pa.array(centre.deviations(y), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
            full = lambda v, kind: pa.array(np.full(m * k, v), kind)
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), full(centre.n, pa.int64()), deviation, pa.array((centre(y) @ scaled).ravel()),
                    pa.array(np.tile(share, m)), full(identity_error, pa.float64()),
                ],
                [f.split()[0] for f in OUT.split(", ")],
            )

    return rows.select("vec_id", "x").mapInArrow(project, OUT)
