"""Whitening of embeddings on their leading principal components, found by Jacobi-Davidson.

1. ``blocks`` turns each vector ``c`` into integers ``x = floor(1024 c) + 100000`` and stores them as matrices
   of bounded size, so that every later pass is a few matrix products over bytes.
2. The covariance ``V`` is never built: ``Covariance.times`` multiplies it with a few vectors in one
   distributed pass, over rows centred exactly in integers (``n x - S``) before they are multiplied. Tasks'
   sums are added in groups of tasks, so that the driver gets few, each of some vectors only.
3. ``leading_components`` keeps a search space ``W`` with ``V W``. Rayleigh-Ritz in it gives guesses. Those
   whose residual is down to double precision are locked; for the others the correction equation,
   projected away from all guesses and locked vectors, is solved by some steps of MINRES, all at once,
   so that a step costs one pass; the corrections enlarge the space. It goes on until all are locked.
4. ``whiten`` projects each row, and ``identity_error`` measures the covariance of what came out.

Rows are dropped whose vector is null, empty, holds a null or non-finite entry or one of ``LARGEST`` or
more in absolute value, or has another length than most (of equally frequent lengths, the largest).
A null id and repeated rows stay, each row counted. Directions without variance to double precision
cannot be whitened: there may be fewer than ``components``, and none for a single vector or an empty
table. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldseason.llm.common import stored

SCALE, SHIFT, LARGEST = 1024.0, 100_000, 2.0**40
BLOCK_ROWS, BLOCK_BYTES = 1024, 4 << 20
COMPONENTS, FAN_IN = 8, 64
#: Steps of MINRES for a correction; the widest search space, in wanted components; residuals to reach, in units in the last place of the largest eigenvalue times the square root of the dimension.
INNER, WIDEST, TOLERANCE = 4, 6, 32.0
_BLOCK = pa.schema([("length", pa.int32()), ("rows", pa.int64()), ("vec_id", pa.list_(pa.int64())), ("x", pa.binary())])


def blocks(embeddings: DataFrame) -> DataFrame:
    """``length, rows, vec_id, x``: matrices of integers, row by row, with their rows' ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4 * BLOCK_ROWS):
                yield from _packed(batch.slice(at, 4 * BLOCK_ROWS))

    def _packed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, vectors = batch.column(0), batch.column(1)
        sizes = np.array([-1 if n is None else n for n in vectors.value_lengths().to_pylist()], np.int64)
        flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        starts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
        for length in np.unique(sizes[sizes > 0]).tolist():
            rows = np.flatnonzero(sizes == length)
            values = flat[starts[rows][:, None] + np.arange(length)]
            good = (np.abs(values) < LARGEST).all(axis=1)  # false for NaN, which stands for null too
            rows, values = rows[good], values[good]
            each = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * length)))
            for at in range(0, len(rows), each):
                x = np.floor(SCALE * values[at:at + each]).astype("<i8") + SHIFT
                own = ids.take(pa.array(rows[at:at + each])).cast(pa.int64()).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t.type) for v, t in zip((length, len(own), own, x.tobytes()), _BLOCK, strict=True)], schema=_BLOCK)

    return embeddings.select("vec_id", "embedding").mapInArrow(run, "length int, rows long, vec_id array<long>, x binary")


def common_length(packed: DataFrame) -> int:
    """The most frequent length of vectors, 0 without any."""
    found = packed.groupBy("length").agg(F.sum("rows").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    return 0 if found is None else found["length"]


def _exact(n: int, total: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """``n x - S`` of rows ``x``: in 64-bit integers where they hold it, else in Python's."""
    whole = np.array(total, object)
    short = whole.astype(np.int64) if all(abs(s) < 2**62 for s in total) else None

    def exact(x: np.ndarray) -> np.ndarray:
        if short is not None and n * int(np.abs(x).max(initial=0)) < 2**62:
            return n * x - short
        return n * x.astype(object) - whole

    return exact


def _summed(packed: DataFrame, of: Callable[[np.ndarray], list[np.ndarray]], length: int, tasks: int) -> list[np.ndarray]:
    """The sums over all blocks of arrays that ``of`` makes from a block's matrix.

    A task adds up its own blocks; groups of ``FAN_IN`` tasks are added up, in the tasks' order, before the driver.
    """
    schema = pa.schema([("task", pa.int64()), ("parts", pa.list_(pa.binary()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            for x in batch.column(0):
                found = of(np.frombuffer(x.as_buffer(), "<i8").reshape(-1, length))
                total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
        if total is not None:
            parts = [[np.ascontiguousarray(a).tobytes() for a in total]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array(parts, schema.field(1).type)], schema=schema)

    shapes = [(a.shape, a.dtype.str) for a in of(np.zeros((1, length), "<i8"))]

    def add(tables: list[tuple[int, list[bytes]]]) -> list[np.ndarray]:
        total = [np.zeros(s, d) for s, d in shapes]
        for _, parts in sorted(tables):
            total = [a + np.frombuffer(p, d).reshape(s) for a, p, (s, d) in zip(total, parts, shapes, strict=True)]
        return total

    def group(table: pa.Table) -> pa.Table:
        total = add(list(zip(table["task"].to_pylist(), table["parts"].to_pylist(), strict=True)))
        return pa.table([[min(table["task"].to_pylist())], [[a.tobytes() for a in total]]], schema=schema)

    parts = packed.select("x").mapInArrow(run, "task long, parts array<binary>")
    if tasks > FAN_IN:
        parts = parts.groupBy(F.expr(f"task div {FAN_IN}")).applyInArrow(group, "task long, parts array<binary>")
    return add([(r["task"], list(map(bytes, r["parts"]))) for r in parts.collect()])


class Covariance:
    """The covariance of stored blocks of one length, known by its products."""

    def __init__(self, packed: DataFrame, length: int):
        self.packed, self.length, self.tasks = packed, length, packed.rdd.getNumPartitions()
        low = (1 << 20) - 1
        # In two halves, as a sum of 2 ** 50 could leave 64 bits.
        high, rest, rows = self.summed(lambda x: [(x >> 20).sum(axis=0), (x & low).sum(axis=0), np.array([len(x)])])
        self.n, self.total = int(rows[0]), [(int(h) << 20) + int(r) for h, r in zip(high, rest, strict=True)]
        self.exact = exact = _exact(self.n, self.total)
        n = self.n
        squares = self.summed(lambda x: [np.square(exact(x).astype(np.float64) / n).sum(axis=0)])[0]
        self.trace = float(squares.sum() / n)

    def summed(self, of: Callable[[np.ndarray], list[np.ndarray]]) -> list[np.ndarray]:
        return _summed(self.packed, of, self.length, self.tasks)

    def times(self, vectors: np.ndarray) -> np.ndarray:
        exact, n = self.exact, self.n

        def product(x: np.ndarray) -> list[np.ndarray]:
            centred = exact(x).astype(np.float64) / n
            return [centred.T @ (centred @ vectors)]

        return self.summed(product)[0] / n


def _orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Orthonormal columns of what ``new`` adds to the bases; what adds nothing to them is left out."""
    kept = []
    for column in new.T:
        size = np.linalg.norm(column)
        for _ in range(3):  # again, as rounding leaves a little of what is taken away
            for base in (*bases, *([np.stack(kept, 1)] if kept else [])):
                column = column - base @ (base.T @ column)
        left = np.linalg.norm(column)
        if left > 1e-10 * size and left > 0:
            column = column / left
            for base in (*bases, *([np.stack(kept, 1)] if kept else [])):
                column = column - base @ (base.T @ column)
            kept.append(column / np.linalg.norm(column))
    return np.stack(kept, 1) if kept else np.zeros((len(new), 0))


def minres(times: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, enough: float = 0.05) -> np.ndarray:
    """Approximate solutions of ``A x = b`` for each column ``b``, all by the same products: ``times`` multiplies all columns."""
    v, beta = right, np.linalg.norm(right, axis=0)
    start = beta.copy()
    safe = lambda x: np.where(x == 0, 1.0, x)
    v, v_old = v / safe(beta), np.zeros_like(v)
    c, c_old, s, s_old = (np.full(right.shape[1], z) for z in (1.0, 1.0, 0.0, 0.0))
    w, w_old, x, rest, beta_now = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v), beta.copy(), np.zeros_like(beta)
    for _ in range(steps):
        p = times(v) - v_old * beta_now
        alpha = (v * p).sum(axis=0)
        p = p - v * alpha
        beta_next = np.linalg.norm(p, axis=0)
        # Two earlier rotations act on the new column of the tridiagonal matrix, then its own.
        far, near = s_old * beta_now, c * c_old * beta_now + s * alpha
        middle = c * alpha - s * c_old * beta_now
        size = np.hypot(middle, beta_next)
        c_old, s_old = c, s
        c, s = middle / safe(size), beta_next / safe(size)
        w, w_old = (v - w * near - w_old * far) / safe(size), w
        x = x + w * (c * rest)
        rest = -s * rest
        v_old, v, beta_now = v, p / safe(beta_next), beta_next
        if (np.abs(rest) <= enough * start).all():
            break
    return x


def leading_components(times: Callable[[np.ndarray], np.ndarray], d: int, trace: float, wanted: int = COMPONENTS, inner: int = INNER,
                       widest: int = WIDEST, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns, of a matrix known by its products.

    Fewer than ``wanted`` where the rest is zero to double precision. Raises when the residuals stay
    above double precision though the space is renewed again and again; it never settles for less.
    """
    wanted = min(wanted, d)
    tiny = np.finfo(float).eps
    if trace <= 0:
        return np.zeros(0), np.zeros((d, 0))
    locked, values, images = np.zeros((d, 0)), np.zeros(0), np.zeros((d, 0))
    space = _orthonormal(np.random.default_rng(seed).standard_normal((d, min(2 * wanted, d))))
    image, best, calm = times(space), np.inf, 0
    while True:
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        largest = max(theta.max(initial=0), values.max(initial=0))
        guess, image_of = space @ turn, image @ turn
        left = wanted - locked.shape[1]
        residual = image_of[:, :left] - guess[:, :left] * theta[:left]
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        limit = TOLERANCE * tiny * math.sqrt(d) * largest
        # Locked in order, so that none is passed over.
        n = int(np.argmax(np.r_[size > limit, True]))
        if n:
            locked, values = np.hstack([locked, guess[:, :n]]), np.r_[values, theta[:n]]
            images = np.hstack([images, image_of[:, :n]])
        if n == left:
            break
        space, image, theta = guess[:, n:], image_of[:, n:], theta[n:]
        open_, residual = left - n, residual[:, n:]
        now = float(size[n:].max())
        best, calm = (now, 0) if now < 0.5 * best or n else (best, calm + 1)
        if calm > 20:
            raise ArithmeticError(f"residual {now} stays above {limit}")
        if space.shape[1] + open_ > max(widest * wanted, 3 * open_):
            space, image = space[:, :2 * open_], image[:, :2 * open_]
        apart = np.hstack([locked, space[:, :open_]])
        shift = theta[:open_]

        def projected(z: np.ndarray) -> np.ndarray:
            z = z - apart @ (apart.T @ z)
            z = times(z) - z * shift  # noqa: B023
            return z - apart @ (apart.T @ z)

        new = _orthonormal(minres(projected, apart @ (apart.T @ residual) - residual, inner), locked, space)
        if not new.shape[1]:
            # Nothing left to add: the space is whole, and only its images' rounding is in the way.
            space = _orthonormal(space, locked)
            image = times(space)
        else:
            space, image = np.hstack([space, new]), np.hstack([image, times(new)])
    # All vectors together once more, from their own images: orthonormal to the last place.
    q = _orthonormal(locked)
    images = np.linalg.solve((q.T @ locked).T, images.T).T
    small = q.T @ images
    theta, turn = np.linalg.eigh((small + small.T) / 2)
    theta, vectors = theta[::-1], q @ turn[:, ::-1]
    some = theta > d * tiny * trace
    return theta[some], vectors[:, some]


def identity_error(covariance: Covariance, projection: np.ndarray) -> float:
    """The largest absolute entry of the covariance of the projected rows, less the identity."""
    exact, n = covariance.exact, covariance.n
    if not projection.shape[1]:
        return 0.0
    of = lambda x: (exact(x).astype(np.float64) / n) @ projection
    mean = covariance.summed(lambda x: [of(x).sum(axis=0)])[0] / n

    def product(x: np.ndarray) -> list[np.ndarray]:
        centred = of(x) - mean
        return [centred.T @ centred]

    found = covariance.summed(product)[0] / n
    return float(np.abs(found - np.eye(len(found))).max())


_WHITE = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of each remaining row and component."""
    spark = embeddings.sparkSession
    packed = stored(blocks(embeddings))
    length = common_length(packed)
    if not length:
        return spark.createDataFrame([], _WHITE)
    covariance = Covariance(packed.filter(F.col("length") == length), length)
    values, vectors = leading_components(covariance.times, length, covariance.trace, components)
    projection = vectors / np.sqrt(values)
    return _whitened(spark, covariance, projection, values / covariance.trace if len(values) else values)


def _whitened(spark: SparkSession, covariance: Covariance, projection: np.ndarray, explained: np.ndarray) -> DataFrame:
    k, n, error = len(explained), covariance.n, identity_error(covariance, projection)
    exact, length = covariance.exact, covariance.length
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.decimal128(38, 0)),
                        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        for batch in batches:
            for ids, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                centred = exact(np.frombuffer(x.as_buffer(), "<i8").reshape(-1, length))
                largest = int(np.abs(centred).max(initial=0))
                squares = centred if largest**2 * length < 2**63 else centred.astype(object)
                deviation = [Decimal(int(v)) for v in (squares * squares).sum(axis=1)]
                white, rows = (centred.astype(np.float64) / n) @ projection, len(ids)
                at = np.repeat(np.arange(rows), k)
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[i] for i in at], pa.int64()), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n)), pa.array([deviation[i] for i in at], schema.field(3).type),
                    pa.array(white.reshape(-1)), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))], schema=schema)

    return covariance.packed.select("vec_id", "x").mapInArrow(run, _WHITE)
