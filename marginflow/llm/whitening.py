"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance of the fit list (each distinct integer vector once) is only
ever used as V Q: one distributed pass sums Xc' (Xc Q) over blocks of centred
vectors.  A round multiplies the block Q by a Chebyshev polynomial of V, one
pass per degree, which keeps the unwanted spectrum within [-1, 1] and lets the
wanted end grow; QR and Rayleigh-Ritz on the small block follow, and the
residuals |V u - e u| certify the components.  Where rounds don't certify
them (or the block spans all dimensions anyway), the block grows until
Rayleigh-Ritz is the whole eigenproblem, so the fit always ends.

The driver holds matrices of dimensions x block and sums per dimension, never
vectors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import map_batches, prepare, written
from marginflow.llm.vectors import EXACT, packed, scaled, unpacked, width_of

SCALE = 64.0
OFFSET = 1_000_000
COMPONENTS = 16
# Columns of the first block; wanted components, and others that keep them apart.
BLOCK = 32
# Residual, relative to the largest eigenvalue, that certifies a component.
TOLERANCE = 2e-14
MAX_DEGREE = 24
ROUNDS = 8
SEED = 20240611
# Vectors in one block of a pass (as many as this many bytes hold).
PASS_BYTES = 4 << 20
COLUMNS = 16


@dataclass
class Whitening:
    """n, exact sums of x - OFFSET per dimension, eigenvalues and unit
    components (dimensions x components) of the covariance, its trace, the
    identity error and the passes over the fit list."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float
    passes: int

    @property
    def width(self) -> int:
        return len(self.sums)


def integer_vectors(vectors: DataFrame, width: int, embedding: str, keep: list[str]) -> DataFrame:
    """Usable rows: the columns ``keep`` and data, floor(SCALE * entry) per
    dimension as 64-bit integers."""
    kept = vectors.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(embedding).cast("array<double>").alias("v"))
    names = [*kept.columns[:-1], "data"]

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, usable = scaled(b.column("v"), SCALE, width, EXACT)
            rest = [b.column(i).filter(pa.array(usable)) for i in range(len(names) - 1)]
            yield pa.RecordBatch.from_arrays([*rest, packed(x)], names=names)

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]] + ["data binary"])
    return map_batches(kept, scale, schema)


def fit(vectors: DataFrame, components: int = COMPONENTS, embedding: str = "embedding", block: int = BLOCK) -> Whitening:
    """Fit on the distinct integer vectors of the usable rows.

    Components without variance (beyond the rank of the data) are left out; of
    an empty table, or one distinct vector, none is left.
    """
    prepare(vectors.sparkSession)
    width = width_of(vectors, embedding)
    distinct = integer_vectors(vectors, width, embedding, []).distinct()

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most, held, rows = max(1, PASS_BYTES // max(1, 8 * width)), [], 0
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([b"".join(held)], pa.binary())],
                                              names=["m", "data"])
        for b in batches:
            for v in b.column(0).to_pylist():
                held.append(v)
                rows += 1
                if rows == most:
                    yield out()
                    held, rows = [], 0
        if rows:
            yield out()

    blocks = written(map_batches(distinct, together, "m long, data binary"), "fit-list")
    n, sums = _sums(blocks, width)
    if n == 0 or width == 0:
        return Whitening(n, sums, np.zeros(0), np.zeros((width, 0)), 0.0, 0.0, 0)
    mean = np.array([s / n for s in sums])
    passes = 0

    def apply(q: np.ndarray) -> tuple[np.ndarray, float]:
        """V q, and the trace of V."""
        nonlocal passes
        passes += 1

        def of(x: np.ndarray) -> np.ndarray:
            z = x - mean
            return np.column_stack([z.T @ (z @ q), np.einsum("ij,ij->j", z, z)])

        total = _reduce(blocks, width, q.shape[1] + 1, of) / n
        return total[:, :-1], float(total[:, -1].sum())

    values, vectors_, trace = _leading(apply, width, min(components, width), block)
    positive = values > 1e-12 * max(values.max(initial=0.0), trace / width)
    values, vectors_ = values[positive], vectors_[:, positive]
    error = 0.0
    if len(values):
        scale = vectors_ / np.sqrt(values)
        r = len(values)

        def moments(x: np.ndarray) -> np.ndarray:
            w = (x - mean) @ scale
            return np.column_stack([w.T @ w, w.sum(axis=0)])

        total = _reduce(blocks, r, r + 1, moments) / n
        error = float(np.abs(total[:, :-1] - np.outer(total[:, -1], total[:, -1]) - np.eye(r)).max())
        passes += 1
    return Whitening(n, sums, values, vectors_, trace, error, passes)


def _leading(apply: Callable[[np.ndarray], tuple[np.ndarray, float]], width: int, wanted: int,
             block: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Leading ``wanted`` eigenpairs of the matrix behind ``apply``, certified."""
    rng = np.random.default_rng([SEED, width])
    size = min(width, max(block, wanted))
    floor = None
    while True:
        if size == width:  # Rayleigh-Ritz on the whole space
            full, trace = apply(np.eye(width))
            values, u = np.linalg.eigh((full + full.T) / 2)
            return values[::-1][:wanted], u[:, ::-1][:, :wanted], trace
        if floor is None:
            floor = _lower_edge(apply, width, rng)
        q = np.linalg.qr(rng.standard_normal((width, size)))[0]
        last = math.inf
        for _ in range(ROUNDS):
            product, trace = apply(q)
            small = q.T @ product
            values, u = np.linalg.eigh((small + small.T) / 2)
            values, u = values[::-1], u[:, ::-1]
            q, product = q @ u, product @ u
            residual = np.linalg.norm(product - q * values, axis=0)[:wanted].max()
            if residual <= TOLERANCE * values[0] or values[0] <= 0:
                return values[:wanted], q[:, :wanted], trace
            # rounding holds the residual up: as good as double precision gets
            if residual > 0.5 * last and residual <= 50 * TOLERANCE * values[0]:
                return values[:wanted], q[:, :wanted], trace
            last = residual
            q = np.linalg.qr(_filtered(apply, q, product, values, wanted, floor))[0]
        size = min(width, 2 * size)


def _lower_edge(apply: Callable, width: int, rng: np.random.Generator, steps: int = 6) -> float:
    """Lower bound of the spectrum from a few Lanczos steps: the smallest Ritz
    value less the last residual, 0 at least (the covariance has no negative)."""
    start = rng.standard_normal(width)
    basis = [start / np.linalg.norm(start)]
    alpha, beta = [], []
    for _ in range(min(steps, width - 1)):
        w = apply(basis[-1][:, None])[0][:, 0]
        alpha.append(float(basis[-1] @ w))
        for b in basis:
            w = w - (b @ w) * b
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(abs(alpha[0]), 1e-300):
            break
        basis.append(w / beta[-1])
    beside = beta[:len(alpha) - 1]
    ritz = np.linalg.eigvalsh(np.diag(alpha) + np.diag(beside, 1) + np.diag(beside, -1))
    return max(0.0, float(ritz[0] - beta[-1]))


def _filtered(apply: Callable, q: np.ndarray, product: np.ndarray, values: np.ndarray, wanted: int,
              floor: float) -> np.ndarray:
    """Chebyshev polynomial of the matrix times ``q``: at most 1 on [floor, the
    block's smallest Ritz value], steep above.  ``product`` is the matrix times q."""
    low, high = floor, max(values[-1], floor + 1e-12 * values[0])
    centre, half = (low + high) / 2, (high - low) / 2
    reach = lambda v: math.acosh(max(1.0 + 1e-9, (v - centre) / half))
    # steep enough for ten digits at the last wanted value, and no steeper than
    # what keeps the columns apart before they are made orthonormal
    degree = max(2, min(MAX_DEGREE, math.ceil(23 / reach(values[wanted - 1])), int(60 / reach(values[0]))))
    sigma = half / (values[0] - centre) if values[0] > centre else 1.0
    first = sigma
    before, now = q, (product - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (apply(now)[0] - centre * now) * (2 * after / half) - (sigma * after) * before
        sigma = after
    return now / np.linalg.norm(now, axis=0)


def _sums(blocks: DataFrame, width: int) -> tuple[int, list[int]]:
    """Vectors and exact sums per dimension (high and low parts, so that no
    64-bit sum overflows)."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for b in batches:
            for m, data in zip(b.column("m").to_pylist(), b.column("data").to_pylist()):
                x = np.frombuffer(data, "<i8").reshape(m, width)
                n, high, low = n + m, high + (x >> 24).sum(axis=0), low + (x & 0xFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, width), pa.int32()), pa.array([n, *high.tolist()], pa.int64()),
                                          pa.array([0, *low.tolist()], pa.int64())], names=["at", "high", "low"])

    whole = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    rows = {r.at: (int(r.high), int(r.low)) for r in map_batches(blocks, parts, "at int, high long, low long").groupBy("at").agg(*whole).collect()}
    return rows.get(-1, (0, 0))[0], [(rows[i][0] << 24) + rows[i][1] if i in rows else 0 for i in range(width)]


def _reduce(blocks: DataFrame, rows: int, columns: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all blocks of ``of(x)`` (rows x columns): summed in the task,
    then by row, in the JVM."""
    width = COLUMNS
    chunks = -(-columns // width)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rows, chunks * width))
        any_ = False
        for b in batches:
            for m, data in zip(b.column("m").to_pylist(), b.column("data").to_pylist()):
                total[:, :columns] += of(np.frombuffer(data, "<i8").reshape(m, -1).astype(np.float64))
                any_ = True
        if any_:
            cells = total.reshape(rows * chunks, width)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows * chunks), pa.int64()), *[pa.array(c) for c in cells.T.copy()]],
                                             names=["slot", *[f"c{i}" for i in range(width)]])

    schema = "slot long, " + ", ".join(f"c{i} double" for i in range(width))
    found = map_batches(blocks, partial, schema).groupBy("slot").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(width)]).collect()
    out = np.zeros((rows * chunks, width))
    for r in found:
        out[r.slot] = r[1:]
    return out.reshape(rows, chunks * width)[:, :columns]


def whiten(vectors: DataFrame, model: Whitening, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error)
    per usable row and component.

    Rows whose vector is null or holds a null or non-finite entry are dropped;
    others stay, also without an id or with a repeated one, and other columns
    are not read.  A vector shorter than the longest counts as ending in zeros;
    entries beyond 2^53 after scaling count as 2^53.  deviation is exact, and
    null where it is more than a 64-bit integer holds.  Components are numbered
    from 1 by falling eigenvalue; ties of eigenvalues give any orthonormal basis
    of their space.  No component has zero variance, so a table of one distinct
    vector, like an empty one, gives no rows.
    """
    prepare(vectors.sparkSession)
    rows = integer_vectors(vectors, model.width, embedding, [vec_id])
    n, width, sums = model.n, model.width, model.sums
    r = len(model.values)
    scale = model.components / np.sqrt(model.values) if r else model.components
    explained = model.values / model.trace if r else model.values
    error = model.identity_error

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array(sums, object)
        for b in batches:
            x = unpacked(b.column("data"), width)
            m = len(x)
            if not (m and r):
                continue
            # n * x - S is whole: in 64 bits where it and its squares fit, else in Python's integers
            most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
            if width * most * most < 2**63:
                off = n * x - np.array(sums, np.int64)
                deviation = (off * off).sum(axis=1).tolist()
                centred = off / n
            else:
                off = n * x.astype(object) - exact
                deviation = [d if d < 2**63 else None for d in (off * off).sum(axis=1).tolist()]
                centred = (off / n).astype(np.float64)
            w = centred @ scale
            ids = b.column(0).take(pa.array(np.repeat(np.arange(m), r)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, r + 1, dtype=np.int32), m)), pa.array(np.full(m * r, n)),
                 pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), r))), pa.array(w.ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * r, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    id_type = vectors.select(F.col(vec_id)).schema[0].dataType.simpleString()
    return map_batches(rows, project, f"vec_id {id_type}, component int, n long, deviation long, whitened double, "
                                      "explained double, identity_error double")
