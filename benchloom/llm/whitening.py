"""Whitening of embeddings: pivoted Cholesky of the centred scatter, one-sided Jacobi on the triangular factor.

1. Entries become whole numbers, ``floor(256 * entry)``. Each different vector is sent once (equal ones are one before they are
   sent) and kept in blocks, with its exact sums, in a table of the shared folder: the fit list.
2. Tasks subtract the mean of the whole list from their blocks before they multiply; the rows of their scatters are
   added up over the cluster. Only as many rows as a vector has entries come to the driver.
3. The covariance V = G G' by Cholesky with the largest remaining pivot first, up to its numerical rank. Jacobi rotations
   make the columns of G orthogonal: their squared lengths are the eigenvalues of V, the columns over their lengths its
   eigenvectors. No product of G with itself is formed again, so small eigenvalues keep their digits.
4. A pass over the fit list measures how far the covariance of the whitened vectors is from the identity.

Rows are left out if their vector is null or empty, or holds null, NaN or an infinity. Vectors must have one length: the most
frequent one of the fit list counts (of equally frequent ones the greatest) and rows of other lengths are left out.
Entries beyond a long are its bounds. There are at most as many components as V has rank: none, hence no rows, for an
empty table or one different vector. Null keys and repeated rows stay as they are and each give their rows; only the
named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchloom.llm.columns import U64
from benchloom.llm.components import written
from benchloom.llm.ship import arrow_map, kind

COMPONENTS = 4
#: Whole numbers in a unit.
STEPS = 256
SWEEPS = 60
#: Entries of vectors worked on at once.
ENTRIES = 1 << 19
LONG = np.iinfo(np.int64)
_FORMS = {2: np.int16, 4: np.int32, 8: np.int64}


def vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, whole numbers of their vectors) for each length of the usable vectors of a column."""
    column = column.cast(pa.large_list(pa.float64()))
    n = len(column)
    there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    entries = column.values.to_numpy(zero_copy_only=False)  # null as NaN
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(entries))))
    there = there[bad[offsets[there]] == bad[offsets[there + 1]]]
    sizes = (offsets[1:] - offsets[:-1])[there]
    found = []
    for size in np.unique(sizes[sizes > 0]):
        rows = there[sizes == size]
        with np.errstate(over="ignore"):
            steps = np.floor(STEPS * entries[offsets[rows][:, None] + np.arange(size)])
        whole = np.where(steps >= 2.0**63, LONG.max, 0)
        inside = np.abs(steps) < 2.0**63
        whole[inside] = steps[inside].astype(np.int64)
        whole[steps <= -(2.0**63)] = LONG.min
        found.append((rows, whole))
    return found


def distinct_vectors(table: DataFrame, vector: str) -> DataFrame:
    """``size, width, n, sums, block``: the different vectors in blocks, entries in as few bytes as they need."""

    def pack(batches):
        for batch in batches:
            for _, whole in vectors(batch.column(vector)):
                size = whole.shape[1]
                wide = np.maximum(whole, -1 - whole).max(axis=1, initial=0)
                for width, form in _FORMS.items():
                    mine = (wide <= np.iinfo(form).max) & (wide > (np.iinfo(_FORMS[width // 2]).max if width > 2 else -1))
                    if n := int(mine.sum()):
                        offsets = pa.py_buffer(np.arange(n + 1, dtype=np.int32) * (size * width))
                        packed = pa.py_buffer(whole[mine].astype(form).tobytes())
                        yield pa.record_batch(
                            [
                                pa.array(np.full(n, size), pa.int32()),
                                pa.array(np.full(n, width), pa.int32()),
                                pa.Array.from_buffers(pa.binary(), n, [None, offsets, packed]),
                            ],
                            names=["size", "width", "vector"],
                        )

    def block(batches):
        for batch in batches:
            shape = batch.column(0).to_numpy() * 8 + batch.column(1).to_numpy() // 2
            for one in np.unique(shape):
                mine = batch.filter(pa.array(shape == one))
                size, width = mine.column(0)[0].as_py(), mine.column(1)[0].as_py()
                whole = np.frombuffer(b"".join(mine.column(2).to_pylist()), _FORMS[width]).reshape(-1, size)
                sums = whole.sum(axis=0, dtype=object if width == 8 else np.int64).tolist()
                yield pa.record_batch(
                    [
                        pa.array([size], pa.int32()),
                        pa.array([width], pa.int32()),
                        pa.array([len(whole)], pa.int64()),
                        pa.array([sums], pa.list_(pa.decimal128(38, 0))),
                        pa.array([whole.tobytes()], pa.binary()),
                    ],
                    names=["size", "width", "n", "sums", "block"],
                )

    every = arrow_map(table.select(vector), pack, "size int, width int, vector binary").distinct()
    shape = "size int, width int, n bigint, sums array<decimal(38,0)>, block binary"
    return written(arrow_map(every, block, shape), "vectors")


def _blocks(batches, size: int):
    """The vectors of blocks, a bounded number at once."""
    step = max(1, ENTRIES // max(1, size))
    for batch in batches:
        for width, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            whole = np.frombuffer(block.as_buffer(), _FORMS[width]).reshape(-1, size)
            for at in range(0, len(whole), step):
                yield whole[at : at + step]


def scatter(blocks: DataFrame, mean: np.ndarray) -> np.ndarray:
    """The sum over all vectors of (x - mean)(x - mean)'."""
    size = len(mean)

    def multiply(batches):
        total, some = np.zeros((size, size)), False
        for whole in _blocks(batches, size):
            centred = whole - mean
            total += centred.T @ centred
            some = True
        if some:
            flat = pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * size), pa.array(total.reshape(-1)))
            yield pa.record_batch([pa.array(np.arange(size), pa.int32()), flat], names=["i", "line"])

    def add(batches):
        place, total = None, None
        for batch in batches:
            for i, line in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if i != place:
                    if place is not None:
                        yield record(place, total)
                    place, total = i, np.zeros(size)
                total += line.values.to_numpy()
        if place is not None:
            yield record(place, total)

    def record(place, total):
        return pa.record_batch([pa.array([place], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["i", "line"])

    shape = "i int, line array<double>"
    parts = arrow_map(blocks.select("width", "block"), multiply, shape)
    rows = arrow_map(parts.repartition("i").sortWithinPartitions("i"), add, shape).collect()
    result = np.zeros((size, size))
    for row in rows:
        result[row.i] = row.line
    return (result + result.T) / 2


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """G with matrix = G G' but for rounding: columns by falling pivot, as many as the numerical rank. Rows taken in the
    order of the pivots form a lower triangle."""
    size = len(matrix)
    left = matrix.diagonal().copy()
    least = size * np.finfo(float).eps * left.max(initial=0.0)
    factor, done = np.zeros((size, size)), np.zeros(size, bool)
    for k in range(size):
        pivot = int(np.argmax(np.where(done, -1.0, left)))
        if done[pivot] or left[pivot] <= least:
            return factor[:, :k]
        column = (matrix[:, pivot] - factor[:, :k] @ factor[pivot, :k]) / np.sqrt(left[pivot])
        column[done] = 0.0
        column[pivot] = np.sqrt(left[pivot])
        factor[:, k] = column
        done[pivot] = True
        left = left - column * column
    return factor


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The columns rotated in pairs until all are orthogonal. Each round of a sweep turns disjoint pairs at once."""
    turned, n = factor.copy(), factor.shape[1]
    if n < 2:
        return turned
    ring, enough = list(range(n + n % 2)), np.finfo(float).eps * np.sqrt(len(factor))
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(ring) - 1):
            pairs = [(a, b) for a, b in zip(ring[: len(ring) // 2], ring[: len(ring) // 2 - 1 : -1], strict=True) if max(a, b) < n]
            one, two = (np.array(x) for x in zip(*pairs, strict=True))
            p, q = turned[:, one], turned[:, two]
            a, b, c = (p * p).sum(axis=0), (q * q).sum(axis=0), (p * q).sum(axis=0)
            size = np.sqrt(a * b)
            angle = np.divide(np.abs(c), size, out=np.zeros_like(c), where=size > 0)
            worst = max(worst, angle.max())
            turn = angle > enough
            slope = np.divide(b - a, 2 * c, out=np.zeros_like(c), where=turn)
            tangent = np.where(slope < 0, -1.0, 1.0) / (np.abs(slope) + np.hypot(1.0, slope)) * turn
            cosine = 1 / np.hypot(1.0, tangent)
            turned[:, one], turned[:, two] = cosine * (p - tangent * q), cosine * (tangent * p + q)
            ring = [ring[0], ring[-1], *ring[1:-1]]
        if worst <= enough:
            break
    return turned


@dataclass
class Whitening:
    """``components`` has one unit vector in each column, by falling eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])


def fit(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """The mean, and the first components, of the different vectors of a table."""
    blocks = distinct_vectors(table, vector)
    most = blocks.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    n, size = int(most.n), int(most["size"])
    blocks = blocks.where(F.col("size") == size)
    added = blocks.select(F.posexplode("sums").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    sums = [int(row.x) for row in sorted(added, key=lambda row: row.i)]
    model = Whitening(n, sums, np.zeros((size, 0)), np.zeros(0), 0.0, 0.0)
    covariance = scatter(blocks, model.mean) / n
    model.trace = float(covariance.trace())
    turned = one_sided_jacobi(pivoted_cholesky(covariance))
    lengths = np.sqrt((turned * turned).sum(axis=0))
    order = np.argsort(-lengths, kind="stable")[:components]
    model.components, model.eigenvalues = turned[:, order] / lengths[order], lengths[order] ** 2
    model.identity_error = identity_error(blocks, model)
    return model


def identity_error(blocks: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened vectors' covariance less the identity."""
    k = len(model.eigenvalues)
    mean, turn = model.mean, model.components / np.sqrt(model.eigenvalues)
    if not k:
        return 0.0

    def multiply(batches):
        total = np.zeros(k + k * k)
        for whole in _blocks(batches, len(mean)):
            white = (whole - mean) @ turn
            total[:k] += white.sum(axis=0)
            total[k:] += (white.T @ white).reshape(-1)
        yield pa.record_batch([pa.array(np.arange(k + k * k), pa.int32()), pa.array(total)], names=["i", "x"])

    parts = arrow_map(blocks.select("width", "block"), multiply, "i int, x double")
    total = np.zeros(k + k * k)
    for row in parts.groupBy("i").agg(F.sum("x").alias("x")).collect():
        total[row.i] = row.x / model.n
    covariance = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def deviations(whole: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over the entries of (n * x - sum)^2, exact; null where that passes a long."""
    about = ((n * whole.astype(float) - np.array(sums, float)) ** 2).sum(axis=1)
    away = whole.view(U64) * U64(n % 2**64) - np.array([s % 2**64 for s in sums], U64)
    exact = (away * away).sum(axis=1, dtype=U64).view(np.int64)  # modulo 2^64, right where the sum is less
    large = np.flatnonzero(~(about < 2.0**62))
    values = exact.astype(object)
    for i in large:
        total = sum((n * x - s) ** 2 for x, s in zip(whole[i].tolist(), sums, strict=True))
        values[i] = total if total <= LONG.max else None
    return pa.array(values.tolist() if len(large) else exact, pa.int64())


def whiten(table: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error``: a row for each vector and component."""
    k, size = len(model.eigenvalues), len(model.sums)
    mean, sums, n, error = model.mean if size else np.zeros(0), model.sums, model.n, model.identity_error
    turn = model.components / np.sqrt(model.eigenvalues)
    explained = model.eigenvalues / model.trace if k else np.zeros(0)

    def work(batches):
        for batch in batches:
            step = max(1, ENTRIES // max(1, size))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                for rows, whole in vectors(part.column(vector)):
                    if whole.shape[1] != size or not k:
                        continue
                    white = (whole - mean) @ turn
                    each = pa.array(np.repeat(np.arange(len(rows)), k))
                    count = len(rows) * k
                    yield pa.record_batch(
                        [
                            part.column(key).take(pa.array(np.repeat(rows, k))),
                            pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()),
                            pa.array(np.full(count, n), pa.int64()),
                            deviations(whole, n, sums).take(each),
                            pa.array(white.reshape(-1)),
                            pa.array(np.tile(explained, len(rows))),
                            pa.array(np.full(count, error)),
                        ],
                        names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                    )

    shape = f"{kind(table, key)}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    return arrow_map(table.select(key, vector), work, shape)
