"""Embedding whitening by weighted multiplicity covariance.

Vectors become whole numbers, x = floor(scale * c) + shift, and identical x vectors are one group. The fit list has every group once (weight one) or as
often as it occurs (weight count). Sums over the list are exact; each x is centred before it is multiplied, in one matrix product per batch of groups.
Every group is whitened once and joined back to its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import attach, stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Numbers handled at a time in a task.
BLOCK = 1 << 20
#: Partial matrices are added in so many tasks before the driver adds the rest.
SLOTS = 16
#: Beyond this, floor(scale * c) is held; whole numbers of this size and sums of their halves stay exact.
LARGEST = 1 << 61
LONG = (1 << 63) - 1


def _whole(c: Column, scale: int, shift: int) -> Column:
    scaled = c.cast("double") * F.lit(float(scale))
    held = F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), scaled))
    return F.floor(held).cast("long") + F.lit(shift).cast("long")


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Runs of rows of at most BLOCK numbers, and their x as a matrix."""
    step = max(1, BLOCK // dim)
    for whole in batches:
        for lo in range(0, whole.num_rows, step):
            batch = whole.slice(lo, step)
            yield batch, np.asarray(batch.column("x").flatten(), np.int64).reshape(-1, dim)


def _partial_sums(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Weights and weighted sums per dimension of a partition, as whole numbers: the low 32 bits and the rest apart, so that no long overflows."""
    total = [0] * dim
    n = 0
    for batch, x in _blocks(batches, dim):
        w = np.asarray(batch.column("w"), np.int64)
        n += int(w.sum())
        if int(w.max()) * len(w) < 1 << 31:
            high, low = (x >> 32) * w[:, None], (x & 0xFFFFFFFF) * w[:, None]
            total = [t + (int(h) << 32) + int(v) for t, h, v in zip(total, high.sum(axis=0), low.sum(axis=0), strict=True)]
        else:
            total = [t + int(v) for t, v in zip(total, (x.astype(object) * w.astype(object)[:, None]).sum(axis=0), strict=True)]
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), pa.array([str(t) for t in total])], names=["at", "n", "s"])


class _Centre:
    """x - S/n for whole x, S and n: the whole part is subtracted exactly, the fraction after."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.whole, self.rest = n, np.array([s // n for s in sums], np.int64), [s % n for s in sums]
        self.fraction = np.array([r / n for r in self.rest])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.fraction

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - S) ** 2, exact; null where a long cannot hold it."""
        d = x - self.whole
        if float(np.abs(d).max(initial=0) + 1) ** 2 * float(self.n) ** 2 * d.shape[1] < LONG:
            off = d * self.n - np.array(self.rest, np.int64)
            return (off * off).sum(axis=1).tolist()
        off = d.astype(object) * self.n - np.array(self.rest, object)
        return [v if v <= LONG else None for v in (off * off).sum(axis=1).tolist()]


def _slot() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId() % SLOTS


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: np.ndarray | None = None
    for batch in batches:
        for blob in batch.column("m").to_pylist():
            total = np.frombuffer(blob) + (0 if total is None else total)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])


def _matrix_sum(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """The sum of the matrices (slot, m): at most SLOTS of them reach the driver."""
    rows = parts.repartition(SLOTS, "slot").mapInArrow(_added, "m binary").collect()
    return sum((np.frombuffer(bytes(r["m"])).reshape(shape) for r in rows), np.zeros(shape))


def _moments(groups: DataFrame, dim: int, centre: _Centre) -> np.ndarray:
    """Sum of w * (x - S/n) (x - S/n)^T over the groups."""

    def partial(batches):
        total = np.zeros((dim, dim))
        for batch, x in _blocks(batches, dim):
            c = centre(x)
            total += c.T @ (c * np.asarray(batch.column("w"), np.float64)[:, None])
        yield pa.RecordBatch.from_arrays([pa.array([_slot()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slot", "m"])

    return _matrix_sum(groups.select("x", "w").mapInArrow(partial, "slot int, m binary"), (dim, dim))


def _identity_error(white: DataFrame, k: int, live: np.ndarray, n: int) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity, over components with variance."""
    if not live.any():
        return 0.0

    def partial(batches):
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            y = np.nan_to_num(np.asarray(batch.column("y").flatten(), np.float64).reshape(-1, k))
            y = np.concatenate((y, np.ones((len(y), 1))), axis=1)
            total += y.T @ (y * np.asarray(batch.column("w"), np.float64)[:, None])
        yield pa.RecordBatch.from_arrays([pa.array([_slot()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slot", "m"])

    m = _matrix_sum(white.select("y", "w").mapInArrow(partial, "slot int, m binary"), (k + 1, k + 1)) / n
    cov = m[:k, :k] - np.outer(m[:k, k], m[:k, k])
    return float(np.abs(cov - np.eye(k))[np.ix_(live, live)].max())


def _whitened(groups: DataFrame, dim: int, components: int) -> DataFrame:
    """(h, x, copies, n, deviation, y, explained, identity_error) for the groups (h, x, copies, w) of one length."""
    k = min(components, dim)
    sums = groups.select("x", "w").mapInArrow(lambda b: _partial_sums(b, dim), "at int, n long, s string")
    sums = sums.groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("at").collect()  # one row per dimension
    n, centre = sums[0]["n"], _Centre(sums[0]["n"], [int(r["s"]) for r in sums])
    value, vector = np.linalg.eigh(_moments(groups, dim, centre) / n)
    value, vector = np.maximum(value[::-1], 0), vector[:, ::-1]
    trace = float(value.sum())
    value, vector = value[:k], vector[:, :k]
    vector = vector * np.where(vector[np.abs(vector).argmax(axis=0), np.arange(k)] < 0, -1, 1)
    live = value > dim * np.finfo(float).eps * max(trace, np.finfo(float).tiny)
    turn = vector[:, live] / np.sqrt(value[live])

    def projected(batches):
        for batch, x in _blocks(batches, dim):
            y = np.full((len(x), k), np.nan)
            y[:, live] = centre(x) @ turn
            flat = pa.array(y.ravel(), mask=np.tile(~live, len(x)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, k), pa.int32()), flat)
            deviation = pa.array(centre.deviation(x), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("h", "x", "copies", "w")), deviation, lists], names=["h", "x", "copies", "w", "deviation", "y"])

    white = stored(groups.mapInArrow(projected, "h long, x array<long>, copies long, w long, deviation long, y array<double>"), "whitened")
    error = _identity_error(white, k, live, n)
    share = F.array(*[F.lit(float(v / trace) if trace else 0.0) for v in value])
    return white.select("h", "x", "copies", F.lit(n).cast("long").alias("n"), "deviation", "y", share.alias("explained"), F.lit(error).alias("identity_error"))


def whiten(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", weights: str = "one", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT,
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row per sound row and component, strongest component first.

    ``weights`` is "one" (each distinct x vector counts once in the fit) or "count". Rows whose vector is null or holds null or non-finite entries are dropped;
    an empty vector has no components, so no rows. Vectors of different lengths are fitted apart. Repeated rows and rows without an id are whitened like any
    other. A component without variance (fewer distinct vectors than components, or one vector only) has a null ``whitened`` and no part in
    ``identity_error``. ``deviation`` is null where a long cannot hold it. Beyond 2^61, scaled entries are held at that bound. An empty table gives no rows.
    """
    if weights not in ("one", "count"):
        raise ValueError(f"weights must be one or count, not {weights}")
    rows = table.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"))
    sound = F.coalesce((F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    rows = rows.where(sound).select("vec_id", F.transform("v", lambda c: _whole(c, scale, shift)).alias("x")).withColumn("h", F.xxhash64("x"))
    groups = rows.groupBy("h", "x").agg(F.count(F.lit(1)).alias("copies"))
    groups = stored(groups.withColumn("w", F.lit(1).cast("long") if weights == "one" else F.col("copies")), "x-groups")
    white = None
    for (dim,) in sorted(tuple(r) for r in groups.select(F.size("x")).distinct().collect()):  # one row per length
        part = _whitened(groups.where(F.size("x") == dim), dim, components)
        white = part if white is None else white.unionByName(part)
    if white is None:
        return rows.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (("component", "int"), ("n", "long"), ("deviation", "long"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double"))]).where("false")
    total = groups.agg(F.sum("copies")).first()[0]
    back = attach(rows, white, ["h", "x"], "copies", total, F.xxhash64("vec_id"))
    spread = back.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("y", "explained")).alias("at", "of"))
    return spread.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("of.y").alias("whitened"), F.col("of.explained").alias("explained"), "identity_error")
