"""Embedding near-dedup: all pairs of vectors with a cosine of at least a threshold, by tiled comparison in principal-component order.

Vectors are rotated to the principal components of all vectors and cut into blocks along the first one. Blocks whose ranges are too far apart never
meet. In a pair of blocks, tiles are compared on their leading components first; the rest of a product is at most the product of the two suffix norms, so
most pairs stop there. What is left goes on stage by stage, and ends with the cosine of the given vectors in double precision.
Equal vectors are merged before. A pair of blocks returns link counts and a spanning forest, never the pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import stored
from sparquill.llm.graph import components
from sparquill.plans.scale import with_bucket

THRESHOLD = 0.9
#: Components compared first; each later stage doubles them.
LEAD = 16
#: Vectors per block and per tile.
BLOCK, TILE = 8192, 1024
#: Safety margin of the single-precision stage, and of bounds in double precision.
LOOSE, TIGHT = 1e-4, 1e-9
SLOTS = 16


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors of a list column without nulls, in double precision."""
    flat = np.asarray(column.flatten(), np.float64).reshape(-1, dim)
    largest = np.abs(flat).max(axis=1, keepdims=True) if len(flat) else np.ones((0, 1))
    flat = flat / largest  # no overflow or underflow in the squares
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _moments(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros((dim, dim))
    for batch in batches:
        x = _matrix(batch.column("v"), dim)
        total += x.T @ x
    yield pa.RecordBatch.from_arrays([pa.array([_slot()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slot", "m"])


def _slot() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId() % SLOTS


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for blob in batch.column("m").to_pylist():
            total = np.frombuffer(blob) + (0 if total is None else total)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])


def principal_axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """Columns are the principal axes of all vectors, the strongest first; the driver gets at most SLOTS matrices of dim x dim."""
    parts = vectors.select("v").mapInArrow(lambda b: _moments(b, dim), "slot int, m binary").repartition(SLOTS, "slot").mapInArrow(_added, "m binary").collect()
    total = sum((np.frombuffer(bytes(r["m"])).reshape(dim, dim) for r in parts), np.zeros((dim, dim)))
    return np.ascontiguousarray(np.linalg.eigh(total)[1][:, ::-1])


def _tiles(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Packs consecutive vectors of one block into tiles; the rows come ordered by block."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    of = None

    def packed():
        rid, w, x = (np.concatenate(c) for c in zip(*held, strict=True))
        return pa.RecordBatch.from_arrays([pa.array([of], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in (rid, w, x))], names=["block", "rids", "ws", "xs"])

    for batch in batches:
        block, rid, w = (np.asarray(batch.column(c)) for c in ("block", "rid", "w"))
        x = _matrix(batch.column("v"), dim)
        lo = 0
        while lo < len(block):
            have = sum(len(h[0]) for h in held)
            if held and (block[lo] != of or have >= TILE):
                yield packed()
                held, have = [], 0
            of = int(block[lo])
            hi = min(int(np.searchsorted(block, of, side="right")), lo + TILE - have)
            held.append((rid[lo:hi], w[lo:hi], x[lo:hi]))
            lo = hi
    if held:
        yield packed()


def linked_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of unit vectors whose cosine reaches the threshold; of one tile with itself, each pair once."""
    dim = axes.shape[0]
    ra, rb = a @ axes, b @ axes
    left = [np.sqrt(np.maximum(0, np.cumsum((r * r)[:, ::-1], axis=1)[:, ::-1])) for r in (ra, rb)]  # norms of the suffixes
    k = min(LEAD, dim)
    rest = [s[:, k] if k < dim else np.zeros(len(s)) for s in left]
    first = [np.concatenate((r[:, :k], n[:, None]), axis=1).astype(np.float32) for r, n in zip((ra, rb), rest, strict=True)]
    i, j = np.nonzero(first[0] @ first[1].T >= np.float32(threshold - LOOSE))
    if same:
        i, j = i[i < j], j[i < j]
    at = 0
    product = np.zeros(len(i))
    while k < dim and len(i):
        product += np.einsum("ij,ij->i", ra[i, at:k], rb[j, at:k])
        on = product + left[0][i, k] * left[1][j, k] >= threshold - TIGHT
        i, j, product, at, k = i[on], j[on], product[on], k, min(dim, 2 * k)
    cosine = np.einsum("ij,ij->i", a[i], b[j])
    return i[cosine >= threshold], j[cosine >= threshold]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node of its component."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _compared(batches: Iterator[pa.RecordBatch], axes: np.ndarray, threshold: float) -> Iterator[pa.RecordBatch]:
    """(rid, links, root) of the vectors that a pair of blocks links; the rows come ordered by pair of blocks."""
    dim = axes.shape[0]

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("lo", "hi", "block", "rids", "ws", "xs")), strict=True)

    for (lo, hi), tiles in groupby(rows(), key=lambda r: r[:2]):
        tiles = [(r[2], np.frombuffer(r[3], np.int64), np.frombuffer(r[4], np.int64), np.frombuffer(r[5]).reshape(-1, dim)) for r in tiles]
        start = np.cumsum([0, *(len(t[1]) for t in tiles)])
        rid, w = (np.concatenate([t[c] for t in tiles]) for c in (1, 2))
        links, near = np.zeros(len(rid), np.int64), []
        for p, a in enumerate(tiles):
            for q in range(p, len(tiles)):
                b = tiles[q]
                if lo != hi and a[0] == b[0]:
                    continue  # compared where the block meets itself
                i, j = linked_pairs(a[3], b[3], axes, threshold, p == q)
                i, j = i + start[p], j + start[q]
                np.add.at(links, i, w[j])
                np.add.at(links, j, w[i])
                if len(i):
                    used, local = np.unique(np.concatenate((i, j)), return_inverse=True)
                    root = used[_forest(len(used), local[: len(i)], local[len(i) :])]
                    near.append(np.stack((used, root)))
        if near:
            i, j = np.concatenate(near, axis=1)
            root = _forest(len(rid), i, j)
            on = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(rid[on]), pa.array(links[on]), pa.array(rid[root[on]])], names=["rid", "links", "root"])


def _links_of(vectors: DataFrame, dim: int, n: int, threshold: float) -> DataFrame:
    """(rid, links, root) for the distinct vectors (rid, v, w) of one dimension."""
    axes = principal_axes(vectors, dim)
    lead = np.ascontiguousarray(axes[:, 0])

    def with_lead(batches):
        for batch in batches:
            first = np.clip(_matrix(batch.column("v"), dim) @ lead, -1, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first)], names=["rid", "v", "w", "lead"])

    shape = f"rid long, v {vectors.schema['v'].dataType.simpleString()}, w long, lead double"
    led = stored(vectors.select("rid", "v", "w").mapInArrow(with_lead, shape), "led-vectors")
    blocks = max(1, -(-n // BLOCK))
    cuts = led.agg(F.percentile_approx("lead", [i / blocks for i in range(1, blocks)], 100 * blocks)).first()[0] if blocks > 1 else []
    cuts = sorted(set(cuts))
    blocks = len(cuts) + 1
    tiles = stored(
        with_bucket(led, F.col("lead"), cuts, "block").repartition(blocks, "block").sortWithinPartitions("block", "lead")
        .select("block", "rid", "w", "v").mapInArrow(lambda b: _tiles(b, dim), "block int, rids binary, ws binary, xs binary"),
        "tiles",
    )
    # Unit vectors whose angles to the first axis differ by more than the threshold's angle cannot link: partners are a run of blocks.
    angles = np.arccos(np.clip([-1.0, *cuts, 1.0], -1, 1))
    reach = np.arccos(threshold) + TIGHT
    last = [max(k for k in range(b, blocks) if k == b or angles[b + 1] - angles[k] <= reach) for b in range(blocks)]
    table = tiles.sparkSession.createDataFrame([(b, int(k)) for b, k in enumerate(last)], "block int, last int")
    upper = tiles.join(table, "block")
    mine = upper.select(F.col("block").alias("lo"), F.explode(F.sequence("block", "last")).alias("hi"), "block", "rids", "ws", "xs")
    firsts = table.select(F.col("block").alias("lo"), F.explode(F.sequence("block", "last")).alias("hi")).where("lo < hi")
    theirs = tiles.join(firsts.withColumn("block", F.col("hi")), "block").select("lo", "hi", "block", "rids", "ws", "xs")
    pairs = sum(int(k) - b + 1 for b, k in enumerate(last))
    dealt = mine.unionByName(theirs).repartition(min(pairs, 20_000), "lo", "hi").sortWithinPartitions("lo", "hi", "block")
    return dealt.mapInArrow(lambda b: _compared(b, axes, threshold), "rid long, links long, root long")


def near_groups(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of different lengths; such a row is
    its own component. Every row is a vector of its own: repeated rows link with each other. Rows without an id take part; their component is null
    only if no linked row has an id, and then they are kept.
    """
    rows = table.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"))
    sound = F.coalesce(
        (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False)
    )
    distinct = stored(
        rows.where(sound).groupBy("v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("w")).select(F.monotonically_increasing_id().alias("rid"), "v", "least", "w"),
        "vectors",
    )
    found = None
    for dim, n in sorted(tuple(r) for r in distinct.groupBy(F.size("v")).agg(F.count(F.lit(1))).collect()):  # one row per length
        part = _links_of(distinct.where(F.size("v") == dim), dim, n, threshold)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = table.sparkSession.createDataFrame([], "rid long, links long, root long")
    found = stored(found, "vector-links")
    degree = found.groupBy("rid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rid").alias("a"), F.col("root").alias("b")))
    known = stored(
        distinct.join(degree, "rid", "left").join(roots.withColumnRenamed("node", "rid"), "rid", "left")
        .select("v", "least", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rid").alias("cls")),
        "vector-classes",
    )
    least = known.groupBy("cls").agg(F.min("least").alias("component_id"))
    of = known.join(least, "cls").select("v", "n_links", "component_id", F.lit(True).alias("sound"))
    out = rows.join(of, "v", "left")
    component = F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
