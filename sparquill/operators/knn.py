"""k-nearest-neighbour joins over vector columns.

Probes are packed into blocks and gallery rows into tiles, both of bounded size, inside tasks; Spark joins every tile with every
block. One block is broadcast, its size having been checked; more blocks and the tiles are shuffled. Each task keeps k rows per
probe, so what it hands on holds at most probes x tasks x k rows, whatever the gallery holds. The driver sees no vector of a search.

Methods with cells join on the cell instead: a probe is sent to the cells it visits and meets only the gallery rows there, and every gallery row is
shuffled once, however many probes there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparquill.functions.vectors import distance, normalize
from sparquill.operators.split import seeded_order
from sparquill.plans.scale import top_k
from sparquill.session import stored

METRICS = ("euclidean", "dot_product", "cosine", "minkowski")
METHODS = ("flat", "pivot", "ivf", "pq", "ivfpq", "ivfsq", "lsh", "binary", "binary_ivf")
BLOCK_BYTES = 4 << 20  # size of a block of probes or a tile of the gallery
CELLS = 2_000_000  # numbers in one distance block inside a task
CACHED = 1 << 18  # numbers in one block of a product whose pairs are looked through at once: what a core's cache holds
GROUPS = 16  # groups of columns per neighbour whose lowest pairs bound a distance block
PROBES = 256  # probes of one distance block
FIRST = 4  # a share of a tile's rows bounds the k-th key of probes that have none
PAIRS = 1_024  # pairs whose keys are computed at a time
SHORT_BITS = 12  # codes of so many bits repeat often: each is searched once
SPREAD = 4096  # tasks at most among which the tiles of one block are dealt
TRAIN_ROWS = 256  # rows per cell, at most about, on which cells are trained


# ---- blocks and tiles -----------------------------------------------------------------------


def packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One packed row per block number; the rows come ordered by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        at = batch.column("block").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
        for lo, hi in zip(edges, edges[1:]):
            if hi > lo and held and held[0].column("block")[0].as_py() != at[lo]:
                yield _block(held)
                held = []
            if hi > lo:
                held.append(batch.slice(lo, hi - lo))
    if held:
        yield _block(held)


def _block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    whole = pa.Table.from_batches(held).combine_chunks()
    rest = whole.drop_columns(["block"]).to_batches()[0]
    return pa.RecordBatch.from_arrays([whole["block"].combine_chunks().slice(0, 1).cast(pa.int32()), pa.array([packed(rest)], pa.binary())], names=["block", "probes"])


def _tiles(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Numbered tiles of at most about ``size`` bytes."""
    task, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        step = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield pa.RecordBatch.from_arrays([pa.array([(task << 32) + n]), pa.array([packed(batch.slice(at, step))], pa.binary())], names=["tile", "rows"])
            n += 1


def probe_blocks(queries: DataFrame, width: int, block_bytes: int | None = None, n: int | None = None) -> tuple[DataFrame, int]:
    """(block, probes): the query side in packed blocks of about ``block_bytes``, and how many there are (0 if no row).

    ``width`` is the size of a row in bytes; the rows are counted before they are packed, unless their number ``n`` is given.
    """
    n = queries.count() if n is None else n
    blocks = -(-n * max(1, width) // (block_bytes or BLOCK_BYTES))
    numbered = queries.select(F.pmod(F.xxhash64("query_id"), F.lit(max(1, blocks))).cast("int").alias("block"), "*")
    rows = numbered.repartition(max(1, blocks), "block").sortWithinPartitions("block")
    return rows.mapInArrow(_blocks, "block int, probes binary"), blocks


def tile_join(blocks: DataFrame, n_blocks: int, gallery: DataFrame, run: Callable, shape: str, tile_bytes: int | None = None) -> DataFrame:
    """Feeds ``run`` with rows (block, probes, rows): every block next to every tile of the gallery, ordered by block in each task."""
    size = tile_bytes or BLOCK_BYTES
    tiles = gallery.mapInArrow(lambda b: _tiles(b, size), "tile bigint, rows binary")
    if n_blocks <= 1:  # one block, of a size that the count has bounded
        joined = tiles.withColumn("block", F.lit(0)).join(F.broadcast(blocks), "block")
        return joined.select("block", "probes", "rows").mapInArrow(run, shape)
    tasks = int(gallery.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, min(SPREAD, 2 * tasks // n_blocks))
    left = tiles.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.pmod(F.xxhash64("tile"), F.lit(salts)).cast("int").alias("salt"), "rows")
    right = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "probes")
    joined = left.join(right, ["block", "salt"]).sortWithinPartitions("block")
    return joined.select("block", "probes", "rows").mapInArrow(run, shape)


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Callable, pa.RecordBatch]]:
    """(block, reader of the block's probes, tile) of every row of a tile join."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column("block")[i].as_py(), lambda i=i, batch=batch: unpacked(batch.column("probes")[i].as_py()), unpacked(batch.column("rows")[i].as_py())


# ---- distance kernels (run inside tasks) ------------------------------------------------------


def exact_keys(q: np.ndarray, g: np.ndarray, metric: str, p: float) -> np.ndarray:
    """Sort key (smaller is nearer) of row pairs, computed directly so that equal vectors tie."""
    if metric == "euclidean":
        return np.sqrt(((q - g) ** 2).sum(axis=1))
    if metric == "minkowski":
        return _power(np.abs(q - g), p).sum(axis=1) ** (1.0 / p)
    inner = (q * g).sum(axis=1)
    if metric == "dot_product":
        return -inner
    size = np.sqrt((q * q).sum(axis=1)) * np.sqrt((g * g).sum(axis=1))
    return 1.0 - np.divide(inner, size, out=np.zeros_like(inner), where=size > 0)


def _power(x: np.ndarray, p: float) -> np.ndarray:
    """x ** p, for small whole p by products, which are much faster."""
    if p not in (2, 3, 4):
        return x**p
    square = x * x
    return {2: lambda: square, 3: lambda: square * x, 4: lambda: square * square}[int(p)]()


def block_keys(q: np.ndarray, g: np.ndarray, metric: str, p: float) -> np.ndarray:
    """Sort keys of all pairs of two blocks by one matrix product (a monotone form of the distance)."""
    if metric == "minkowski":
        return np.stack([_power(np.abs(g - row), p).sum(axis=1) for row in q])
    inner = q @ g.T
    if metric == "dot_product":
        return -inner
    if metric == "cosine":
        size = np.sqrt((q * q).sum(axis=1))[:, None] * np.sqrt((g * g).sum(axis=1))[None, :]
        return 1.0 - np.divide(inner, size, out=np.zeros_like(inner), where=size > 0)
    return (q * q).sum(axis=1)[:, None] + (g * g).sum(axis=1)[None, :] - 2.0 * inner


def nearest_in_block(keys: np.ndarray, k: int, slack: float = 1e-9) -> tuple[np.ndarray, np.ndarray]:
    """(probe, column) pairs that may belong to the k best; all ties at the border are kept."""
    if keys.shape[1] > k:
        edge = np.partition(keys, k - 1, axis=1)[:, k - 1]
    else:
        edge = np.full(len(keys), np.inf)
    bound = edge + slack * (1.0 + np.abs(np.where(np.isfinite(edge), edge, 0.0)))
    return np.nonzero((keys <= bound[:, None]) & np.isfinite(keys))


def bounded(lower: np.ndarray, k: int, exact: Callable, edge: np.ndarray) -> np.ndarray:
    """``edge``, or where it is lower the largest key of the lowest pairs of k groups of columns, which the k-th key of the block cannot exceed."""
    n, columns = lower.shape
    groups = GROUPS * k
    if columns < 2 * groups:
        return edge
    width = columns // groups
    grouped = lower[:, : width * groups].reshape(n, width, groups)
    near = np.argpartition(grouped.min(axis=1), k - 1, axis=1)[:, :k]
    at = np.arange(n)[:, None]
    best = grouped[at[:, :, None], np.arange(width), near[:, :, None]].argmin(axis=2) * groups + near
    return np.minimum(edge, _chunked(exact, np.repeat(np.arange(n), k), best.ravel()).reshape(n, k).max(axis=1))


def within(lower: np.ndarray, k: int, exact: Callable, reach: Callable, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probe, column, key) of the pairs of a block that may belong to the k best, with all ties at the border.

    ``lower`` is at most a monotone form of each pair's key, ``exact(probe, column)`` the keys themselves and ``reach`` turns a key into that form. No pair beyond
    ``edge``, the k-th key known per probe, is looked at. Where none is known the block itself bounds it first.
    """
    if not np.isfinite(edge).all():
        edge = bounded(lower, k, exact, edge)
    limit = reach(edge)
    if lower.dtype == np.float32:
        with np.errstate(over="ignore"):
            limit = np.nextafter(limit.astype(np.float32), np.float32(np.inf))
    probe, column = np.divmod(np.flatnonzero(lower <= limit[:, None]), lower.shape[1])
    key = _chunked(exact, probe, column)
    kept = (key <= edge[probe]) & np.isfinite(key)
    return probe[kept], column[kept], key[kept]


def _chunked(exact: Callable, probe: np.ndarray, column: np.ndarray) -> np.ndarray:
    return np.concatenate([exact(probe[at : at + PAIRS], column[at : at + PAIRS]) for at in range(0, len(probe), PAIRS)] or [np.empty(0)])


def _in_reach(size: np.ndarray, edge: np.ndarray, sizes: np.ndarray, metric: str) -> slice:
    """The rows, ordered by their ``sizes``, that may lie within ``edge`` of a probe: sizes differ by at most the euclidean distance, and an inner product is at most the product of the sizes."""
    if metric == "cosine" or not np.isfinite(edge).all():
        return slice(0, len(sizes))
    if metric == "dot_product":
        least = np.divide(-edge, size, out=np.zeros_like(size), where=(edge < 0) & (size > 0)).min(initial=np.inf)
        return slice(int(np.searchsorted(sizes, least * (1 - 1e-6))), len(sizes))
    slack = 1e-6 * (size + edge)
    return slice(int(np.searchsorted(sizes, (size - edge - slack).min())), int(np.searchsorted(sizes, (size + edge + slack).max(), side="right")))


def near_vectors(q: np.ndarray, g: np.ndarray, k: int, metric: str, p: float, edge: np.ndarray, exact: Callable | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(probe, column, key) of the k nearest rows of ``g``, and more, by matrix products in single precision that are below the key whatever they round.

    Terms are rounded by at most ``c`` of their size, which is taken off. Vectors whose squares single precision cannot hold are compared in double precision.
    Rows and probes are ordered by size. Where no k-th key is known, the rows of the likeliest sizes bound it first; rows out of its reach by their size alone are not compared.
    ``exact`` replaces the keys by those of another function of (probe, column) that is a euclidean distance up to rounding.
    """
    d = q.shape[1]
    keys = exact or (lambda a, b: exact_keys(q[a], g[b], metric, p))
    largest = max(np.abs(q).max(initial=0.0), np.abs(g).max(initial=0.0))
    if not largest < 1e15:  # not a number included
        for part in _slices(len(g), len(q)):
            probe, column = nearest_in_block(block_keys(q, g[part], metric, p), k)
            yield probe, column + part.start, keys(probe, column + part.start)
        return
    if not len(g):
        return
    c = (d + 8) * 2.5e-7
    qq, gg = (q * q).sum(axis=1), (g * g).sum(axis=1)
    rows, probes, wide = np.argsort(gg, kind="stable"), np.argsort(qq, kind="stable"), 1.0
    ordered, gg = g[rows], gg[rows]
    size, sizes = np.sqrt(qq), np.sqrt(gg)
    one = lambda x: np.ones((len(x), 1))
    if metric == "cosine":
        unit = lambda x, xx: np.divide(x, np.sqrt(xx)[:, None], out=np.zeros_like(x), where=xx[:, None] > 0)
        left, right, reach = -unit(q, qq), unit(ordered, gg), lambda e: e - 1.0 + c
    elif metric == "dot_product":
        left, right = np.hstack([-q, -c * np.sqrt(qq)[:, None]]), np.hstack([ordered, np.sqrt(gg)[:, None]])
        reach = lambda e: e + np.where(np.isfinite(e), np.abs(e), 0.0) * 1e-6 + 1e-30
    else:  # the euclidean distance is at most ``wide`` times the other
        wide = d ** max(0.0, 0.5 - 1.0 / p) if metric == "minkowski" else 1.0
        left, right = np.hstack([-2.0 * q, one(q), (1 - c) * qq[:, None]]), np.hstack([ordered, (1 - c) * gg[:, None], one(ordered)])
        reach = lambda e: (e * wide) ** 2 * (1 + 1e-6) + 1e-30
    left, right = left.astype(np.float32), np.ascontiguousarray(right.astype(np.float32).T)
    few = max(2 * GROUPS * k, len(g) // FIRST)
    for at in range(0, len(q), PROBES):
        of = probes[at : at + PROBES]
        bound, block = edge[of], left[of]
        if few < len(g) and not np.isfinite(bound).all():
            first = len(g) - few if metric == "dot_product" else min(max(0, int(np.searchsorted(sizes, size[of[len(of) // 2]])) - few // 2), len(g) - few)
            bound = bounded(block @ right[:, first : first + few], k, lambda a, b: keys(of[a], rows[first + b]), bound)  # noqa: B023
        part = _in_reach(size[of], bound * wide, sizes, metric)
        step = max(2 * GROUPS * k, CACHED // len(of))
        for start in range(part.start, part.stop, step):
            stop = min(part.stop, start + step)
            probe, column, key = within(block @ right[:, start:stop], k, lambda a, b: keys(of[a], rows[start + b]), reach, bound)  # noqa: B023
            yield of[probe], rows[start + column], key


class Best:
    """Running k best (probe, key, id) entries, ties broken by id."""

    def __init__(self, k: int):
        self.k = k
        self.probe = np.empty(0, np.int64)
        self.key = np.empty(0, np.float64)
        self.id = np.empty(0, np.int64)

    def add(self, probe: np.ndarray, key: np.ndarray, ids: np.ndarray) -> None:
        probe = np.concatenate([self.probe, probe])
        key = np.concatenate([self.key, key])
        ids = np.concatenate([self.id, ids])
        order = np.lexsort((ids, key, probe))
        probe, key, ids = probe[order], key[order], ids[order]
        start = np.searchsorted(probe, probe, side="left")
        keep = np.arange(len(probe)) - start < self.k
        self.probe, self.key, self.id = probe[keep], key[keep], ids[keep]

    def edge(self, n: int) -> np.ndarray:
        """The k-th key of each of n probes, infinite where fewer are known."""
        out, first = np.full(n, np.inf), np.searchsorted(self.probe, np.arange(n))
        full = np.searchsorted(self.probe, np.arange(n), side="right") - first >= self.k
        out[full] = self.key[first[full] + self.k - 1]
        return out

    def add_all(self, found: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        parts = list(found)
        if parts:
            self.add(*(np.concatenate(c) for c in zip(*parts, strict=True)))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as a matrix; a wrong length fails the job."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(column) * dim:
        raise ValueError(f"vectors must have {dim} dimensions")
    return flat.reshape(len(column), dim)


Prepare = Callable[[np.ndarray], object]
Find = Callable[[object, pa.RecordBatch, np.ndarray], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def probe_stats(queries: DataFrame) -> tuple[int, int]:
    """Number and dimension of the query vectors, which must have one; 0 if there are none."""
    stats = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("d"), F.min(F.size("embedding")).alias("m")).first()
    if stats.d != stats.m:
        raise ValueError("query vectors differ in dimension")
    return stats.n, stats.d or 0


def scan(queries: DataFrame, gallery: DataFrame, prepare: Prepare, find: Find, k: int, columns: list[str]) -> DataFrame:
    """Partial top-k per task: (query_id, vec_id, key).

    ``prepare`` turns the vectors of a probe block into what ``find`` needs; ``find`` yields (probe index, key, vec_id) arrays per
    tile. It is told the k-th key that each probe has so far, and leaves out what lies beyond.
    """
    probes = queries.select("query_id", "embedding")
    n, dim = probe_stats(probes)
    blocks, n = probe_blocks(probes, 8 * dim, 4 * BLOCK_BYTES, n=n)  # the gallery is shuffled once per block
    kind = probes.schema["query_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, state, best = None, None, None, None

        def out():
            return pa.RecordBatch.from_arrays([ids.take(pa.array(best.probe)), pa.array(best.id), pa.array(best.key)], ["query_id", "vec_id", "key"])

        for block, read, tile in block_rows(batches):
            if block != at:
                if at is not None:
                    yield out()
                at, best, got = block, Best(k), read()
                ids, column = got.column("query_id"), got.column("embedding")
                flat = column.flatten().to_numpy(zero_copy_only=False)
                state = prepare(flat.astype(np.float64).reshape(len(column), -1))
            best.add_all(find(state, tile, best.edge(len(ids))))
        if at is not None:
            yield out()

    return tile_join(blocks, n, gallery.select("vec_id", *columns), run, f"query_id {kind.simpleString()}, vec_id bigint, key double")


CellsOf = Callable[[np.ndarray], list[np.ndarray]]


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Consecutive rows with equal keys, as one batch each; the rows come ordered by them."""
    held: list[pa.RecordBatch] = []
    of: tuple | None = None
    for batch in batches:
        at = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in keys], axis=1)
        edges = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(at)]
        for lo, hi in zip(edges, edges[1:]):
            if hi == lo:
                continue
            if of is not None and tuple(at[lo].tolist()) != of:
                yield of, pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            of = tuple(at[lo].tolist())
            held.append(batch.slice(lo, hi - lo))
    if of is not None:
        yield of, pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def visits(queries: DataFrame, cells_of: CellsOf, dim: int) -> DataFrame:
    """(cell, query_id, embedding): every probe once per cell that it visits."""
    kind = queries.schema["query_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            cells = cells_of(matrix(batch.column("embedding"), dim).astype(np.float64)) if batch.num_rows else []
            each = pa.array(np.repeat(np.arange(len(cells)), [len(c) for c in cells]).astype(np.int64))
            flat = np.concatenate(cells).astype(np.int32) if len(cells) else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(flat), batch.column("query_id").take(each), batch.column("embedding").take(each)], names=["cell", "query_id", "embedding"])

    return queries.select("query_id", "embedding").mapInArrow(run, f"cell int, query_id {kind}, embedding {queries.schema['embedding'].dataType.simpleString()}")


def scan_cells(queries: DataFrame, gallery: DataFrame, cells_of: CellsOf, prepare: Prepare, find: Find, k: int, columns: list[str]) -> DataFrame:
    """Partial top-k per probe and part of a cell: (query_id, vec_id, key). The gallery has a ``cell``.

    Rows and probes are counted per cell. A cell of many rows is cut into parts, and each gets the cell's probes, packed in blocks. Parts and blocks meet in
    one shuffle ordered by part: a task holds one part of a cell and one block at a time.
    """
    spark = gallery.sparkSession
    n, dim = probe_stats(queries)
    shape = f"query_id {queries.schema['query_id'].dataType.simpleString()}, vec_id bigint, key double"
    visiting = visits(queries, cells_of, dim)
    probes = {r["cell"]: r["count"] for r in visiting.groupBy("cell").count().collect()} if n else {}  # one row per cell
    wanted = gallery.filter(F.col("cell").isin(sorted(probes)))
    rows = {r["cell"]: r["count"] for r in wanted.groupBy("cell").count().collect()}
    width = 8 * max(1, dim)
    visited = sorted(rows)

    def ways(counts):
        """Number of pieces per cell, as a literal with one entry per cell."""
        of = [-(-counts[c] * width // BLOCK_BYTES) if c in rows else 0 for c in range(max(rows, default=-1) + 1)]
        return F.element_at(F.array(*[F.lit(w).cast("bigint") for w in of]), F.col("cell") + 1) if of else F.lit(1).cast("bigint")

    block = F.pmod(F.xxhash64("query_id"), ways(probes)).cast("int").alias("block")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches):
        for (cell, number), batch in _grouped(batches, ["cell", "block"]):
            yield pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), pa.array([number], pa.int32()), pa.array([packed(batch.select(["query_id", "embedding"]))], pa.binary())], names=["cell", "block", "probes"])

    blocks = visiting.filter(F.col("cell").isin(visited)).select("cell", block, "query_id", "embedding").repartition(tasks, "cell", "block").sortWithinPartitions("cell", "block")
    blocks = blocks.mapInArrow(pack, "cell int, block int, probes binary")
    blocks = blocks.select("cell", F.explode(F.sequence(F.lit(0).cast("bigint"), ways(rows) - 1)).alias("part"), F.col("block"), "probes")
    parts = wanted.select("cell", F.pmod(F.xxhash64("vec_id"), ways(rows)).alias("part"), F.lit(-1).alias("block"), "vec_id", *columns)
    both = parts.unionByName(blocks, allowMissingColumns=True).repartition(tasks, "cell", "part").sortWithinPartitions("cell", "part", "block")

    def run(batches):
        tile, of = None, None
        for (cell, part, number), batch in _grouped(batches, ["cell", "part", "block"]):
            if number < 0:
                tile, of = batch, (cell, part)
                continue
            if of != (cell, part):
                continue  # probes of a part that the hash left empty
            got, best = unpacked(batch.column("probes")[0].as_py()), Best(k)
            q = got.column("embedding").flatten().to_numpy(zero_copy_only=False)
            state = prepare(q.astype(np.float64).reshape(got.num_rows, -1))
            best.add_all(find(state, tile, best.edge(got.num_rows)))
            yield pa.RecordBatch.from_arrays([got.column("query_id").take(pa.array(best.probe)), pa.array(best.id), pa.array(best.key)], ["query_id", "vec_id", "key"])

    return both.mapInArrow(run, shape)


def _slices(n: int, q: int) -> Iterator[slice]:
    step = max(1, CELLS // max(q, 1))
    for at in range(0, n, step):
        yield slice(at, at + step)


def _merge(found: DataFrame, k: int, sign: float = 1.0) -> DataFrame:
    """Final top-k over the partial results."""
    best = top_k(found, ["query_id"], [F.col("key"), F.col("vec_id")], k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", (F.col("key") * F.lit(sign)).alias("distance"))


# ---- exact search -----------------------------------------------------------------------------


def _flat(queries, gallery, k, metric, p):
    return scan(queries, gallery, lambda vectors: vectors, _find_vectors(k, metric, p), k, ["embedding"])


# ---- cells ------------------------------------------------------------------------------------


def _centres(x: np.ndarray, nlist: int, seed: int, max_iter: int) -> np.ndarray:
    """k-means on the training rows: spread-out starts, then means until nothing moves."""
    draw = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    centres = x[draw.integers(len(x))][None]
    near = ((x - centres) ** 2).sum(axis=1)
    while len(centres) < min(nlist, len(x)):
        new = x[draw.choice(len(x), p=near / near.sum())][None]
        centres, near = np.concatenate((centres, new)), np.minimum(near, ((x - new) ** 2).sum(axis=1))
    for _ in range(max_iter):
        cell = block_keys(x, centres, "euclidean", 2.0).argmin(axis=1)
        size = np.bincount(cell, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, x)
        moved = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


def training_rows(gallery: DataFrame, rows: int, seed: int) -> np.ndarray:
    """About ``rows`` vectors chosen by hash of their id, all if there are fewer: a bounded sample for the driver, in a fixed order."""
    n = gallery.count()
    chosen = gallery.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    if n > rows:
        chosen = chosen.filter(F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(1 << 30)) < F.lit(int((1 << 30) * rows / n)))
    return np.array([r["v"] for r in sorted(chosen.collect(), key=lambda r: (r["vec_id"], r["v"]))], float)


def build_cells(gallery: DataFrame, nlist: int = 100, seed: int = 42, max_iter: int = 20, train_rows: int | None = None):
    """Clusters the gallery: (stored gallery with its ``cell``, centroid matrix of at most nlist rows).

    The centroids are fitted on about ``train_rows`` vectors (TRAIN_ROWS per cell unless given); every row gets a cell.
    """
    rows = training_rows(gallery, train_rows or TRAIN_ROWS * nlist, seed)
    if not len(rows):
        raise ValueError("an empty gallery has no cells")
    centres = _centres(rows, nlist, seed, max_iter)
    return stored(assign_cells(gallery, centres), "celled-gallery"), centres


def assign_cells(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Nearest centroid of every vector, for rows that arrive after the clustering."""
    share = rows.sparkSession.sparkContext.broadcast(np.asarray(centroids))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches):
        words = share.value
        for batch in batches:
            g = matrix(batch.column("embedding"), words.shape[1]).astype(np.float64)
            near = block_keys(g, words, "euclidean", 2.0).argmin(axis=1) if len(g) else np.empty(0)
            yield batch.append_column("cell", pa.array(near.astype(np.int32)))

    return rows.mapInArrow(run, f"{fields}, cell int")


def _probed(q: np.ndarray, centroids: np.ndarray, nprobe: int) -> np.ndarray:
    keys = block_keys(q, centroids, "euclidean", 2.0)
    return np.argsort(keys, axis=1, kind="stable")[:, :nprobe]


def _find_vectors(k: int, metric: str, p: float, encode=None) -> Find:
    """The k nearest vectors of a tile, which ``encode`` may have rounded."""
    def find(q, batch, edge):
        ids = batch.column("vec_id").to_numpy()
        g = matrix(batch.column("embedding"), q.shape[1]).astype(np.float64)
        for probe, col, key in near_vectors(q, g if encode is None else encode(g), k, metric, p, edge):
            yield probe, key, ids[col]

    return find


def _ivf(queries, gallery, k, metric, p, nlist=100, nprobe=1, seed=42, centroids=None, train_rows=None, encode=None):
    """Rows of the probed cells only; a cell column already in the gallery is used (and pruned on)."""
    if centroids is None:
        gallery, centroids = build_cells(gallery, nlist, seed, train_rows=train_rows)
    centroids = np.asarray(centroids)
    return scan_cells(queries, gallery, lambda q: list(_probed(q, centroids, nprobe)), lambda v: v, _find_vectors(k, metric, p, encode), k, ["embedding"])


# ---- exact search with pivots -------------------------------------------------------------------


def pivot_stats(celled: DataFrame, pivots: np.ndarray, k: int) -> dict[int, tuple[float, np.ndarray]]:
    """Per cell: the largest and the k smallest distances of its rows to its pivot. Cells x (k + 1) numbers reach the driver."""
    share = celled.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        cells, d = [], []
        for batch in batches:
            g = matrix(batch.column("embedding"), share.value.shape[1]).astype(np.float64)
            at = batch.column("cell").to_numpy()
            key = exact_keys(g, share.value[at], "euclidean", 2.0)
            order = np.lexsort((key, at))
            cell, key = at[order], key[order]
            nth = np.arange(len(cell)) - np.searchsorted(cell, cell)
            kept = (nth < k) | np.append(cell[1:] != cell[:-1], len(cell) > 0)
            cells, d = [*cells, cell[kept]], [*d, key[kept]]
            if sum(map(len, cells)) > CELLS:
                cells, d = _shortest(cells, d, k)
        cells, d = _shortest(cells, d, k) if cells else ([np.empty(0, np.int32)], [np.empty(0)])
        yield pa.RecordBatch.from_arrays([pa.array(cells[0].astype(np.int32)), pa.array(d[0])], names=["cell", "d"])

    rows = celled.select("cell", "embedding").mapInArrow(run, "cell int, d double")
    least = top_k(rows, ["cell"], [F.col("d")], k).groupBy("cell").agg(F.sort_array(F.collect_list("d")).alias("near"))
    most = rows.groupBy("cell").agg(F.max("d").alias("far"))
    return {r["cell"]: (r["far"], np.array(r["near"])) for r in least.join(most, "cell").collect()}


def _shortest(cells: list[np.ndarray], d: list[np.ndarray], k: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The k smallest entries of every cell and its largest."""
    cell, key = np.concatenate(cells), np.concatenate(d)
    order = np.lexsort((key, cell))
    cell, key = cell[order], key[order]
    kept = (np.arange(len(cell)) - np.searchsorted(cell, cell) < k) | np.append(cell[1:] != cell[:-1], True)
    return [cell[kept]], [key[kept]]


def needed_cells(q: np.ndarray, pivots: np.ndarray, cells: np.ndarray, far: np.ndarray, near: np.ndarray) -> list[np.ndarray]:
    """The cells that may hold one of the k nearest rows of each probe.

    By the triangle inequality a row at distance s from its pivot lies at most |q, pivot| + s from the probe: the k-th smallest of these sums bounds the k-th
    distance. A cell whose rows are all further is not needed: they lie at least |q, pivot| - far away.
    ``near`` holds the k smallest distances per cell, infinite where it has fewer rows; there are as many finite ones as neighbours to find.
    """
    out = []
    k = near.shape[1]
    at = np.sqrt(np.maximum(0, block_keys(q, pivots[cells], "euclidean", 2.0)))
    for d in at:
        sums = (d[:, None] + near).ravel()
        bound = np.partition(sums, k - 1)[k - 1] if len(sums) > k else np.inf
        out.append(cells[d - far <= bound + 1e-6 * (1.0 + np.abs(d))] if np.isfinite(bound) else cells)
    return out


def _pivot(queries, gallery, k, metric, p, pivots=64, seed=42):
    """Exact search that skips the cells which the triangle inequality rules out. Cosine is searched as the euclidean distance of unit vectors."""
    if metric not in ("euclidean", "cosine"):
        raise ValueError("pivot search needs the euclidean or the cosine metric")
    if metric == "cosine":
        unit = lambda df: df.withColumn("embedding", normalize(F.col("embedding")))
        queries, gallery = unit(queries), unit(gallery)
    rows = training_rows(gallery, TRAIN_ROWS * pivots, seed)
    if not len(rows):
        return _flat(queries, gallery, k, metric, p)
    centres = _centres(rows, pivots, seed, 5)
    celled = stored(assign_cells(gallery.select("vec_id", "embedding"), centres), "pivot-gallery")
    stats = pivot_stats(celled, centres, k)
    cells = np.array(sorted(stats))
    far = np.array([stats[c][0] for c in cells])
    near = np.stack([np.append(stats[c][1], np.full(k - len(stats[c][1]), np.inf)) for c in cells])
    if metric == "cosine":  # zero vectors are at distance 1 of everything, which is no metric: their cells and probes are always compared
        whole = np.isin(cells, [int(block_keys(np.zeros((1, centres.shape[1])), centres, "euclidean", 2.0).argmin())])
        bounds = lambda q: [c if v.any() else cells for v, c in zip(q, needed_cells(q, centres, cells, np.where(whole, np.inf, far), np.where(whole[:, None], np.inf, near)), strict=True)]
    else:
        bounds = lambda q: needed_cells(q, centres, cells, far, near)
    return scan_cells(queries, celled, bounds, lambda v: v, _find_vectors(k, metric, p), k, ["embedding"])


# ---- codes ------------------------------------------------------------------------------------


def scalar_ranges(gallery: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of every dimension."""
    dim = gallery.select(F.max(F.size("embedding"))).first()[0] or 0
    row = gallery.agg(
        *[F.min(F.col("embedding")[i]).alias(f"a{i}") for i in range(dim)],
        *[F.max(F.col("embedding")[i]).alias(f"b{i}") for i in range(dim)],
    ).first()
    return np.array(row[:dim], float), np.array(row[dim:], float)


def scalar_codec(lo: np.ndarray, hi: np.ndarray, levels: int = 255):
    """Rounds every component to one of 256 steps of its range, and back."""
    span = np.where(hi > lo, hi - lo, 1.0)

    def encode(g: np.ndarray) -> np.ndarray:
        codes = np.rint(np.clip((g - lo) / span, 0, 1) * levels)
        return lo + codes / levels * span

    return encode


def _ivfsq(queries, gallery, k, metric, p, **params):
    lo, hi = scalar_ranges(gallery)
    return _ivf(queries, gallery, k, metric, p, encode=scalar_codec(lo, hi), **params)


def _assign(g: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Nearest code word of every sub-vector: rows x m."""
    m, _, width = books.shape
    parts = g.reshape(len(g), m, width)
    return np.stack(
        [np.argmin(block_keys(parts[:, s], books[s], "euclidean", 2.0), axis=1) for s in range(m)], axis=1
    )


def train_codebooks(gallery: DataFrame, m: int = 8, bits: int = 8, rounds: int = 6, seed: int = 42, train_share: float = 1.0) -> np.ndarray:
    """Code words per sub-space, shape (m, 2^bits, dim/m), refined by distributed k-means rounds.

    A round adds up sums and counts per code word inside the tasks; the driver gets
    m x 2^bits rows. The start is a seeded choice of 2^bits vectors.
    """
    rows = gallery if train_share >= 1 else gallery.sample(False, train_share, seed)
    start = rows.select("embedding", seeded_order(seed, "vec_id").alias("o")).orderBy("o").limit(1 << bits).collect()
    first = np.array([r["embedding"] for r in start], float)
    if not len(first) or first.shape[1] % m:
        raise ValueError("the dimension must be a multiple of m")
    width = first.shape[1] // m
    books = first.reshape(len(first), m, width).transpose(1, 0, 2).copy()
    sc = gallery.sparkSession.sparkContext
    for _ in range(rounds):
        share = sc.broadcast(books)

        def sums(batches, share=share):
            words = share.value
            total = np.zeros(words.shape)
            count = np.zeros(words.shape[:2], np.int64)
            for batch in batches:
                g = matrix(batch.column("embedding"), words.shape[0] * words.shape[2]).astype(np.float64)
                codes = _assign(g, words) if len(g) else np.empty((0, len(words)), int)
                for s in range(len(words)):
                    np.add.at(total[s], codes[:, s], g.reshape(len(g), len(words), -1)[:, s])
                    count[s] += np.bincount(codes[:, s], minlength=words.shape[1])
            sub, code = np.nonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sub), pa.array(code), pa.array(count[sub, code]), pa.array(list(total[sub, code]), pa.list_(pa.float64()))],
                ["sub", "code", "n", "total"],
            )

        partial = rows.select("embedding").mapInArrow(sums, "sub bigint, code bigint, n bigint, total array<double>")
        merged = partial.groupBy("sub", "code").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(width)]).alias("total")
        )
        for r in merged.collect():  # at most m * 2^bits rows
            books[r["sub"], r["code"]] = np.array(r["total"]) / r["n"]
    return books


def pq_encode(gallery: DataFrame, books: np.ndarray) -> DataFrame:
    """Gallery with its ``code`` (one small number per sub-space) in place of the vector."""
    share = gallery.sparkSession.sparkContext.broadcast(books)
    kept = [c for c in gallery.columns if c != "embedding"]

    def run(batches):
        words = share.value
        for batch in batches:
            g = matrix(batch.column("embedding"), words.shape[0] * words.shape[2]).astype(np.float64)
            codes = _assign(g, words) if len(g) else np.empty((0, len(words)), int)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(list(codes.astype(np.int32)), pa.list_(pa.int32()))],
                [*kept, "code"],
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in gallery.select(*kept).schema)
    return gallery.mapInArrow(run, f"{fields}, code array<int>")


def _pq(queries, gallery, k, m=8, bits=8, seed=42, rounds=6, books=None, centroids=None, nprobe=1, train_share=1.0):
    """Distance of a probe to a code: a sum of m looked-up squared distances."""
    books = train_codebooks(gallery, m, bits, rounds, seed, train_share) if books is None else np.asarray(books)
    coded = gallery if "code" in gallery.columns else pq_encode(gallery, books)

    def prepare(vectors):
        q = vectors.reshape(len(vectors), books.shape[0], books.shape[2])
        return vectors, np.stack([block_keys(q[:, s], books[s], "euclidean", 2.0) for s in range(books.shape[0])])

    def find(state, batch, edge):
        q, tables = state
        ids = batch.column("vec_id").to_numpy()
        codes = matrix(batch.column("code"), len(tables))
        exact = lambda a, b: np.sqrt(np.maximum(sum(tables[s][a, codes[b, s]] for s in range(len(tables))), 0.0))
        g = np.concatenate([books[s][codes[:, s]] for s in range(len(tables))], axis=1)  # what the codes stand for
        for probe, col, key in near_vectors(q, g, k, "euclidean", 2.0, edge, exact):
            yield probe, key, ids[col]

    if centroids is None:
        return scan(queries, coded, prepare, find, k, ["code"])
    centroids = np.asarray(centroids)
    return scan_cells(queries, coded, lambda q: list(_probed(q, centroids, nprobe)), prepare, find, k, ["code"])


def _ivfpq(queries, gallery, k, nlist=100, nprobe=1, seed=42, centroids=None, train_share=1.0, train_rows=None, **params):
    if centroids is None:
        gallery, centroids = build_cells(gallery, nlist, seed, train_rows=train_rows)
    return _pq(queries, gallery, k, seed=seed, centroids=centroids, nprobe=nprobe, train_share=train_share, **params)


def hyperplanes(bits: int, dim: int, seed: int = 42) -> np.ndarray:
    """Seeded planes with components +1 and -1, taken from a hash so that any engine can rebuild them."""
    def sign(b: int, j: int) -> float:
        return 1.0 if hashlib.md5(f"{seed}-{b}-{j}".encode()).hexdigest()[0] < "8" else -1.0

    return np.array([[sign(b, j) for j in range(dim)] for b in range(bits)])


def _find_codes(k: int, bits_of: Callable[[np.ndarray], np.ndarray]) -> Find:
    """The k codes of a tile that differ in the fewest bits; ``bits_of`` derives codes from vectors. Of equal ones the lower ids are found, so a tile has k of them."""
    def find(state, batch, edge):
        dim, q = state
        ids = batch.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, g = ids[order], bits_of(matrix(batch.column("embedding"), dim).astype(np.float64))[order]
        n = len(ids)
        # number of bits and place by id in one whole number, in single precision if it holds it
        kind = np.float32 if (q.shape[1] + 1) * n < 1 << 24 else np.float64
        place = np.arange(n)
        left = np.hstack([1 - 2 * q, q.sum(axis=1)[:, None], np.ones((len(q), 1))]).astype(kind)
        right = np.ascontiguousarray(np.hstack([g * n, np.full((n, 1), n), place[:, None]]).astype(kind).T)
        step = max(1, CELLS // max(1, n))
        for at in range(0, len(q) if n else 0, step):
            keys = left[at : at + step] @ right
            known = edge[at : at + step] * n + n - 1
            probe, col, key = within(keys, k, lambda a, b, keys=keys: keys[a, b].astype(np.float64), lambda e: e, known)
            yield probe + at, np.floor_divide(key, n), ids[col]

    return find


def with_bits(rows: DataFrame, key: str, bits_of: Callable[[np.ndarray], np.ndarray], dim: int) -> DataFrame:
    """The rows (key, embedding) with their ``bits``, packed."""
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in (key, "embedding"))

    def run(batches):
        for batch in batches:
            bits = np.packbits(bits_of(matrix(batch.column("embedding"), dim).astype(np.float64)).astype(bool), axis=1) if batch.num_rows else []
            yield batch.append_column("bits", pa.array([b.tobytes() for b in bits], pa.binary()))

    return rows.select(key, "embedding").mapInArrow(run, f"{kinds}, bits binary")


def _hamming_scan(queries, gallery, k, bits_of, short=False):
    """Codes that are ``short`` are few: each is searched once, for the k lowest ids of each code, which are all that rows of equal codes can give."""
    prepare = lambda v: (v.shape[1], bits_of(v))
    if not short:
        return scan(queries, gallery, prepare, _find_codes(k, bits_of), k, ["embedding"])
    _, dim = probe_stats(queries)
    if not dim:
        return scan(queries, gallery, prepare, _find_codes(k, bits_of), k, ["embedding"])
    asked = stored(with_bits(queries, "query_id", bits_of, dim), "probe-codes")
    one = asked.groupBy(F.col("bits").alias("query_id")).agg(F.first("embedding").alias("embedding"))
    lowest = top_k(with_bits(gallery, "vec_id", bits_of, dim), ["bits"], [F.col("vec_id")], k)
    found = top_k(scan(one, lowest.select("vec_id", "embedding"), prepare, _find_codes(k, bits_of), k, ["embedding"]), ["query_id"], [F.col("key"), F.col("vec_id")], k)
    return asked.select("query_id", F.col("bits").alias("_bits")).join(found.select(F.col("query_id").alias("_bits"), "vec_id", "key"), "_bits").drop("_bits")


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairwise number of differing 0/1 components, by matrix products."""
    return a.sum(axis=1)[:, None] + b.sum(axis=1)[None, :] - 2.0 * (a @ b.T)


def _lsh(queries, gallery, k, num_bits=8, seed=42):
    dim = queries.select(F.size("embedding")).first()
    planes = hyperplanes(num_bits, dim[0] if dim else 0, seed)
    return _hamming_scan(queries, gallery, k, lambda v: (v @ planes.T >= 0).astype(np.float64), num_bits <= SHORT_BITS)


def _positive(v: np.ndarray) -> np.ndarray:
    return (v > 0).astype(np.float64)


def _binary(queries, gallery, k):
    return _hamming_scan(queries, gallery, k, _positive)


def _binary_ivf(queries, gallery, k, nlist=100, nprobe=1, seed=42):
    """Cells around a seeded choice of gallery codes, at most nlist rows on the driver."""
    heads = gallery.select("embedding", "vec_id", seeded_order(seed, "vec_id").alias("o")).orderBy("o", "vec_id").limit(nlist)
    vectors = np.array([r["embedding"] for r in heads.collect()], float)
    if not len(vectors):
        return _binary(queries, gallery, k)
    codes = _positive(vectors)

    def cell(batches):
        for batch in batches:
            g = _positive(matrix(batch.column("embedding"), vectors.shape[1]).astype(np.float64))
            near = differing(g, codes).argmin(axis=1) if len(g) else np.empty(0)
            yield batch.append_column("cell", pa.array(near.astype(np.int32)))

    celled = gallery.select("vec_id", "embedding")
    celled = stored(celled.mapInArrow(cell, f"vec_id {celled.schema['vec_id'].dataType.simpleString()}, embedding {celled.schema['embedding'].dataType.simpleString()}, cell int"), "binary-cells")
    near = lambda q: list(np.argsort(differing(_positive(q), codes), axis=1, kind="stable")[:, :nprobe])
    return scan_cells(queries, celled, near, lambda v: (v.shape[1], _positive(v)), _find_codes(k, _positive), k, ["embedding"])


# ---- public operators ---------------------------------------------------------------------------


def knn(
    queries: DataFrame, gallery: DataFrame, k: int = 5, metric: str = "euclidean", p: float = 3.0,
    method: str = "flat", squared: bool = False, refine: int = 0, **params,
) -> DataFrame:
    """k nearest gallery rows per query row: (query_id, rank, vec_id, distance).

    queries: (query_id, embedding); gallery: (vec_id, embedding[, cell, code]). Exact for
    ``flat`` and ``pivot``; the other methods trade accuracy for pruning or short codes. ``refine`` > 1
    fetches refine * k rows and ranks them by the exact distance. Ties go to the lower id.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}, choose from {', '.join(METHODS)}")
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, choose from {', '.join(METRICS)}")
    if k < 1:
        raise ValueError("k must be positive")
    if metric != "euclidean" and method in ("pq", "ivfpq", "lsh", "binary", "binary_ivf") and refine < 2:
        raise ValueError(f"{method} ranks by its own code distance; use refine for {metric}")
    wide = k * max(refine, 1)
    if method == "flat":
        found = _flat(queries, gallery, wide, metric, p)
    elif method in ("pivot", "ivf", "ivfsq"):
        run = {"pivot": _pivot, "ivf": _ivf, "ivfsq": _ivfsq}[method]
        found = run(queries, gallery, wide, metric, p, **params)
    else:
        run = {"pq": _pq, "ivfpq": _ivfpq, "lsh": _lsh, "binary": _binary, "binary_ivf": _binary_ivf}[method]
        found = run(queries, gallery, wide, **params)
    out = _merge(found, wide, -1.0 if metric == "dot_product" and method in ("flat", "ivf", "ivfsq") else 1.0)
    if refine > 1:
        out = rerank_exact(out, queries, gallery, k, metric, p)
    return out.withColumn("distance", F.col("distance") * F.col("distance")) if squared else out


def rerank_exact(found: DataFrame, queries: DataFrame, gallery: DataFrame, k: int, metric: str = "euclidean", p: float = 3.0) -> DataFrame:
    """Ranks candidate pairs by their exact distance."""
    pairs = found.select("query_id", "vec_id").join(gallery.select("vec_id", "embedding"), "vec_id")
    pairs = pairs.join(queries.select("query_id", F.col("embedding").alias("_q")), "query_id")
    scored = pairs.select("query_id", "vec_id", distance(F.col("_q"), F.col("embedding"), metric, p).alias("distance"))
    order = F.col("distance").desc() if metric == "dot_product" else F.col("distance").asc()
    best = top_k(scored, ["query_id"], [order, F.col("vec_id")], k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "distance")


def with_meta(found: DataFrame, gallery: DataFrame) -> DataFrame:
    """Adds the gallery's ``meta`` by id; rows without metadata are left out by the join."""
    return found.join(gallery.select("vec_id", "meta"), "vec_id").select("query_id", "rank", "vec_id", "distance", "meta")


def identify(probes: DataFrame, gallery: DataFrame, k: int = 5, **options) -> DataFrame:
    """One row per probe with its k results as an ordered list of metadata."""
    found = with_meta(knn(probes, gallery, k, **options), gallery)
    lists = found.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "meta"))).alias("r"))
    return lists.select(F.col("query_id").alias("probe"), F.transform("r", lambda x: x["meta"]).alias("results"))


def map_at_k(results: DataFrame, k: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Average precision per query over the hits found: results (query_id, rank, hit[, by])."""
    rows = results if k is None else results.filter(F.col("rank") <= k)
    seen = Window.partitionBy(*by, "query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    hits = rows.withColumn("_seen", F.sum(F.col("hit").cast("int")).over(seen))
    at_hit = F.when(F.col("hit"), F.col("_seen") / F.col("rank"))
    return hits.groupBy(*by, "query_id").agg(F.coalesce(F.avg(at_hit), F.lit(0.0)).alias("ap"))


def mean_ap(ap: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return ap.groupBy(*by).agg(F.avg("ap").alias("map"), F.count("*").alias("queries"))


def map_grid(results: DataFrame, ks: list[int], by: tuple[str, ...] = ()) -> DataFrame:
    """MAP for several k from one search with the largest k, per combination of ``by``."""
    rows = results.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks]))).filter(F.col("rank") <= F.col("k"))
    return mean_ap(map_at_k(rows, None, (*by, "k")), (*by, "k"))


def recall(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact neighbours that the approximate search found, per query."""
    both = exact.select("query_id", "vec_id").join(
        approx.select("query_id", "vec_id", F.lit(1).alias("found")), ["query_id", "vec_id"], "left"
    )
    return both.groupBy("query_id").agg((F.count("found") / F.count("*")).alias("recall"))


def search_metrics(log: DataFrame, gallery: DataFrame) -> DataFrame:
    """Mean query time (0 if none), number of searches and gallery size."""
    times = log.select(F.col("query_time").alias("t"), F.lit(None).cast("bigint").alias("g"))
    sizes = gallery.select(F.lit(None).cast("double").alias("t"), F.lit(1).cast("bigint").alias("g"))
    return times.unionByName(sizes).agg(
        F.coalesce(F.avg("t"), F.lit(0.0)).alias("average_query_time"),
        F.count("t").alias("total_queries"),
        F.count("g").alias("gallery_size"),
    )
