"""Conversation prefix trie over rebuilt conversations, by composable fingerprints.

A rebuilt conversation is the head of a base conversation and its own later turns. The fingerprint of a sequence of turns is a product in a monoid: that of x
followed by y is F(x) * B^|y| + F(y), modulo 2^64 and in two lanes. So the fingerprints of all prefixes of a rebuilt conversation follow from those of
the two original ones, and no rebuilt text is ever made: texts stay in the table, and what moves is one SHA-256 per stored turn.

A node is a group of equal (depth, fingerprint). The turns that its members refer to must all have one SHA-256; as a fingerprint and
its last turn give the fingerprint before, that check on every group proves all sequences equal. If one fails, the bases are drawn again.

The smallest member of a node owns it. A conversation that owns a node owns all its deeper ones, so its nodes are one chain, and a subtree is the union of what its
members own at that depth or below. Every number about a subtree is therefore a sum over the node's members: no walk along the tree, no round per depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import attach, n_words, partitions, stored, text_of

#: The base of a conversation is the one at the next lower multiple.
STRIDE = 20
#: Heads have fewer turns than this.
HEADS = 4
#: Bytes of joined ids in a row, at most.
BLOB = 1 << 20
NODE = ["depth", "f1", "f2"]
LANES = ("f1", "f2")
TURN = ("g1", "g2", "g3", "g4")


def bases(attempt: int) -> tuple[int, int]:
    """Two odd numbers."""
    raw = hashlib.sha256(f"prefix-trie-{attempt}".encode()).digest()
    return int.from_bytes(raw[:8]) | 1, int.from_bytes(raw[8:16]) | 1


def _powers(base: int, exponent: np.ndarray) -> np.ndarray:
    """base ** exponent modulo 2^64, for an array of exponents."""
    out, square, e = np.ones(len(exponent), np.uint64), np.uint64(base), exponent.astype(np.uint64)
    with np.errstate(over="ignore"):
        while e.any():
            out = np.where(e & np.uint64(1), out * square, out)
            square = square * square
            e = e >> np.uint64(1)
    return out


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def _unsigned(column: pa.Array) -> np.ndarray:
    return np.asarray(column).astype(np.int64).view(np.uint64)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


LOCAL = ("kind", "part", "conv_id", "first", "k", *LANES, "before", "words", *TURN)
ROW, END = 0, 1


def _scanned(batches: Iterator[pa.RecordBatch], base: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """The products of all prefixes as far as this partition of the ordered turns knows them, and one END row: its last conversation's state."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    of, first, k0, words0, state = None, None, 0, 0, [0, 0]
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        conv, words = np.asarray(batch.column("conv_id")), np.asarray(batch.column("words"))
        turn = np.frombuffer(b"".join(batch.column("digest").to_pylist()), ">u8").astype(np.uint64).reshape(n, 4)
        at = np.arange(n)
        new = np.concatenate(([conv[0] != of], conv[1:] != conv[:-1]))
        start = np.maximum.accumulate(np.where(new, at, 0))
        carried = (start == 0) & (conv[0] == of)
        k = at - start + 1 + np.where(carried, k0, 0)
        total = np.concatenate(([0], np.cumsum(words)))
        before = total[at] - total[start] + np.where(carried, words0, 0)
        lanes = []
        with np.errstate(over="ignore"):
            for lane in range(2):
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(turn[:, lane] * _powers(_inverse(base[lane]), at), dtype=np.uint64)))
                f = _powers(base[lane], at) * (sums[1:] - sums[start])
                lanes.append(f + np.where(carried, np.uint64(state[lane]) * _powers(base[lane], at - start + 1), np.uint64(0)))
        first = int(conv[0]) if first is None else first
        of, k0, words0, state = int(conv[-1]), int(k[-1]), int(before[-1] + words[-1]), [int(f[-1]) for f in lanes]
        same = [np.full(n, x, np.int64) for x in (ROW, part)]
        columns = [*same, conv, np.full(n, first, np.int64), k, *lanes, before, words, *(np.ascontiguousarray(turn[:, j]) for j in range(4))]
        yield pa.RecordBatch.from_arrays([_long(c) for c in columns], names=list(LOCAL))
    if of is not None:
        end = [END, part, of, first, k0, *state, words0, 0, 0, 0, 0, 0]
        yield pa.RecordBatch.from_arrays([_long(np.array([x % (1 << 64)], np.uint64)) for x in end], names=list(LOCAL))


def _carries(ends: list, base: tuple[int, int]) -> dict[int, tuple[int, int, int, int, int]]:
    """part -> (conversation, turns, lane 1, lane 2, words) before it, where a conversation goes on from one partition into the next."""
    out: dict = {}
    state = None
    for part, conv, first, k, f1, f2, words in ends:
        here = (conv, k, f1 % (1 << 64), f2 % (1 << 64), words)
        if state is not None and state[0] == first:
            out[part] = state
            if conv == first:
                f = [(state[2 + j] * pow(base[j], k, 1 << 64) + here[2 + j]) % (1 << 64) for j in range(2)]
                here = (conv, state[1] + k, *f, state[4] + words)
        state = here
    return out


def _prefixes(turns: DataFrame, base: tuple[int, int]) -> DataFrame:
    """(conv_id, k, f1, f2, before, words, g1..g4) per original turn: its place, the product of the turns up to it, the words before and in it, its SHA-256.

    The turns are range-partitioned by conversation and turn and scanned once; the driver combines one state per partition. So a conversation of any length is
    spread over tasks.
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    ranged = turns.repartitionByRange(partitions(turns.sparkSession), *order).sortWithinPartitions(*order)
    local = stored(ranged.mapInArrow(lambda b: _scanned(b, base), ", ".join(f"{c} long" for c in LOCAL)), "trie-local")
    ends = local.where(F.col("kind") == END).select("part", "conv_id", "first", "k", *LANES, "before").collect()  # one row per partition
    carries = _carries(sorted(tuple(r) for r in ends), base)
    names = ["conv_id", "k", *LANES, "before", "words", *TURN]

    def carried(batches):
        parts = np.array(sorted(carries), np.int64)
        table = np.array([carries[p] for p in parts.tolist()], object).reshape(-1, 5)
        convs, ks, words = (table[:, j].astype(np.int64) for j in (0, 1, 4))
        lanes = [table[:, 2 + j].astype(np.uint64) for j in range(2)]
        for batch in batches:
            part, conv, k, before = (np.asarray(batch.column(c)) for c in ("part", "conv_id", "k", "before"))
            f = [_unsigned(batch.column(c)) for c in LANES]
            if len(parts):
                at = np.minimum(np.searchsorted(parts, part), len(parts) - 1)
                on = (parts[at] == part) & (convs[at] == conv)
                with np.errstate(over="ignore"):
                    f = [x + np.where(on, lanes[j][at] * _powers(base[j], k), np.uint64(0)) for j, x in enumerate(f)]
                k, before = k + np.where(on, ks[at], 0), before + np.where(on, words[at], 0)
            kept = [batch.column(c) for c in ("words", *TURN)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), _long(k), *(_long(x) for x in f), _long(before), *kept], names=names)

    return local.where(F.col("kind") == ROW).drop("kind", "first").mapInArrow(carried, ", ".join(f"{c} long" for c in names))


def _pick(prefix: str, at: Column) -> Column:
    """The value after ``at`` turns of the head columns ``prefix0`` .. ; they hold null beyond the conversation's end."""
    return F.element_at(F.array(*[F.col(f"{prefix}{i}") for i in range(HEADS)]), at + 1)


def _rebuilt(prefixes: DataFrame, base: tuple[int, int]) -> DataFrame:
    """One row per rebuilt conversation and depth from 0: conv_id, depth, len, total, before, f1, f2, p1, p2 (the parent's), g1..g4 (its last turn)."""
    here = lambda i, c: F.max(F.when(F.col("k") == i, c))
    heads = [F.lit(0).cast("long").alias(f"{c}0") for c in (*LANES, "w", *TURN)]
    convs = prefixes.groupBy("conv_id").agg(
        F.max("k").alias("n"), F.max(F.col("before") + F.col("words")).alias("all_words"),
        *[here(i, F.col(c)).alias(f"{c}{i}") for i in range(1, HEADS) for c in (*LANES, *TURN)],
        *[here(i, F.col("before") + F.col("words")).alias(f"w{i}") for i in range(1, HEADS)],
    )
    convs = stored(convs.select("*", *heads), "trie-conversations")
    fields = [c for c in convs.columns if c not in ("conv_id", "all_words")]
    base_of = convs.select(F.col("conv_id").alias("base"), *[F.col(c).alias(f"b_{c}") for c in fields])
    id_ = F.col("conv_id")
    convs = convs.select("*", (id_ - id_ % STRIDE).alias("base"), (F.crc32(id_.cast("string").cast("binary")) % HEADS).cast("int").alias("h")).join(base_of, "base", "left")
    convs = convs.withColumn("m", F.least(F.coalesce("b_n", F.lit(0)), "h").cast("int"))
    for c in (*LANES, "w", *TURN):
        convs = convs.withColumn(f"b_{c}0", F.lit(0).cast("long"))
    own = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = convs.select(
        "*", (F.col("m") + own).alias("len"),
        (_pick("b_w", F.col("m")) + F.when(own > 0, F.col("all_words") - _pick("w", F.col("h"))).otherwise(0)).alias("total"),
    )
    d = F.col("d")
    previous = F.greatest(d - 1, F.lit(0))
    tops = convs.select("*", F.explode(F.sequence(F.lit(0), "m")).alias("d")).select(
        "conv_id", d.cast("long").alias("depth"), "len", "total", _pick("b_w", previous).alias("before"), *[_pick(f"b_{c}", d).alias(c) for c in LANES],
        *[_pick(f"b_{c}", previous).alias(p) for c, p in zip(LANES, ("p1", "p2"), strict=True)], *[_pick(f"b_{c}", d).alias(c) for c in TURN],
    )
    scalars = convs.where(F.col("n") > F.col("h")).select(
        "conv_id", "n", "h", "m", "len", "total", _pick("b_w", F.col("m")).alias("bw"), _pick("w", F.col("h")).alias("cw"),
        *[_pick(f"b_{c}", F.col("m")).alias(f"b{c}") for c in LANES], *[_pick(c, F.col("h")).alias(f"c{c}") for c in LANES],
    )
    turns = convs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    joined = attach(prefixes, scalars, ["conv_id"], "n", turns, F.xxhash64("conv_id", "k")).where(F.col("k") > F.col("h"))

    names = tops.columns

    def composed(batches):
        for batch in batches:
            k, h, m, before, bw, cw = (np.asarray(batch.column(c)).astype(np.int64) for c in ("k", "h", "m", "before", "bw", "cw"))
            f, p = [], []
            with np.errstate(over="ignore"):
                for j, lane in enumerate(LANES):
                    shift = _powers(base[j], k - h)
                    own_suffix = _unsigned(batch.column(lane)) - _unsigned(batch.column(f"c{lane}")) * shift
                    f.append(_unsigned(batch.column(f"b{lane}")) * shift + own_suffix)
                    p.append((f[j] - _unsigned(batch.column(TURN[j]))) * np.uint64(_inverse(base[j])))
            made = [_long(m + k - h), batch.column("len"), batch.column("total"), _long(bw + before - cw), *map(_long, f), *map(_long, p)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *made, *(batch.column(c) for c in TURN)], names=names)

    rest = joined.select("conv_id", "k", F.col("h").cast("long"), F.col("m").cast("long"), F.col("len").cast("long"), "total", "before", "bw", "cw", *LANES, *[f"b{c}" for c in LANES], *[f"c{c}" for c in LANES], *TURN)
    return tops.withColumn("len", F.col("len").cast("long")).unionByName(rest.mapInArrow(composed, ", ".join(f"{c} long" for c in names)))


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node, joined by commas, in rows of at most BLOB bytes; the rows come ordered by node and id."""
    names = [*NODE, "at", "ids"]
    of, at, held, size = None, 0, [], 0

    def packed():
        return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in (*of, at)), pa.array([",".join(held)])], names=names)

    for batch in batches:
        for *node, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id")), strict=True):
            if node != of or size >= BLOB:
                if held:
                    yield packed()
                of, at, held, size = node, conv, [], 0
            held.append(str(conv))
            size += len(held[-1]) + 1
    if held:
        yield packed()


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's joined ids, a row at a time; the rows come ordered by node and first id."""
    of, state = None, None
    names = [*NODE, "ends_sha256"]

    def done(rows):
        return pa.RecordBatch.from_arrays([*(pa.array([r[j] for r in rows], pa.int64()) for j in range(3)), pa.array([r[3] for r in rows], pa.string())], names=names)

    for batch in batches:
        out = []
        for *node, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
            if node == of:
                state.update(b",")
            else:
                if of is not None:
                    out.append((*of, state.hexdigest()))
                of, state = node, hashlib.sha256()
            state.update(ids.encode())
        yield done(out)
    if of is not None:
        yield done([(*of, state.hexdigest())])


def _ends(members: DataFrame) -> DataFrame:
    """The nodes where conversations end and the SHA-256 of their ids. The sort is spread by node and id; only joined ids meet in one task, as a stream."""
    n = partitions(members.sparkSession)
    ids = members.where(F.col("depth") == F.col("len")).select(*NODE, "conv_id")
    sorted_ids = ids.repartitionByRange(n, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    blobs = sorted_ids.mapInArrow(_joined_ids, "depth long, f1 long, f2 long, at long, ids string")
    return blobs.repartition(n, *NODE).sortWithinPartitions(*NODE, "at").mapInArrow(_hashed_ids, "depth long, f1 long, f2 long, ends_sha256 string")


def trie(table: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row per node.

    Null roles and texts are empty; null turns come first; equal turns of a conversation are ordered by the SHA-256 of role and text, and repeated rows
    are turns of their own. Rows without a conversation are left out, also as bases. An empty table has no nodes.
    """
    role, text = text_of(role_col), text_of(text_col)
    said = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)  # no other pair gives the same
    turns = table.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.unhex(F.sha2(said, 256)).alias("digest"), n_words(text).alias("words")
    )
    attempt = 0
    while True:
        base = bases(attempt)
        members = stored(_rebuilt(_prefixes(turns, base), base), "trie-members")
        nodes = members.groupBy(*NODE).agg(
            F.min("conv_id").alias("owner"), F.max("len").alias("deepest"), F.min("before").alias("before"),
            reduce(lambda a, b: a | b, [F.min(g) != F.max(g) for g in TURN]).alias("mixed"),
        )
        nodes = stored(nodes, "trie-nodes")
        if nodes.where("mixed").limit(1).count() == 0:
            break
        attempt += 1  # two sequences with one fingerprint
    chains = nodes.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min("depth").alias("top"), (F.max("depth") + 1).alias("n"), F.max((F.col("deepest") == F.col("depth")).cast("long")).alias("leaf"), F.min("before").alias("stop"),
    )
    rows = members.count()
    each = attach(members, stored(chains, "trie-chains"), ["conv_id"], "n", rows, F.xxhash64("conv_id", "depth"))
    top, stop = F.coalesce("top", F.col("len") + 1), F.coalesce("stop", "total")
    below = F.col("depth") + 1
    nodes = each.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.count(F.lit(1)).alias("n_convs"),
        F.sum(((top <= below) & (below <= F.col("len"))).cast("long")).alias("n_children"), F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"),
        F.sum(F.greatest(stop - F.col("before"), F.lit(0))).alias("saved_tokens"), F.max(top == F.col("depth")).alias("is_top"),
    )
    nodes = stored(nodes, "trie-sums")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("conv_id").alias("above"), "n_children")
    children = nodes.where("depth > 0").count()
    found = attach(nodes.drop("n_children").where("is_top and depth > 0"), parents, ["depth", "p1", "p2"], "n_children", children, F.xxhash64("f1", "f2"))
    above = found.select(*NODE, "above")
    out = nodes.join(above, NODE, "left").join(_ends(members), NODE, "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("above", "conv_id"))
    return out.select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
