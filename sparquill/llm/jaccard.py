"""N-gram Jaccard join: documents whose sets of 5-word shingles have a similarity of 0.75 or more, exactly.

Set relations save the work twice. Answers: copies and near copies first meet their star's leader by equal minimum hashes; a member that is linked
to its leader is in the leader's class, so no member is compared with another. Index: what can still be linked across classes is found by
an inverted index over the prefixes of the sets, in an order that puts frequent shingles last. Its lists are ordered by set size and cut into
blocks, and a block is skipped when sizes, positions in the sets or classes rule all of its pairs out. A long list is first only chained, so that what a
chain joins is one class, then what is left of it meets a few members of its largest class. Sets that are still in several classes of a long list are dealt to
blocks, and blocks with a possible pair are compared as a whole, so no pair of them is ever a row. Candidates are verified on whole texts.
Any order of the shingles gives exact results; the one used comes from counts of all shingles of all documents, in a fixed number of counters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.llm import tokens
from sparquill.llm.common import WORD, discard, partitions, stored
from sparquill.llm.graph import components

SHINGLE = 5
#: Linked if 100 * intersection >= SHARE * union, that is (100 + SHARE) * intersection >= SHARE * (size + size).
SHARE = 75
#: Minimum hashes of a document, and how many two documents must have in common to be compared in the first round.
STARS, AGREE = 6, 2
#: Counters of the shingle order: a fixed number, 4 MB when broadcast, whatever the corpus.
COUNTERS = 1 << 20
SLICES = 16
#: Index entries per task.
ENTRIES = 1_000_000
#: Candidate pairs that a task holds before it hands them on.
PAIRS = 500_000
#: Entries of a list's largest class that each entry outside it is held against before all pairs are looked at.
DRAWS = 2
#: Entries per block of a list.
BLOCK = 64
#: Shingles per block of sets that are compared with those of another block at once, about.
BLOCK_SHINGLES = 500_000
#: Index entries at least, on average, that a task hands on as one packed row.
PACK = 256
ENTRY = np.dtype([("h", "u8"), ("rid", "i8"), ("cls", "i8"), ("n", "i4"), ("pos", "i4")])


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All distinct (row, shingle) of a block, ordered by row: shingles and the bounds of the rows."""
    folded = tokens.FOLD[data]
    s, e, row = tokens.spans(folded, offsets, tokens.GAP)
    h = tokens.hashes(folded, s, e)
    rows = len(offsets) - 1
    count = np.bincount(row, minlength=rows)
    win, first = tokens.windows(h, row, SHINGLE)
    of = row[first]
    few = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(few):
        start = np.concatenate(([0], np.cumsum(count)))
        whole = np.array([_whole(h[start[i] : start[i + 1]]) for i in few], np.uint64)
        win, of = np.concatenate((win, whole)), np.concatenate((of, few))
    order = np.lexsort((win, of))
    win, of = win[order], of[order]
    new = np.ones(len(win), bool)
    new[1:] = (win[1:] != win[:-1]) | (of[1:] != of[:-1])
    return win[new], np.searchsorted(of[new], np.arange(rows + 1))


def _whole(words: np.ndarray) -> np.uint64:
    out = np.array([len(words)], np.uint64)
    for w in words:
        out = (out * tokens.STEP) ^ w
    return tokens.mixed(out)[0]


def _digest(data: np.ndarray) -> bytes:
    """Of the word sequence, A-Z lower-cased: equal for documents that differ in white space or case only."""
    return hashlib.md5(b" ".join(tokens.FOLD[data].tobytes().split())).digest()


def _profiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row: digest, set size and minimum hashes; per task: the counts of all its shingles, in slices."""
    seeds = tokens.mixed(np.arange(1, STARS + 1, dtype=np.uint64))
    counts = np.zeros(COUNTERS, np.uint32)
    names = ["doc", "sig", "digest", "n", *(f"m{i}" for i in range(STARS)), "slice", "counts"]
    for batch in batches:
        for lo, data, offsets in tokens.blocks(batch.column("text")):
            rows = len(offsets) - 1
            sets, at = shingle_sets(data, offsets)
            counts += np.bincount((sets & np.uint64(COUNTERS - 1)).view(np.int64), minlength=COUNTERS).astype(np.uint32)
            n = np.diff(at)
            mins = np.zeros((STARS, rows), np.uint64)
            full = np.flatnonzero(n)
            for i in range(STARS if len(full) else 0):
                mins[i, full] = np.minimum.reduceat(tokens.mixed(sets ^ seeds[i]), at[full])
            columns = [
                *(batch.column(k).slice(lo, rows) for k in ("doc", "sig")),
                pa.array([_digest(data[offsets[i] : offsets[i + 1]]) for i in range(rows)], pa.binary()),
                pa.array(n.astype(np.int64)), *(pa.array(m.view(np.int64)) for m in mins), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            kind = batch.schema.field("doc").type
    used = [k for k, part in enumerate(np.split(counts, SLICES)) if part.any()]
    if used:
        parts = [pa.compress(np.split(counts, SLICES)[k].tobytes(), "zstd", asbytes=True) for k in used]
        empty = [pa.nulls(len(used), t) for t in (kind, pa.int64(), pa.binary(), *[pa.int64()] * (1 + STARS))]
        yield pa.RecordBatch.from_arrays([*empty, pa.array(used, pa.int32()), pa.array(parts, pa.binary())], names=names)


def _unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, COUNTERS // SLICES * 4, "zstd"), np.uint32)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, blob in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            totals[k] = totals.get(k, 0) + _unpacked(blob)
    if totals:
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([pa.compress(np.ascontiguousarray(t).tobytes(), "zstd", asbytes=True) for t in totals.values()], pa.binary())], names=["slice", "counts"])


def _entries(batches: Iterator[pa.RecordBatch], counts: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """The prefix of every set as packed index entries (shingle, set, class, size, position), dealt by shingle."""
    for batch in batches:
        out = []
        for lo, data, offsets in tokens.blocks(batch.column("text")):
            sets, at = shingle_sets(data, offsets)
            n = np.diff(at)
            row = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((sets, counts[sets & np.uint64(COUNTERS - 1)], row))
            pos = np.arange(len(sets)) - np.repeat(at[:-1], n)
            probe = n + (-SHARE * n // 100) + 1  # size - ceil(share * size) + 1
            keep = pos < np.repeat(probe, n)
            got = np.empty(int(keep.sum()), ENTRY)
            got["h"], got["pos"], at_row = sets[order][keep], pos[keep], row[keep]
            got["n"] = n[at_row]
            for name in ("rid", "cls"):
                got[name] = batch.column(name).slice(lo, len(n)).to_numpy(zero_copy_only=False)[at_row]
            out.append(got)
        entries = np.concatenate(out) if out else np.empty(0, ENTRY)
        part = (entries["h"] >> np.uint64(32)).astype(np.int64) % parts
        order = np.lexsort((entries["h"], part))
        entries, part = entries[order], part[order]
        which, start = np.unique(part, return_index=True)
        bounds = [*start.tolist(), len(entries)]
        pieces = [entries[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(which, pa.int32()), pa.array([len(e) for e in pieces], pa.int32()), pa.array([_packed(e) for e in pieces], pa.binary())], names=["part", "n", "entries"]
        )


def _packed(e: np.ndarray) -> bytes:
    """Entries in order of the shingle, column by column, as differences where those are small."""
    columns = (np.diff(e["h"], prepend=np.uint64(0)), e["rid"], e["rid"] ^ e["cls"], e["n"], e["pos"])
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(e), -1).T.tobytes() for c in columns]  # byte by byte: equal high bytes meet
    return pa.compress(b"".join(planes), "zstd", asbytes=True)


def _entries_of(blob: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(blob, n * ENTRY.itemsize, "zstd"), np.uint8)
    out, at = np.empty(n, ENTRY), 0
    for name in ("h", "rid", "cls", "n", "pos"):
        kind = ENTRY[name]
        size = n * kind.itemsize
        out[name] = np.ascontiguousarray(raw[at : at + size].reshape(kind.itemsize, n).T).view(kind).ravel()
        at += size
    out["h"] = np.cumsum(out["h"], dtype=np.uint64)
    out["cls"] ^= out["rid"]
    return out


def least_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest intersection that links sets of these sizes."""
    return -(-SHARE * (a + b) // (100 + SHARE))


def _possible(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a shared shingle allows a link: ``a`` is the smaller set, and counts by its index prefix only."""
    need = least_overlap(a["n"].astype(np.int64), b["n"].astype(np.int64))
    index = a["n"] - least_overlap(a["n"].astype(np.int64), a["n"].astype(np.int64)) + 1
    return (a["cls"] != b["cls"]) & (100 * a["n"].astype(np.int64) >= SHARE * b["n"].astype(np.int64)) & (a["pos"] < index) & (np.minimum(a["n"] - a["pos"], b["n"] - b["pos"]) >= need)


def _listed(entries: np.ndarray, full: bool = True, unsettled: list | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs (smaller set, larger set) of all lists of some shingles.

    Unless ``full``, a list longer than a block gives a chain through its entries in a random order only, and the entries go to ``unsettled``.
    """
    if not len(entries):
        return
    e = entries[np.lexsort((entries["rid"], entries["n"], entries["h"]))]
    start = np.flatnonzero(np.concatenate(([True], e["h"][1:] != e["h"][:-1])))
    size = np.diff(np.append(start, len(e)))
    mixed = np.minimum.reduceat(e["cls"], start) != np.maximum.reduceat(e["cls"], start)  # lists within one class have nothing to tell
    short = mixed & (size <= BLOCK)
    inside = np.repeat(short, size)
    run = np.repeat(np.arange(len(start)), size)
    s, r = e[inside], run[inside]
    for d in range(1, BLOCK):
        i = np.flatnonzero(r[d:] == r[:-d]) if len(r) > d else np.zeros(0, int)
        if not len(i):
            break
        i = i[_possible(s[i], s[i + d])]
        yield s["rid"][i], s["rid"][i + d]
    long = np.flatnonzero(mixed & ~short)
    for k in long if full else ():
        blocks = [e[a : a + BLOCK] for a in range(start[k], start[k] + size[k], BLOCK)]
        blocks[-1] = blocks[-1][: start[k] + size[k] - (start[k] + (len(blocks) - 1) * BLOCK)]
        reach = [int((b["n"] - b["pos"]).max()) for b in blocks]
        one = [b["cls"][0] if (b["cls"] == b["cls"][0]).all() else None for b in blocks]
        for x, a in enumerate(blocks):
            for y in range(x, len(blocks)):
                b = blocks[y]
                if 100 * int(a["n"][-1]) < SHARE * int(b["n"][0]):
                    break  # all later blocks hold larger sets
                if min(reach[x], reach[y]) < -(-SHARE * (int(a["n"][0]) + int(b["n"][0])) // (100 + SHARE)) or (one[x] is not None and one[x] == one[y]):
                    continue
                i, j = np.triu_indices(len(a), 1) if x == y else (z.ravel() for z in np.indices((len(a), len(b))))
                ok = _possible(a[i], b[j])
                yield a["rid"][i[ok]], b["rid"][j[ok]]
    if not full and len(long):
        rest = e[np.repeat(mixed & ~short, size)]
        unsettled.append(rest)
        order = np.lexsort((tokens.mixed(rest["rid"].view(np.uint64) ^ rest["h"]), rest["h"]))
        a, b = rest[order[:-1]], rest[order[1:]]
        swap = (a["n"] > b["n"]) | ((a["n"] == b["n"]) & (a["rid"] > b["rid"]))
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        ok = (a["h"] == b["h"]) & _possible(a, b)
        yield a["rid"][ok], b["rid"][ok]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of packed entries, and the entries (a = set, h, n, pos) of long lists of several classes."""
    kept: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for part, n, blob in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "entries")), strict=True):
            kept.setdefault(part, []).append(_entries_of(blob, n))
    while kept:
        _, arrays = kept.popitem()
        unsettled: list[np.ndarray] = []
        for both in _distinct(_listed(np.concatenate(arrays), False, unsettled)):
            none = pa.nulls(both.shape[1], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1]), none, none, none], names=["a", "b", "h", "n", "pos"])
        for e in unsettled:
            columns = [np.ascontiguousarray(e[c]).astype(np.int64) if c != "h" else np.ascontiguousarray(e[c]).view(np.int64) for c in ("rid", "h", "n", "pos")]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.nulls(len(e), pa.int64()), *(pa.array(c) for c in columns[1:])], names=["a", "b", "h", "n", "pos"])


def _drawn(e: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each entry outside the largest class of its list, DRAWS pairs with entries of that class, by hash."""
    if not len(e):
        return
    e = e[np.lexsort((e["cls"], e["h"]))]
    start = np.flatnonzero(np.concatenate(([True], (e["h"][1:] != e["h"][:-1]) | (e["cls"][1:] != e["cls"][:-1]))))
    size, h = np.diff(np.append(start, len(e))), e["h"][start]
    order = np.lexsort((-size, h))  # the largest class of each list first
    first = order[np.concatenate(([True], h[order][1:] != h[order][:-1]))]
    of = np.searchsorted(h[first], e["h"])
    big, n = start[first][of], size[first][of]
    out = np.flatnonzero((np.arange(len(e)) < big) | (np.arange(len(e)) >= big + n))
    for k in range(DRAWS):
        pick = tokens.mixed(e["rid"][out].view(np.uint64) ^ e["h"][out] ^ np.uint64(k)) % n[out].astype(np.uint64)
        a, b = e[out], e[big[out] + pick.astype(np.int64)]
        swap = (a["n"] > b["n"]) | ((a["n"] == b["n"]) & (a["rid"] > b["rid"]))
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        ok = _possible(a, b)
        yield a["rid"][ok], b["rid"][ok]


def _of_lists(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """The entries (h, rid, cls, n, pos) of whole lists, and the block of each if it has one."""
    held, blocks = [np.empty(0, ENTRY)], [np.empty(0, np.int64)]
    for batch in batches:
        e = np.empty(batch.num_rows, ENTRY)
        for c in ("rid", "cls", "n", "pos"):
            e[c] = np.asarray(batch.column(c))
        e["h"] = np.asarray(batch.column("h")).view(np.uint64)
        held.append(e)
        if "block" in batch.schema.names:
            blocks.append(np.asarray(batch.column("block")))
    return np.concatenate(held), np.concatenate(blocks)


def _first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) drawn from whole lists."""
    entries, _ = _of_lists(batches)
    for both in _distinct(_drawn(entries)):
        yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (x <= y) of blocks that hold a pair of sets which whole lists still allow."""
    entries, block = _of_lists(batches)
    rid, first = np.unique(entries["rid"], return_index=True)
    of = block[first]

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for a, b in _listed(entries):
            x, y = of[np.searchsorted(rid, a)], of[np.searchsorted(rid, b)]
            met = np.unique(np.stack((np.minimum(x, y), np.maximum(x, y))), axis=1)
            yield met[0], met[1]

    seen = np.empty((2, 0), np.int64)
    for both in _distinct(pairs()):
        seen = np.unique(np.concatenate((seen, both), axis=1), axis=1)
    yield pa.RecordBatch.from_arrays([pa.array(seen[0]), pa.array(seen[1])], names=["x", "y"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) between classes, for rows (x, y, side, rid, cls, text) ordered by the pair (x, y) of blocks; a pair is held at a time."""
    held: list[pa.RecordBatch] = []
    of: tuple | None = None
    for batch in batches:
        at = np.stack([np.asarray(batch.column(c)) for c in ("x", "y")], axis=1)
        edges = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(at)]
        for lo, hi in zip(edges, edges[1:], strict=False):
            if hi == lo:
                continue
            if held and tuple(at[lo].tolist()) != of:
                yield _joined(held)
                held = []
            of = tuple(at[lo].tolist())
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """The links of one block, or of two with each other, that join classes which no link before has joined: fewer than there are sets.

    All sets of other classes are compared with a set at once, by counting its shingles in their lists.
    """
    rid, cls, side = (np.concatenate([np.asarray(b.column(c)) for b in held]) for c in ("rid", "cls", "side"))
    made = [shingle_sets(data, offsets) for b in held for _, data, offsets in tokens.blocks(b.column("text"))]
    n = np.concatenate([np.diff(at) for _, at in made])
    start = np.concatenate(([0], np.cumsum(n)))
    _, code = np.unique(np.concatenate([s for s, _ in made]), return_inverse=True)
    has = np.repeat(np.arange(len(n)), n)[np.argsort(code, kind="stable")]  # the sets of each shingle, one list after the other
    size = np.bincount(code)
    first = np.cumsum(size) - size
    two, links = side.max() > side.min(), []
    for a in np.flatnonzero(side == side.min()):
        if (cls == cls[0]).all():
            break
        mine = code[start[a] : start[a + 1]]
        many = size[mine]
        at = np.arange(many.sum()) + np.repeat(first[mine] - np.cumsum(many) + many, many)
        common = np.bincount(has[at], minlength=len(n))
        ok = (cls != cls[a]) & (common > 0) & ((100 + SHARE) * common >= SHARE * (n[a] + n)) & ((side != side[a]) | (not two))
        for b in np.flatnonzero(ok):
            if cls[b] != cls[a]:
                links.append((rid[a], rid[b]))
                cls[cls == cls[b]] = cls[a]
    pairs = np.array(links, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _distinct(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
    """The pairs without repeats, some PAIRS at a time."""
    held, n = [], 0
    for pair in pairs:
        held.append(np.stack(pair))
        n += held[-1].shape[1]
        if n >= PAIRS:
            yield np.unique(np.concatenate(held, axis=1), axis=1)
            held, n = [], 0
    if n:
        yield np.unique(np.concatenate(held, axis=1), axis=1)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps the pairs whose whole sets are similar enough."""
    for batch in batches:
        a, b = (np.asarray(batch.column(c)) for c in ("a", "b"))
        ok = np.zeros(len(a), bool)
        last, mine = None, None
        for i in range(len(a)):
            if a[i] != last:
                last, mine = a[i], _one_set(batch.column("a_text"), i)
            other = _one_set(batch.column("b_text"), i)
            common = len(np.intersect1d(mine, other, assume_unique=True))
            ok[i] = common > 0 and (100 + SHARE) * common >= SHARE * (len(mine) + len(other))
        yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], names=["a", "b"])


def _one_set(column: pa.Array, i: int) -> np.ndarray:
    data, offsets = tokens.buffers(column.slice(i, 1))
    return shingle_sets(data, offsets)[0]


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rid, text) of the wanted sets, once each."""
    same = docs["doc"].eqNullSafe(wanted["rep_doc"]) & (docs["sig"] == wanted["rep_sig"])
    return docs.join(wanted, same).groupBy("rid").agg(F.any_value("text").alias("text"))


def _links(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked."""
    pairs = stored(pairs.where("a <> b").distinct(), "pairs")
    ids = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct().withColumnRenamed("a", "rid")
    texts = stored(_texts(docs, sets.select("rid", "rep_doc", "rep_sig").join(ids, "rid", "left_semi")), "pair-texts")
    right = pairs.join(texts.select(F.col("rid").alias("b"), F.col("text").alias("b_text")), "b")
    both = right.join(texts.select(F.col("rid").alias("a"), F.col("text").alias("a_text")), "a")
    links = stored(both.select("a", "b", "a_text", "b_text").mapInArrow(_verified, "a long, b long"), "links")
    discard(texts)
    discard(pairs)
    return links


def _dealt(total: int, rows: int, partitions: int) -> tuple[int, int]:
    """Tasks of the index of sets of ``total`` shingles, and the parts that its entries are dealt to.

    A batch hands on a packed row per part, so the entries of a small index are dealt to few parts, however many partitions there are.
    """
    entries = total * (100 - SHARE) // 100
    needed = max(1, -(-entries // ENTRIES))
    tasks = max(partitions, needed)
    return tasks, min(16 * tasks, max(4 * needed, entries // (PACK * max(partitions, rows // 10_000))))


def _across(docs: DataFrame, sets: DataFrame, open_lists: DataFrame, tasks: int) -> DataFrame:
    """Links (a, b) that join all linked classes of the lists (h, rid, cls, n, pos).

    A set is dealt to the block of its list of the smallest hash, which similar sets often share; a list of many shingles has several blocks. The rows of this step are
    entries, sets once per block that theirs meets, and links: none stands for a pair of sets.
    """
    home = open_lists.groupBy("rid").agg(F.min("h").alias("home"), F.any_value("n").alias("size"))
    ways = home.groupBy("home").agg(F.ceil(F.sum("size") / BLOCK_SHINGLES).alias("ways"))
    dealt = stored(home.join(ways, "home").select("rid", F.xxhash64("home", F.pmod(F.xxhash64("rid"), "ways")).alias("block")), "set-blocks")
    lists = open_lists.join(dealt, "rid").select("h", "rid", "cls", "n", "pos", "block")
    meet = stored(lists.repartition(tasks, "h").mapInArrow(_meetings, "x long, y long").distinct(), "block-pairs")
    known = open_lists.select("rid", "cls").distinct().join(dealt, "rid")
    texts = _texts(docs, sets.select("rid", "rep_doc", "rep_sig").join(known, "rid", "left_semi")).join(known, "rid")
    texts = stored(texts.select("block", "rid", "cls", "text"), "block-texts")
    sides = meet.select("x", "y", F.col("x").alias("block"), F.lit(0).alias("side")).unionByName(meet.where("x <> y").select("x", "y", F.col("y").alias("block"), F.lit(1).alias("side")))
    rows = sides.join(texts, "block").select("x", "y", "side", "rid", "cls", "text").repartition(tasks, "x", "y").sortWithinPartitions("x", "y", "side")
    links = stored(rows.mapInArrow(_compared, "a long, b long"), "links")
    for table in (texts, meet, dealt):
        discard(table)
    return links


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, sets): rows (doc, sig, digest, n) of every input row, and one row (digest, rid, cls, rep_doc, rep_sig, n) per distinct word sequence.

    ``cls`` is the linked class of the set, by the number ``rid`` of its smallest member. Documents without words have no row in ``sets``.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("sig"), F.col(text_col).alias("text"))
    kind = docs.schema["doc"].dataType.simpleString()
    shape = f"doc {kind}, sig long, digest binary, n long, {', '.join(f'm{i} long' for i in range(STARS))}, slice int, counts binary"
    profile = stored(docs.mapInArrow(_profiled, shape), "shingle-profile")
    rows = profile.where("digest is not null").drop("slice", "counts")
    first = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "sig")).alias("rep")
    mins = [F.any_value(c).alias(c) for c in ("n", *(f"m{i}" for i in range(STARS)))]
    sets = stored(
        rows.where("n > 0").groupBy("digest").agg(first, *mins).select(F.monotonically_increasing_id().alias("rid"), "digest", F.col("rep.doc").alias("rep_doc"), F.col("rep.sig").alias("rep_sig"), "n", *(f"m{i}" for i in range(STARS))),
        "shingle-sets",
    )
    # First round: stars. A group of any size gives as many pairs as members.
    keyed = sets.select("rid", "n", F.posexplode(F.array(*[f"m{i}" for i in range(STARS)])).alias("i", "m"))
    lead = keyed.groupBy("i", "m").agg(F.min(F.struct("rid", "n")).alias("lead"), F.count(F.lit(1)).alias("members")).where("members > 1")
    lead = stored(lead.select("i", "m", "lead"), "star-leaders")  # stored, so that both sides of the join are plain shuffles, which skewed keys may split
    near = keyed.join(lead, ["i", "m"]).where(f"rid <> lead.rid and 100 * least(n, lead.n) >= {SHARE} * greatest(n, lead.n)")
    stars = near.groupBy(F.col("lead.rid").alias("a"), F.col("rid").alias("b")).agg(F.count(F.lit(1)).alias("agree")).where(F.col("agree") >= AGREE).select("a", "b")
    links = _links(docs, sets, stars)
    found = components(links)
    known = stored(sets.select("rid", "rep_doc", "rep_sig").join(found.withColumnRenamed("node", "rid"), "rid", "left").select("rid", "rep_doc", "rep_sig", F.coalesce("component", "rid").alias("cls")), "shingle-classes")
    # Second round: what the index still finds across classes.
    total, n_rows = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tasks, parts = _dealt(total, n_rows, partitions(spark))
    slices = profile.where("slice is not null").select("slice", "counts").repartition(SLICES, "slice").mapInArrow(_summed, "slice int, counts binary").collect()  # SLICES rows, COUNTERS counters
    counts = np.zeros((SLICES, COUNTERS // SLICES), np.uint32)
    for k, blob in slices:
        counts[k] = _unpacked(bytes(blob))
    shared = spark.sparkContext.broadcast(counts.reshape(-1))
    same = docs["doc"].eqNullSafe(known["rep_doc"]) & (docs["sig"] == known["rep_sig"])
    entries = docs.join(known, same).select("rid", "cls", "text").mapInArrow(lambda b: _entries(b, shared.value, parts), "part int, n int, entries binary")
    pairs = stored(entries.repartition(tasks, "part").mapInArrow(_candidates, "a long, b long, h long, n long, pos long"), "candidates")
    links = links.unionByName(_links(docs, sets, pairs.where("h is null").select("a", "b")))
    found = components(links)
    # Long lists were only chained so far. What the chains have joined is one class now; the pairs of different classes are still to be seen.
    rest = pairs.where("h is not null").select("h", F.col("a").alias("rid"), "n", "pos")
    for last in (False, True) if not rest.isEmpty() else ():
        known = found.withColumnRenamed("node", "rid").withColumnRenamed("component", "cls")
        classed = stored(rest.join(known, "rid", "left").select("h", "rid", F.coalesce("cls", "rid").alias("cls"), "n", "pos"), "classed-lists")
        several = classed.groupBy("h").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).where("a <> b").select("h")
        open_lists = stored(classed.join(several, "h", "left_semi"), "open-lists")
        if open_lists.isEmpty():
            break
        if last:
            links = links.unionByName(_across(docs, sets, open_lists, tasks))
        else:
            links = links.unionByName(_links(docs, sets, open_lists.repartition(tasks, "h").mapInArrow(_first_seen, "a long, b long")))
        found = components(links)
    return rows, sets.join(found.withColumnRenamed("node", "rid"), "rid", "left").select("digest", "rid", F.coalesce("component", "rid").alias("cls"), "rep_doc", "rep_sig", "n")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: one row per input row.

    Null and empty texts and texts without words have no shingles and are linked with nothing; their component is their own id. Rows without
    an id take part, and their component is null only if no linked row has an id. Repeated rows are linked with each other.
    """
    rows, sets = classes(docs, id_col, text_col)
    sets = stored(sets, "shingle-components")
    least = sets.groupBy("cls").agg(F.min("rep_doc").alias("least"))
    of = sets.join(least, "cls").select("digest", "least")
    out = rows.join(of, "digest", "left")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of linked documents, that of the smallest id; rows without words stay, all of them. Columns are unchanged."""
    rows, sets = classes(docs, id_col, text_col)
    best = F.min(F.struct(F.col("rep_doc").isNull().alias("none"), F.col("rep_doc").alias("doc"), F.col("rep_sig").alias("sig")))
    chosen = sets.groupBy("cls").agg(best.alias("best")).select("best.doc", "best.sig")
    text = F.coalesce(F.col(text_col), F.lit(""))
    packed = docs.where(text.rlike(WORD)).select(F.struct("*").alias("row"), F.col(id_col).alias("l_doc"), F.xxhash64(text).alias("l_sig"))
    one = packed.join(chosen, F.col("l_doc").eqNullSafe(F.col("doc")) & (F.col("l_sig") == F.col("sig")), "left_semi").groupBy("l_doc", "l_sig").agg(F.any_value("row").alias("row"))
    return one.select(*[F.col("row")[c].alias(c) for c in docs.columns]).unionByName(docs.where(~text.rlike(WORD)))
