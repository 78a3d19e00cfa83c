"""Ranking over a shared corpus by an inverted index in blocks.

The corpus is cut into segments of bounded size. A segment holds, per word, the list of its candidates with their counts, the largest weight that the word
gives any of them, and the smallest of them. Segments are stored as Parquet and read by any number of searches.

A question meets a segment word by word. The largest weights bound what a candidate can still score: words whose bounds together stay below the k-th score found so
far cannot make a candidate, so only lists of the others are read in full, and these words are looked up for the candidates alone. A segment whose bounds all stay
below is skipped. Rows are the same as if every pair were scored.

Euclidean and manhattan distances have no such bounds, as candidates without a shared word may be near: all candidates of a segment get their distance, at the cost of
the lists of the question's words and a few sums per candidate.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.functions.text import STOP_WORDS, terms
from sparquill.operators.knn import Best, block_rows, tile_join
from sparquill.plans.scale import top_k
from sparquill.session import stored

DIGITS = 12  # scores are rounded so that equal texts tie whatever the order of summation
SEGMENT_WORDS = 1_000_000  # words of a segment, or one candidate
SLACK = 1e-9  # bounds are sums of rounded numbers
INDEX = "tile bigint, texts bigint, first array<bigint>, ids binary, sizes binary, words array<string>, ptr binary, docs binary, tf binary"
SEARCHED = INDEX + ", df binary, base binary, total binary, bound binary, least binary"


@dataclass
class Index:
    """The stored segments, how many candidates they hold, the number of candidates per term, and the ids that come first."""

    table: DataFrame
    terms: DataFrame
    n: int
    first_ids: list[int]


def _pack(x: np.ndarray, kind) -> pa.Array:
    return pa.array([np.ascontiguousarray(x, kind).tobytes()], pa.binary())


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Runs of candidates with at most ``most`` words, or one candidate, whatever the batches they come in. A candidate without words counts as one."""
    held, words = [], 0
    for batch in batches:
        length = pc.list_value_length(batch.column("words")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(np.maximum(length, 1))
        lo = 0
        while lo < batch.num_rows:
            before = int(ends[lo - 1]) if lo else 0
            hi = int(np.searchsorted(ends, before + most - words, side="right"))
            if hi <= lo and not held:
                hi = lo + 1
            if hi > lo:
                held.append(batch.slice(lo, hi - lo))
                words += int(ends[hi - 1]) - before
                lo = hi
            if lo < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, words = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _segments(batches: Iterator[pa.RecordBatch], first: int, most: int = SEGMENT_WORDS) -> Iterator[pa.RecordBatch]:
    """Lists per word of runs of candidates; also how many have a text, and the ``first`` ids."""
    task = TaskContext.get().partitionId()
    for made, batch in enumerate(_runs(batches, most)):
        lists = batch.column("words")
        length = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten().dictionary_encode()
        word, n = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), batch.num_rows
        key, tf = np.unique(word * n + np.repeat(np.arange(n), length), return_counts=True)
        of, docs = key // n, key % n
        ptr = np.searchsorted(of, np.arange(len(flat.dictionary) + 1))
        words = pa.ListArray.from_arrays(pa.array([0, len(flat.dictionary)], pa.int32()), flat.dictionary.cast(pa.string()))
        sizes = np.bincount(docs, minlength=n)
        ids = np.sort(batch.column("cand_id").to_numpy())[:first]
        head = [pa.array([(task << 32) + made]), pa.array([n - lists.null_count]), pa.array([ids.tolist()], pa.list_(pa.int64()))]
        columns = [*head, _pack(batch.column("cand_id").to_numpy(), np.int64), _pack(sizes, np.int32), words, _pack(ptr, np.int64), _pack(docs, np.int32), _pack(tf, np.int32)]
        yield pa.RecordBatch.from_arrays(columns, names=["tile", "texts", "first", "ids", "sizes", "words", "ptr", "docs", "tf"])


def idf(n: int, df: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed idf of terms over the corpus and one question: where the question has the term, and where it has not."""
    return np.log((2 + n) / (2 + df)) + 1, np.log((2 + n) / (1 + df)) + 1


def _weighted(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Adds what a search needs: per candidate the sums of its squared and of its plain weights for a foreign question, and per word the bounds. df is 0 for words without a weight."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("ids", "sizes", "ptr", "docs", "tf")}
            sizes, ptr = np.frombuffer(row["sizes"], np.int32), np.frombuffer(row["ptr"], np.int64)
            docs, tf = np.frombuffer(row["docs"], np.int32), np.frombuffer(row["tf"], np.int32)
            df = np.asarray(batch.column("dfs")[i].values, np.int64)
            weighs = np.repeat(df > 0, np.diff(ptr))
            own, foreign = (np.repeat(x, np.diff(ptr)) * weighs for x in idf(n, df))
            base, total = np.bincount(docs, (tf * foreign) ** 2, len(sizes)), np.bincount(docs, tf * foreign, len(sizes))
            least_norm = np.sqrt(np.bincount(docs, (tf * own) ** 2, len(sizes)))  # no question makes the norm smaller
            share = np.divide(tf * own, least_norm[docs], out=np.zeros(len(docs)), where=least_norm[docs] > 0)
            bound = np.maximum.reduceat(share, ptr[:-1]) if len(ptr) > 1 else np.zeros(0)
            least = np.minimum.reduceat(sizes[docs], ptr[:-1]) if len(ptr) > 1 else np.zeros(0)
            one = batch.slice(i, 1)
            extra = [_pack(df, np.int64), _pack(base, float), _pack(total, float), _pack(bound, float), _pack(least, np.int32)]
            kept = [c for c in batch.schema.names if c != "dfs"]
            yield pa.RecordBatch.from_arrays([*(one.column(c) for c in kept), *extra], names=[*kept, "df", "base", "total", "bound", "least"])


def build(candidates: DataFrame, stop_words: list[str] | None = None, first: int = 100, segment_words: int = SEGMENT_WORDS) -> Index:
    """Index over (cand_id, text): every word, of which stop words have no TF-IDF weight."""
    stop = frozenset(STOP_WORDS if stop_words is None else stop_words)
    raw = stored(candidates.select("cand_id", terms("text", []).alias("words")).mapInArrow(lambda b: _segments(b, first, segment_words), INDEX), "segments")
    lists = raw.select("tile", "words", "ptr").mapInArrow(_list_lengths, "tile bigint, at int, term string, n bigint")
    weighed = lists.filter(~F.col("term").isin(*stop)) if stop else lists
    df = stored(weighed.groupBy("term").agg(F.sum("n").alias("df")), "document-counts")
    known = lists.join(df, "term", "left")
    placed = known.select("tile", "at", F.coalesce("df", F.lit(0)).cast("bigint").alias("df")).repartition("tile").sortWithinPartitions("tile", "at")
    by_tile = placed.select("tile", "df").mapInArrow(_by_tile, "tile bigint, dfs array<bigint>")
    n = raw.agg(F.coalesce(F.sum("texts"), F.lit(0))).first()[0]
    none = F.array().cast("array<bigint>")
    joined = raw.join(by_tile, "tile", "left").withColumn("dfs", F.coalesce("dfs", none))
    table = stored(joined.mapInArrow(lambda b: _weighted(b, n), SEARCHED), "index")
    ids = [r["id"] for r in raw.select(F.explode("first").alias("id")).orderBy("id").limit(first).collect()]
    return Index(table, df, n, ids)


def _by_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of each segment's words as one row; the rows come ordered by segment and word."""
    of, held = None, []

    def row():
        counts = np.concatenate(held)
        lists = pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.array(counts, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([of], pa.int64()), lists], names=["tile", "dfs"])

    for batch in batches:
        tile, df = batch.column("tile").to_numpy(), batch.column("df").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(tile)) + 1).tolist(), len(tile)]
        for lo, hi in zip(edges, edges[1:]):
            if hi > lo:
                if held and tile[lo] != of:
                    yield row()
                    held = []
                of = int(tile[lo])
                held.append(df[lo:hi])
    if held:
        yield row()


def _list_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            words = batch.column("words")[i].values
            n = np.diff(np.frombuffer(batch.column("ptr")[i].as_py(), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), batch.column("tile")[i].as_py())), pa.array(np.arange(len(n)), pa.int32()), words, pa.array(n)], names=["tile", "at", "term", "n"])


# ---- search -----------------------------------------------------------------------------------------


@dataclass
class Question:
    """Distinct words by their number in the block's list: unit TF-IDF weight (0 for stop words), and both idf."""

    word: np.ndarray
    unit: np.ndarray
    own: np.ndarray
    foreign: np.ndarray


@dataclass
class Segment:
    ids: np.ndarray
    sizes: np.ndarray
    ptr: np.ndarray
    docs: np.ndarray
    tf: np.ndarray
    df: np.ndarray
    base: np.ndarray
    total: np.ndarray
    bound: np.ndarray
    least: np.ndarray


_KINDS = dict(ids=np.int64, sizes=np.int32, ptr=np.int64, docs=np.int32, tf=np.int32, df=np.int64, base=float, total=float, bound=float, least=np.int32)


def _questions(block: pa.RecordBatch, n: int) -> tuple[pa.Array, list[Question]]:
    """The distinct words of a block of questions and each question's own."""
    df = dict(zip(block.column("known").flatten().to_pylist(), block.column("df").flatten().to_pylist()))
    lists = block.column("words").to_pylist()
    names = sorted({w for words in lists for w in words})
    at = {w: i for i, w in enumerate(names)}
    out = []
    for words, weighed in zip(lists, block.column("terms").to_pylist()):
        mine = sorted(set(words))
        tf = np.array([weighed.count(w) for w in mine], float)
        own, foreign = idf(n, np.array([df.get(w, 0) for w in mine], float))
        weight = tf * own
        norm = np.sqrt((weight**2).sum())
        out.append(Question(np.array([at[w] for w in mine], np.int64), weight / norm if norm > 0 else weight, own, foreign))
    return pa.array(names, pa.string()), out


def evaluate(q: Question, place: np.ndarray, s: Segment, tfidf: float, overlap: float, least_score: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(candidates, cosine, shared-word score, list entries read): all candidates of a segment that may reach ``least_score`` = tfidf * cosine + overlap * F1.

    ``place`` is where the segment keeps each of the question's words, -1 where it has none.
    """
    here = np.flatnonzero(place >= 0)
    at = place[here]
    if not len(at):
        return np.empty(0, np.int64), np.empty(0), np.empty(0), 0
    reach = tfidf * q.unit[here] * s.bound[at] + overlap * 2.0 / (len(q.word) + s.least[at])
    order = np.argsort(reach, kind="stable")
    out = int(np.searchsorted(np.cumsum(reach[order]), least_score - SLACK, side="left"))
    lo, length, n = s.ptr[at], s.ptr[at + 1] - s.ptr[at], len(s.sizes)
    if out == len(order):
        return np.empty(0, np.int64), np.empty(0), np.empty(0), 0
    rest = order[:out]
    docs, tf, word = _entries(s, lo, length, order[out:])
    found = wanted = None
    read = len(docs)
    if out:
        wanted = np.zeros(n, bool)
        wanted[docs] = True
        found = np.flatnonzero(wanted)
        parts = [(docs, tf, word), _entries(s, lo, length, rest[length[rest] <= len(found)])]
        read += len(parts[1][0])
        for j in rest[length[rest] > len(found)]:
            listed = s.docs[lo[j] : lo[j] + length[j]]
            place_in = np.minimum(np.searchsorted(listed, found), len(listed) - 1)
            place_in = place_in[listed[place_in] == found]
            read += len(found)
            parts.append((listed[place_in], s.tf[lo[j] + place_in], np.full(len(place_in), j)))
        docs, tf, word = (np.concatenate(c) for c in zip(*parts, strict=True))
    shared = np.bincount(docs, minlength=n)
    if found is None:
        found = np.flatnonzero(shared)
    own, foreign, unit = q.own[here], q.foreign[here], q.unit[here]
    dot = np.bincount(docs, tf * (own * unit)[word], n)
    less = np.bincount(docs, tf.astype(float) ** 2 * np.where(unit > 0, own**2 - foreign**2, 0.0)[word], n)
    norm = np.sqrt(np.maximum(s.base[found] + less[found], 0.0))
    cosine = np.divide(dot[found], norm, out=np.zeros(len(found)), where=norm > 0)
    return found, cosine, 2.0 * shared[found] / (s.sizes[found] + len(q.word)), read


def _entries(s: Segment, lo: np.ndarray, length: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(candidate, count, number of the list) of all entries of some lists."""
    size = length[lists]
    at = np.repeat(lo[lists] - np.cumsum(size) + size, size) + np.arange(size.sum())
    return s.docs[at], s.tf[at], np.repeat(lists, size)


def distances(q: Question, place: np.ndarray, s: Segment, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """(distance, shared-word score) of every candidate of a segment: euclidean or manhattan distance of unit TF-IDF vectors."""
    here = np.flatnonzero(place >= 0)
    at, n = place[here], len(s.sizes)
    docs, tf, word = _entries(s, s.ptr[at], s.ptr[at + 1] - s.ptr[at], np.arange(len(at)))
    pair = 2.0 * np.bincount(docs, minlength=n) / np.maximum(s.sizes + len(q.word), 1)
    weighs = (q.unit[here] > 0)[word]
    docs, tf, word = docs[weighs], tf[weighs].astype(float), word[weighs]
    own, foreign, unit = q.own[here][word], q.foreign[here][word], q.unit[here][word]
    norm = np.sqrt(np.maximum(s.base + np.bincount(docs, tf**2 * (own**2 - foreign**2), n), 0.0))
    scale = np.divide(1.0, norm, out=np.zeros(n), where=norm > 0)
    if metric == "euclidean":
        cosine = np.bincount(docs, tf * own * unit, n) * scale
        return np.sqrt(np.maximum(float(q.unit.any()) + (norm > 0) - 2 * cosine, 0.0)), pair
    mass = (s.total + np.bincount(docs, tf * (own - foreign), n)) * scale
    return q.unit.sum() + mass - 2 * np.bincount(docs, np.minimum(tf * own * scale[docs], unit), n), pair


def _keys(strategy: str, distance: np.ndarray, pair: np.ndarray, weight: float) -> np.ndarray:
    """Smaller is better."""
    distance = np.round(distance, DIGITS)
    if strategy == "tfidf":
        return distance
    return -pair if strategy == "cross_encoder" else -np.round(weight * (1 - distance) + (1 - weight) * pair, DIGITS)


def _least_score(strategy: str, best: Best, probe: int) -> float:
    """The score that a further candidate of a question must reach: that of its k-th so far."""
    lo, hi = np.searchsorted(best.probe, [probe, probe + 1])
    if hi - lo < best.k:
        return -np.inf
    worst = best.key[hi - 1]
    return 1 - worst if strategy == "tfidf" else -worst


def search(asked: DataFrame, blocks: tuple[DataFrame, int], index: Index, k: int, strategies: list[str], weight: float, tile_bytes: int, metric: str = "cosine") -> DataFrame:
    """k best candidates per question and strategy: (strategy, query_id, cand_id, key, rank); ``blocks`` are the questions packed.

    Candidates that share no word with a question score 0 by cosine: where fewer than k share one, those of the lowest ids follow.
    """
    if metric == "cosine" and len(index.first_ids) < min(2 * k, index.n):
        raise ValueError("the index keeps too few first ids for this k")
    n = index.n
    part = {"tfidf": (1.0, 0.0), "cross_encoder": (0.0, 1.0), "hybrid": (weight, 1 - weight)}

    def run(batches):
        at = best = q_ids = names = questions = None

        def done():
            for s, b in best.items():
                yield pa.RecordBatch.from_arrays([pa.array([s] * len(b.probe), pa.string()), pa.array(q_ids[b.probe], pa.int64()), pa.array(b.id), pa.array(b.key)], names=["strategy", "query_id", "cand_id", "key"])

        for number, read, tile in block_rows(batches):
            if number != at:
                if at is not None:
                    yield from done()
                block = read()
                at, best, q_ids = number, {s: Best(k) for s in strategies}, block.column("query_id").to_numpy()
                names, questions = _questions(block, n)
            for i in range(tile.num_rows):
                segment = Segment(**{c: np.frombuffer(tile.column(c)[i].as_py(), kind) for c, kind in _KINDS.items()})
                place = pc.index_in(names, value_set=tile.column("words")[i].values).fill_null(-1).to_numpy(zero_copy_only=False)
                new = {s: [[], [], []] for s in strategies}

                def take(s, j, ids, key):
                    if len(ids) > k:
                        kept = key <= np.partition(key, k - 1)[k - 1]
                        ids, key = ids[kept], key[kept]
                    for column, v in zip(new[s], (np.full(len(ids), j), key, ids), strict=True):
                        column.append(v)

                for j, q in enumerate(questions):
                    if metric != "cosine":
                        distance, pair = distances(q, place[q.word], segment, metric)
                        for s in strategies:
                            take(s, j, segment.ids, _keys(s, distance, pair, weight))
                        continue
                    for s in strategies:
                        found, cosine, pair, _ = evaluate(q, place[q.word], segment, *part[s], _least_score(s, best[s], j))
                        take(s, j, segment.ids[found], _keys(s, 1 - cosine, pair, weight))
                for s in strategies:
                    best[s].add(*map(np.concatenate, new[s]))
        if at is not None:
            yield from done()

    found = tile_join(*blocks, index.table, run, "strategy string, query_id bigint, cand_id bigint, key double", tile_bytes)
    if metric != "cosine":
        return top_k(found, ["strategy", "query_id"], [F.col("key"), F.col("cand_id")], k)
    nothing = F.array(*[F.struct(F.lit(s).alias("strategy"), F.lit(1.0 if s == "tfidf" else -0.0).alias("key")) for s in strategies])
    fill = asked.select("query_id", F.explode(F.lit(index.first_ids[: 2 * k]).cast("array<bigint>")).alias("cand_id"))
    fill = fill.select("query_id", "cand_id", F.explode(nothing).alias("s")).select("s.strategy", "query_id", "cand_id", "s.key")
    every = found.unionByName(fill).groupBy("strategy", "query_id", "cand_id").agg(F.min("key").alias("key"))
    return top_k(every, ["strategy", "query_id"], [F.col("key"), F.col("cand_id")], k)
