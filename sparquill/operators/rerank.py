"""Ranking of text candidates for questions.

``tfidf_rank`` works on a table of (question, candidate) pairs, each question with its own
candidates, as one relational plan; ``rerank_pairs`` ranks such candidates by any strategy. ``rank_corpus`` ranks a shared corpus
without building pairs: by an inverted index where shared words decide the score (``postings``), else by a scan. In both, questions are packed into blocks of
bounded size and joined with tiles of the corpus inside Spark, and each task keeps k candidates per question and strategy. No question passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.functions.text import overlap_f1, prompt, terms
from sparquill.operators import postings
from sparquill.operators.knn import CELLS, Best, block_rows, nearest_in_block, probe_blocks, tile_join
from sparquill.plans.scale import top_k
from sparquill.session import cut

METRICS = ("cosine", "euclidean", "manhattan")
STRATEGIES = ("cross_encoder", "tfidf", "hybrid", "sequential", "tfidf_corpus")
DIGITS = 12  # scores are rounded so that equal texts tie whatever the order of summation
VOCABULARY = 1_000_000  # terms that may be sent to every task
DENSE_BYTES = 64 << 20  # size of a dense matrix of a question block (questions x their distinct terms)
BLOCK_BYTES = 4 << 20  # size of a tile of the corpus
SLICE = 512  # candidates scored at a time; few enough that most question terms are absent
TFIDF_WEIGHT = 0.3
SUBSET = 10
FEW = 100_000  # ranked rows, of ids and scores, that may be sent to every task


# ---- pairs --------------------------------------------------------------------------------------


def _counted(df: DataFrame, keys: list[str], text: str, stop: list[str] | None) -> DataFrame:
    return df.select(*keys, F.explode(terms(text, stop)).alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def _idf(n: Column, df: Column) -> Column:
    """Smoothed idf over n documents."""
    return F.ln((1 + n) / (1 + df)) + 1


def tfidf_scores(queries: DataFrame, pairs: DataFrame, metric: str = "cosine", stop_words: list[str] | None = None) -> DataFrame:
    """TF-IDF distance of every candidate to its question: (query_id, cand_id, distance).

    queries (query_id, text); pairs (query_id, cand_id, text). Document frequencies count the
    question and its own candidates. Only terms are shuffled; a pair without a common term
    still gets its distance.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, choose from {', '.join(METRICS)}")
    q = _counted(queries, ["query_id"], "text", stop_words)
    c = _counted(pairs, ["query_id", "cand_id"], "text", stop_words)
    n = pairs.groupBy("query_id").agg((F.count("*") + 1).alias("n"))
    seen = c.select("query_id", "term").unionAll(q.select("query_id", "term"))
    idf = (
        seen.groupBy("query_id", "term")
        .agg(F.count("*").alias("df"))
        .join(n, "query_id")
        .select("query_id", "term", _idf(F.col("n"), F.col("df")).alias("idf"))
    )
    qw = q.join(idf, ["query_id", "term"]).select("query_id", "term", (F.col("tf") * F.col("idf")).alias("qw"))
    cw = c.join(idf, ["query_id", "term"]).select("query_id", "cand_id", "term", (F.col("tf") * F.col("idf")).alias("cw"))
    q_norm = qw.groupBy("query_id").agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qn"), F.sum("qw").alias("qs"))
    both = cw.join(qw, ["query_id", "term"], "left")
    sums = both.groupBy("query_id", "cand_id").agg(
        F.sqrt(F.sum(F.col("cw") * F.col("cw"))).alias("cn"),
        F.sum("cw").alias("cs"),
        F.coalesce(F.sum(F.col("cw") * F.col("qw")), F.lit(0.0)).alias("dot"),
    )
    every = pairs.select("query_id", "cand_id").join(sums, ["query_id", "cand_id"], "left").join(q_norm, "query_id", "left")
    cos = F.coalesce(F.try_divide(F.col("dot"), F.col("cn") * F.col("qn")), F.lit(0.0))
    one = lambda name: F.when(F.coalesce(F.col(name), F.lit(0.0)) > 0, 1.0).otherwise(0.0)
    if metric == "cosine":
        out = 1 - cos
    elif metric == "euclidean":
        out = F.sqrt(F.greatest(one("qn") + one("cn") - 2 * cos, F.lit(0.0)))
    else:
        shares = every.filter(F.col("dot") > 0).select("query_id", "cand_id", "cn", "qn")
        common = cw.join(qw, ["query_id", "term"]).join(shares, ["query_id", "cand_id"])
        least = common.groupBy("query_id", "cand_id").agg(
            F.sum(F.least(F.col("cw") / F.col("cn"), F.col("qw") / F.col("qn"))).alias("common")
        )
        every = every.join(least, ["query_id", "cand_id"], "left")
        part = lambda s, t: F.coalesce(F.try_divide(F.col(s), F.col(t)), F.lit(0.0))
        out = part("qs", "qn") + part("cs", "cn") - 2 * F.coalesce("common", F.lit(0.0))
    return every.select("query_id", "cand_id", F.round(out, DIGITS).alias("distance"))


def tfidf_rank(queries: DataFrame, pairs: DataFrame, metric: str = "cosine", k: int | None = None, stop_words: list[str] | None = None) -> DataFrame:
    """Candidates of each question, nearest first: (query_id, cand_id, distance, rank)."""
    scored = tfidf_scores(queries, pairs, metric, stop_words)
    return top_k(scored, ["query_id"], [F.col("distance"), F.col("cand_id")], (1 << 31) - 1 if k is None else k)


def score_pairs(pairs: DataFrame, a: str, b: str, factory: Callable[[], Callable] | None = None, out: str = "score") -> DataFrame:
    """Relevance of text pairs. Without a model: F1 of shared terms, as a built-in expression.
    ``factory`` runs once per task and returns a function from two lists to a list of scores."""
    if factory is None:
        return pairs.withColumn(out, overlap_f1(a, b))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = factory()
        for pdf in batches:
            yield pdf.assign(**{out: np.asarray(judge(list(pdf[a]), list(pdf[b])), dtype=float)})

    return pairs.mapInPandas(run, f"{fields}, `{out}` double")


# ---- shared corpus --------------------------------------------------------------------------------


@dataclass
class Vocabulary:
    """Terms with their document frequency, and the corpus size."""

    table: DataFrame
    n: int
    small: bool


def vocabulary(candidates: DataFrame, stop_words: list[str] | None = None, limit: int = VOCABULARY) -> Vocabulary:
    """Document frequency of every term, computed once for all questions and kept in the shared
    folder. The empty term, added to every candidate, counts the candidates in the same pass."""
    marked = F.array_append(F.array_distinct(terms("text", stop_words)), F.lit(""))
    counts = candidates.select(F.explode(marked).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    every = cut(counts)
    row = every.filter("term = ''").first()
    table = every.filter("term <> ''")
    return Vocabulary(table, row["df"] if row else 0, every.count() <= limit)


def question_table(queries: DataFrame, vocab: Vocabulary | None, stop_words: list[str] | None) -> tuple[DataFrame, int]:
    """Questions with their terms, the document frequency of those that the corpus knows, and their plain words; and the bytes
    that a question takes in a block whose dense matrix stays below DENSE_BYTES."""
    rows = queries.select("query_id", "text", terms("text", stop_words).alias("terms"), terms("text", []).alias("words"))
    if vocab is None:
        rows = rows.withColumn("known", F.array().cast("array<string>")).withColumn("df", F.array().cast("array<bigint>"))
    else:
        own = rows.select("query_id", F.explode(F.array_distinct("terms")).alias("term")).join(vocab.table, "term")
        counted = own.groupBy("query_id").agg(F.collect_list(F.struct("term", "df")).alias("d"))
        rows = rows.join(counted, "query_id", "left").select(*rows.columns, F.coalesce(F.col("d.term"), F.array().cast("array<string>")).alias("known"), F.coalesce(F.col("d.df"), F.array().cast("array<bigint>")).alias("df"))
    rows = cut(rows)
    most = rows.agg(F.max(F.size("terms") + F.size("words"))).first()[0] or 1
    per_block = max(1, int((DENSE_BYTES / (8 * most)) ** 0.5))
    return rows, -(-BLOCK_BYTES // per_block)


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row number and dictionary code of every entry of a list column, and the dictionary."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().dictionary_encode()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(column)), lengths), flat.indices.to_numpy(zero_copy_only=False), flat.dictionary


def _counts(rows: np.ndarray, codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, count) of the distinct (row, code) pairs."""
    key, count = np.unique(rows * max(width, 1) + codes, return_counts=True)
    return key // max(width, 1), key % max(width, 1), count


def _dense(rows, cols, values, shape) -> np.ndarray:
    out = np.zeros(shape)
    out[rows, cols] = values
    return out


def _shared(column: pa.Array, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts of the vocabulary's terms in a list column: row, column, count, and the
    vocabulary positions of the columns (only terms that occur)."""
    rows, codes, names = _codes(column)
    at = pc.index_in(names, vocab).to_numpy(zero_copy_only=False).astype(float)
    found = np.isfinite(at)[codes] if len(codes) else np.zeros(0, bool)
    where = np.where(np.isfinite(at), at, 0).astype(np.int64)
    r, c, n = _counts(rows[found], where[codes[found]] if len(codes) else codes, len(vocab))
    present, c = np.unique(c, return_inverse=True)
    return r, c, n, present


class TfidfBlock:
    """TF-IDF distances of a block of questions to batches of candidates.

    The idf of a term depends on whether the question has it. A candidate's norm is its norm
    with the idf of foreign terms, corrected for the terms it shares with the question, so
    two matrix products give all cosines.
    """

    def __init__(self, q_terms: pa.Array, n: int, q_vocab: pa.Array, q_df: np.ndarray):
        rows, codes, names = _codes(q_terms)
        at = pc.index_in(names, q_vocab).to_numpy(zero_copy_only=False).astype(np.int64)
        rows, codes, count = _counts(rows, at[codes] if len(codes) else codes, len(q_vocab))
        shape = (len(q_terms), len(q_vocab))
        self.vocab = q_vocab
        self.foreign = np.log((2 + n) / (1 + q_df)) + 1
        self.own = np.log((2 + n) / (2 + q_df)) + 1
        weights = _dense(rows, codes, count, shape) * self.own
        norm = np.sqrt((weights**2).sum(axis=1))
        self.unit = np.divide(weights, norm[:, None], out=np.zeros_like(weights), where=norm[:, None] > 0)
        self.has = (weights > 0).astype(float)
        self.empty = norm == 0

    def distances(self, c_terms: pa.Array, base: np.ndarray, total: np.ndarray, metric: str) -> np.ndarray:
        """``base`` and ``total``: sum of squares and sum of the candidates' foreign-idf weights."""
        r, c, n, present = _shared(c_terms, self.vocab)
        own, foreign, has, unit = self.own[present], self.foreign[present], self.has[:, present], self.unit[:, present]
        tf = _dense(r, c, n, (len(c_terms), len(present)))
        norm = np.sqrt(np.maximum(base[:, None] + (tf**2 * (own**2 - foreign**2)) @ has.T, 0.0))
        dot = (tf * own) @ unit.T
        cos = np.divide(dot, norm, out=np.zeros_like(dot), where=norm > 0)
        if metric == "cosine":
            return 1 - cos
        full = (norm > 0).astype(float)
        if metric == "euclidean":
            return np.sqrt(np.maximum((~self.empty)[None, :] + full - 2 * cos, 0.0))
        mass = total[:, None] + (tf * (own - foreign)) @ has.T
        mass = np.divide(mass, norm, out=np.zeros_like(mass), where=norm > 0)
        shared = np.zeros_like(mass)
        for j in range(len(unit)):
            cols = np.nonzero(has[j])[0]
            size = norm[:, j][:, None]
            mine = np.divide(tf[:, cols] * own[cols], size, out=np.zeros((len(tf), len(cols))), where=size > 0)
            shared[:, j] = np.minimum(mine, unit[j, cols]).sum(axis=1)
        return self.unit.sum(axis=1)[None, :] + mass - 2 * shared


class OverlapBlock:
    """F1 of shared distinct terms between a block of questions and batches of candidates."""

    def __init__(self, q_terms: pa.Array):
        rows, codes, names = _codes(q_terms)
        rows, codes, _ = _counts(rows, codes, len(names))
        self.vocab = names
        self.has = _dense(rows, codes, 1.0, (len(q_terms), len(names)))

    def scores(self, c_terms: pa.Array) -> np.ndarray:
        rows, codes, names = _codes(c_terms)
        size = np.bincount(_counts(rows, codes, len(names))[0], minlength=len(c_terms)).astype(float)
        r, c, _, present = _shared(c_terms, self.vocab)
        mine = _dense(r, c, 1.0, (len(c_terms), len(present)))
        total = size[:, None] + self.has.sum(axis=1)[None, :]
        return np.divide(2.0 * (mine @ self.has[:, present].T), total, out=np.zeros_like(total), where=total > 0)


def _norm_columns(candidates: DataFrame, vocab: Vocabulary, stop_words: list[str] | None) -> DataFrame:
    """Candidates with their foreign-idf sums, by joins: for vocabularies too large to send to tasks."""
    tf = _counted(candidates, ["cand_id"], "text", stop_words)
    weight = F.col("tf") * (F.ln((2 + F.lit(vocab.n)) / (1 + F.col("df"))) + 1)
    sums = tf.join(vocab.table, "term").groupBy("cand_id").agg(F.sum(weight * weight).alias("base"), F.sum(weight).alias("total"))
    return candidates.join(sums, "cand_id", "left").fillna(0.0, ["base", "total"])


def rank_corpus(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 5,
    strategies: Sequence[str] = ("tfidf",),
    metric: str = "cosine",
    tfidf_weight: float = TFIDF_WEIGHT,
    stop_words: list[str] | None = None,
    pair_factory: Callable[[], Callable] | None = None,
    vocabulary_limit: int = VOCABULARY,
    index: postings.Index | None = None,
) -> DataFrame:
    """k best candidates of a shared corpus per question and strategy.

    Without a model of their own for pairs, candidates are ranked by an inverted index, which is built here unless a stored one
    over the same candidates and stop words is given; with one, in a scan of all pairs.

    queries (query_id, text), candidates (cand_id, text), both ids bigint. Strategies:
    ``tfidf`` (distance, ascending), ``cross_encoder`` (pair score, descending) and ``hybrid``
    (weight * cosine + rest * pair score, descending). Returns (strategy, query_id, rank,
    cand_id, score).
    """
    wanted = list(strategies)
    if not wanted or any(s not in ("tfidf", "cross_encoder", "hybrid") for s in wanted):
        raise ValueError("strategies must be tfidf, cross_encoder or hybrid")
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, choose from {', '.join(METRICS)}")
    need_tfidf = any(s != "cross_encoder" for s in wanted)
    need_pair = any(s != "tfidf" for s in wanted)
    if pair_factory is None:
        return _by_index(queries, index or postings.build(candidates, stop_words, 2 * k), k, wanted, metric, tfidf_weight, stop_words)
    vocab = vocabulary(candidates, stop_words, vocabulary_limit) if need_tfidf else None
    sc = candidates.sparkSession.sparkContext
    rows = candidates.select("cand_id", "text")
    if need_tfidf and not vocab.small:
        rows = _norm_columns(rows, vocab, stop_words)
    extra = [c for c in rows.columns if c not in ("cand_id", "text")]
    cols = list(extra)
    if need_tfidf:
        cols.append(terms("text", stop_words).alias("terms"))
    if need_pair and pair_factory is None:
        cols.append(terms("text", []).alias("words"))
    if pair_factory is not None:
        cols.append(F.col("text"))
    rows = rows.select("cand_id", *cols)
    everything = None
    if need_tfidf and vocab.small:
        t = vocab.table.toArrow()  # at most ``vocabulary_limit`` rows
        everything = sc.broadcast((t["term"].combine_chunks(), np.log((2 + vocab.n) / (1 + t["df"].to_numpy())) + 1))
    asked, width = question_table(queries, vocab, stop_words)
    blocks, n = probe_blocks(asked, width, BLOCK_BYTES)
    run = _corpus_scan(everything, wanted, metric, tfidf_weight, k, pair_factory, vocab.n if vocab else 0)
    found = tile_join(blocks, n, rows, run, "strategy string, query_id bigint, cand_id bigint, key double", BLOCK_BYTES)
    return _scored(top_k(found, ["strategy", "query_id"], [F.col("key"), F.col("cand_id")], k))


def _scored(best: DataFrame) -> DataFrame:
    score = F.when(F.col("strategy") == "tfidf", F.col("key")).otherwise(-F.col("key"))
    return best.select("strategy", "query_id", F.col("rank").cast("int").alias("rank"), "cand_id", score.alias("score"))


def _by_index(queries: DataFrame, index: postings.Index, k: int, wanted: list[str], metric: str, weight: float, stop_words: list[str] | None) -> DataFrame:
    asked, width = question_table(queries, Vocabulary(index.terms, index.n, True), stop_words)
    return _scored(postings.search(asked, probe_blocks(asked, width, BLOCK_BYTES), index, k, wanted, weight, BLOCK_BYTES, metric))


def _tfidf_block(asked: pa.RecordBatch, n: int) -> TfidfBlock:
    own = pc.unique(asked.column("terms").flatten())
    df = dict(zip(asked.column("known").flatten().to_pylist(), asked.column("df").flatten().to_pylist()))
    return TfidfBlock(asked.column("terms"), n, own, np.array([df.get(t, 0) for t in own.to_pylist()], float))


def _corpus_scan(everything, wanted, metric, weight, k, pair_factory, n):
    def foreign(batch, terms_col, index):
        if everything is None:
            return batch.column("base").to_numpy(), batch.column("total").to_numpy()
        idf = everything.value[1]
        rows, codes, own = _codes(terms_col)
        at = index.get_indexer(own.to_pylist())
        r, c, n = _counts(rows, codes, len(own))
        w = n * idf[at[c]] if len(c) else np.zeros(0)
        size = len(terms_col)
        return np.bincount(r, w * w, size).astype(float), np.bincount(r, w, size).astype(float)

    def run(batches):
        judge = pair_factory() if pair_factory is not None else None
        index = pd.Index(everything.value[0].to_pylist()) if everything is not None else None
        at = best = q_ids = tfidf = overlap = q_texts = None
        for number, read, whole in block_rows(batches):
            if number != at:
                if at is not None:
                    yield from _ranked(best, q_ids)
                asked = read()
                at, best, q_ids = number, {s: Best(k) for s in wanted}, asked.column("query_id").to_numpy()
                tfidf = _tfidf_block(asked, n) if any(s != "cross_encoder" for s in wanted) else None
                overlap = OverlapBlock(asked.column("words")) if judge is None and any(s != "tfidf" for s in wanted) else None
                q_texts = asked.column("text").to_pylist()
            step = max(1, min(SLICE, CELLS // max(len(q_ids), 1)))
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                ids = batch.column("cand_id").to_numpy()
                dist = pair = None
                if tfidf is not None:
                    base, total = foreign(batch, batch.column("terms"), index)
                    dist = np.round(tfidf.distances(batch.column("terms"), base, total, metric), DIGITS)
                if overlap is not None:
                    pair = overlap.scores(batch.column("words"))
                elif judge is not None:
                    texts = batch.column("text").to_pylist()
                    pair = np.stack([np.asarray(judge([q] * len(texts), texts), float) for q in q_texts], axis=1)
                for s in wanted:
                    if s == "tfidf":
                        keys = dist
                    elif s == "cross_encoder":
                        keys = -pair
                    else:
                        keys = -np.round(weight * (1 - dist) + (1 - weight) * pair, DIGITS)
                    keys = keys.T
                    probe, col = nearest_in_block(keys, k, 0.0)
                    best[s].add(probe, keys[probe, col], ids[col])
        if at is not None:
            yield from _ranked(best, q_ids)

    return run


def _ranked(best: dict[str, Best], q_ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for s, b in best.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([s] * len(b.probe), pa.string()), pa.array(q_ids[b.probe], pa.int64()), pa.array(b.id), pa.array(b.key)],
            ["strategy", "query_id", "cand_id", "key"],
        )


def rerank_pairs(
    queries: DataFrame, pairs: DataFrame, strategy: str = "tfidf", k: int | None = None, metric: str = "cosine", subset_size: int = SUBSET,
    tfidf_weight: float = TFIDF_WEIGHT, stop_words: list[str] | None = None, pair_factory: Callable[[], Callable] | None = None,
) -> DataFrame:
    """Ranks each question's own candidates: (strategy, query_id, rank, cand_id, score).

    queries (query_id, text); pairs (query_id, cand_id, text), as a search returns them. ``tfidf`` and ``tfidf_corpus`` rank by distance, ``cross_encoder`` by
    pair score, ``hybrid`` by weight * (1 - distance) + rest * pair score, ``sequential`` by pair score within the subset nearest by distance. Ties go to the lower id.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"{strategy!r} names no reranking; choose from {', '.join(STRATEGIES)}")
    rows = pairs.select("query_id", "cand_id", F.col("text").alias("c_text"))
    if strategy != "cross_encoder":
        near = tfidf_scores(queries, pairs, metric, stop_words)
        if strategy == "sequential":
            near = top_k(near, ["query_id"], [F.col("distance"), F.col("cand_id")], subset_size).drop("rank")
        rows = rows.join(near, ["query_id", "cand_id"])
    up = strategy in ("tfidf", "tfidf_corpus")
    if not up:
        rows = rows.join(queries.select("query_id", F.col("text").alias("q_text")), "query_id")
        rows = score_pairs(rows, "q_text", "c_text", pair_factory, "pair")
    score = {"hybrid": lambda: F.round(tfidf_weight * (1 - F.col("distance")) + (1 - tfidf_weight) * F.col("pair"), DIGITS)}.get(
        strategy, lambda: F.col("distance") if up else F.col("pair")
    )()
    scored = rows.select("query_id", "cand_id", score.alias("score"))
    order = F.col("score").asc() if up else F.col("score").desc()
    best = top_k(scored, ["query_id"], [order, F.col("cand_id")], (1 << 31) - 1 if k is None else k)
    return best.select(F.lit(strategy).alias("strategy"), "query_id", F.col("rank").cast("int").alias("rank"), "cand_id", "score")


def _with_texts(ranked: DataFrame, candidates: DataFrame, name: str = "text") -> DataFrame:
    """Ranked rows, which are stored first, with their candidates' texts. The corpus is read once, and shuffled only if the rows are many."""
    ranked = cut(ranked)
    few = F.broadcast(ranked) if ranked.count() <= FEW else ranked
    return candidates.select("cand_id", F.col("text").alias(name)).join(few, "cand_id")


def sequential_rerank(queries, candidates, k: int = 5, subset_size: int = SUBSET, pair_factory=None, ranked: DataFrame | None = None, **options) -> DataFrame:
    """Best ``subset_size`` candidates by TF-IDF, then ordered by pair score; original ids are kept."""
    first = rank_corpus(queries, candidates, subset_size, ("tfidf",), **options) if ranked is None else ranked
    first = first.filter((F.col("strategy") == "tfidf") & (F.col("rank") <= subset_size))
    pairs = _with_texts(first.select("query_id", "cand_id"), candidates, "c_text")
    pairs = pairs.join(queries.select("query_id", F.col("text").alias("q_text")), "query_id")
    scored = score_pairs(pairs, "q_text", "c_text", pair_factory).select("query_id", "cand_id", "score")
    best = top_k(scored, ["query_id"], [F.col("score").desc(), F.col("cand_id")], k)
    return best.select(F.lit("sequential").alias("strategy"), "query_id", F.col("rank").cast("int").alias("rank"), "cand_id", "score")


def rerank(queries: DataFrame, candidates: DataFrame, strategy: str = "tfidf", k: int = 5, **options) -> DataFrame:
    """Ranking by strategy name."""
    if strategy not in STRATEGIES:
        raise ValueError(f"{strategy!r} names no reranking; choose from {', '.join(STRATEGIES)}")
    if strategy == "sequential":
        return sequential_rerank(queries, candidates, k, **options)
    if strategy == "tfidf_corpus":
        return rank_corpus(queries, candidates, k, ("tfidf",), **options).withColumn("strategy", F.lit(strategy))
    return rank_corpus(queries, candidates, k, (strategy,), **options)


def rerank_by_question(queries: DataFrame, candidates: DataFrame, k: int = 5, strategy: str = "strategy", **options) -> DataFrame:
    """Each question is ranked by the strategy that its own row names; an unknown or missing name fails. One index serves all questions that can use one."""
    names = [r[strategy] for r in queries.select(strategy).distinct().limit(len(STRATEGIES) + 1).collect()]
    unknown = [n for n in names if n not in STRATEGIES]
    if unknown:
        raise ValueError(f"{unknown[0]!r} names no reranking; choose from {', '.join(STRATEGIES)}")
    if names and options.get("pair_factory") is None and options.get("index") is None:
        options["index"] = postings.build(candidates, options.get("stop_words"), 2 * max(k, options.get("subset_size", SUBSET)))
    parts = [rerank(queries.filter(F.col(strategy) == name).drop(strategy), candidates, name, k, **options) for name in sorted(names)]
    if not parts:
        return rank_corpus(queries.drop(strategy), candidates, k, ("tfidf",), **options)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def rerank_all(queries: DataFrame, candidates: DataFrame, k: int = 5, subset_size: int = SUBSET, **options) -> DataFrame:
    """All five strategies from one scan of the corpus."""
    wide = max(k, subset_size)
    scan = cut(rank_corpus(queries, candidates, wide, ("tfidf", "cross_encoder", "hybrid"), **options))
    top = scan.filter(F.col("rank") <= k)
    corpus = top.filter(F.col("strategy") == "tfidf").withColumn("strategy", F.lit("tfidf_corpus"))
    return cut(top.unionByName(corpus).unionByName(sequential_rerank(queries, candidates, k, subset_size, ranked=scan)))  # a small result, which is read several times


def rerank_compare(ranked: DataFrame, queries: DataFrame, candidates: DataFrame, chars: int = 100) -> DataFrame:
    """Per question and strategy: top scores, top texts cut for display, best context and its match score."""
    texts = _with_texts(ranked, candidates)
    item = F.struct("rank", "score", "text")
    lists = texts.groupBy("query_id", "strategy").agg(F.array_sort(F.collect_list(item)).alias("r"))
    asked = lists.join(queries.select("query_id", F.col("text").alias("question")), "query_id")
    best = F.col("r")[0]["text"]
    return asked.select(
        "query_id",
        "strategy",
        F.transform("r", lambda x: x["score"]).alias("top_scores"),
        F.transform("r", lambda x: F.substring(x["text"], 1, chars)).alias("top_texts"),
        best.alias("top_context"),
        overlap_f1(best, "question").alias("match_score"),
    )


def assemble_context(ranked: DataFrame, queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Prompt per question from its ranked contexts (k texts each)."""
    texts = _with_texts(ranked, candidates)
    lists = texts.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("r"))
    asked = lists.join(queries.select("query_id", F.col("text").alias("question")), "query_id")
    return asked.select("query_id", prompt("question", F.transform("r", lambda x: x["text"])).alias("prompt"))
