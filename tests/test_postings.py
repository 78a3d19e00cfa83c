"""The inverted index against a scan of all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from sparquill.operators import postings, rerank


def made(seed, n=400):
    """A few words in most texts, many rare ones, copies, empty texts and texts of one word."""
    draw = random.Random(seed)
    rare = [f"w{i}" for i in range(300)]
    often = ["the", "and", "common", "usual", "plain"]
    text = lambda size: " ".join(draw.choice(often) if draw.random() < 0.5 else draw.choice(rare) for _ in range(size))
    rows = [(i, text(draw.choice([1, 3, 8, 20]))) for i in range(n)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)] + [(2000, ""), (2001, None), (2002, "!!")]
    asked = [(i, text(draw.choice([1, 4, 12]))) for i in range(25)] + [(100, "unheard of words"), (101, ""), (102, "the and"), (103, rows[3][1]), (104, "usual usual w5")]
    draw.shuffle(rows)
    return asked, rows


@pytest.fixture
def tables(spark):
    asked, rows = made(3)
    return spark.createDataFrame(asked, "query_id bigint, text string"), spark.createDataFrame(rows, "cand_id bigint, text string").repartition(5)


def rows_of(df):
    return sorted((r.strategy, r.query_id, r["rank"], r.cand_id, round(r.score, 9) + 0.0) for r in df.collect())


@pytest.mark.parametrize("k,stop", [(1, None), (7, None), (7, [])])
def test_the_index_ranks_as_a_scan_does(tables, k, stop):
    q, c = tables
    wanted = ("tfidf", "cross_encoder", "hybrid")
    c = c.filter("text is not null")
    index = postings.build(c, stop, 2 * k, 300)
    assert index.table.count() > 5
    got = rows_of(rerank.rank_corpus(q, c, k, wanted, stop_words=stop, index=index))

    def judge():  # the built-in pair score as a plugged-in model, so that all pairs are scanned
        import re

        def words(t):
            return set(re.findall(r"[^\W]{2,}", (t or "").lower()))

        return lambda a, b: [2 * len(words(x) & words(y)) / max(1, len(words(x)) + len(words(y))) for x, y in zip(a, b)]

    want = rows_of(rerank.rank_corpus(q, c, k, wanted, stop_words=stop, pair_factory=judge))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4] for r in got], [r[4] for r in want])


def test_small_and_empty_corpora(spark, tables):
    q, c = tables
    few = c.filter("cand_id < 3")
    out = rows_of(rerank.rank_corpus(q, few, 5))
    assert len(out) == q.count() * few.count()
    assert len(rows_of(rerank.rank_corpus(q, c.filter("text is null"), 5))) == q.count()
    assert rerank.rank_corpus(q, c.limit(0), 5).collect() == [] and rerank.rank_corpus(q.limit(0), c, 5).collect() == []
    with pytest.raises(ValueError):
        rerank.rank_corpus(q, c, 9, index=postings.build(c, None, 4))


def test_bounds_spare_the_long_lists():
    """A question of one rare and several frequent words: once k good candidates are known, the frequent words' lists are looked up, not read."""
    n = 20_000
    words = [["often", "more", "rare" if i % 1000 == 7 else f"x{i % 50}"] for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(words)], names=["cand_id", "words"])
    import unittest.mock as mock

    with mock.patch.object(postings.TaskContext, "get", lambda: mock.Mock(partitionId=lambda: 0)):
        (raw,) = postings._segments(iter([batch]), 10)
    names = raw.column("words")[0].values.to_pylist()
    df = {w: sum(w in t for t in words) for w in ("often", "more", "rare")} | {f"x{i}": n // 50 for i in range(50)}
    dfs = pa.array([[df[w] for w in names]], pa.list_(pa.int64()))
    (full,) = postings._weighted(iter([pa.RecordBatch.from_arrays([*raw.columns, dfs], names=[*raw.schema.names, "dfs"])]), n)
    s = postings.Segment(**{c: np.frombuffer(full.column(c)[0].as_py(), kind) for c, kind in postings._KINDS.items()})
    mine = ["more", "often", "rare"]
    own, foreign = postings.idf(n, np.array([df[w] for w in mine], float))
    q = postings.Question(np.arange(3), own / np.sqrt((own**2).sum()), own, foreign)
    place = np.array([names.index(w) for w in mine])
    every, cosine, pair, read = postings.evaluate(q, place, s, 1.0, 0.0, -np.inf)
    assert len(every) == n and read == 2 * n + 20
    best = np.sort(cosine)[-10]
    some, again, _, less = postings.evaluate(q, place, s, 1.0, 0.0, best)
    assert set(some) == set(np.flatnonzero([("rare" in w) for w in words])) and less < 0.01 * read
    assert np.allclose(again, cosine[some])
    assert postings.evaluate(q, place, s, 1.0, 0.0, 1.5)[0].size == 0


def test_every_question_may_name_its_strategy(tables):
    q, c = tables
    q = q.filter("query_id < 10")
    from pyspark.sql import functions as F

    named = q.withColumn("strategy", F.element_at(F.array(*[F.lit(s) for s in rerank.STRATEGIES]), (F.col("query_id") % 5 + 1).cast("int")))
    want = [r for r in rows_of(rerank.rerank_all(q, c, 3)) if r[0] == rerank.STRATEGIES[r[1] % 5]]
    assert rows_of(rerank.rerank_by_question(named, c, 3)) == want
    for bad in ("magic", None):
        with pytest.raises(ValueError):
            rerank.rerank_by_question(named.withColumn("strategy", F.lit(bad).cast("string")), c, 3)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_other_metrics_are_ranked_by_the_index_too(tables, metric):
    """No pair of question and candidate is scanned, and the rows are those of a scan."""
    q, c = tables
    c = c.filter("text is not null")
    index = postings.build(c, None, 14, 300)
    found = rerank.rank_corpus(q, c, 7, ("tfidf",), metric, index=index)
    assert "tf#" in found._jdf.queryExecution().optimizedPlan().toString()
    scanned = rerank.rank_corpus(q, c, 7, ("tfidf",), metric, pair_factory=lambda: lambda a, b: [0.0] * len(a))
    scores = lambda df: sorted((r.query_id, r["rank"], round(r.score, 6)) for r in df.collect())
    assert scores(found) == scores(scanned)


def test_segments_are_cut_by_words_not_by_batches():
    import unittest.mock as mock

    batches = [pa.RecordBatch.from_arrays([pa.array([i, i + 1]), pa.array([["a", "b"], None])], names=["cand_id", "words"]) for i in range(0, 12, 2)]
    with mock.patch.object(postings.TaskContext, "get", lambda: mock.Mock(partitionId=lambda: 0)):
        made = list(postings._segments(iter(batches), 3, 9))
    ids = [np.frombuffer(m.column("ids")[0].as_py(), np.int64).tolist() for m in made]
    assert ids == [[0, 1, 2, 3, 4, 5], [6, 7, 8, 9, 10, 11]] and [m.column("tile")[0].as_py() for m in made] == [0, 1]
    with mock.patch.object(postings.TaskContext, "get", lambda: mock.Mock(partitionId=lambda: 0)):
        assert [m.column("texts")[0].as_py() for m in postings._segments(iter(batches), 3, 1)] == [1, 0] * 6


def test_all_strategies_are_ranked_once(tables):
    """The result of all strategies is stored: reading it again ranks nothing and reads no corpus."""
    q, c = tables
    plan = rerank.rerank_all(q, c, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "MapInArrow" not in plan
