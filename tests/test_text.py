import pytest
from pyspark.sql import functions as F

from sparquill.functions import text as ft
from sparquill.operators import chunks as oc
from sparquill.operators import rerank as orr
from sparquill.operators.chunks import batch_embed


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "t string").select(expr).first()[0]


def test_white_space_of_every_kind(spark):
    assert one(spark, "  a b\t\n\x1cc　 ", ft.trim_ws("t")) == "a b c"


@pytest.mark.parametrize("text,length,overlap,want", [
    ("", 3, 1, []), ("   ", 3, 1, []), ("a b", 3, 1, ["a b"]), ("a b c d e", 3, 1, ["a b c", "c d e", "e"]), ("a b c d", 2, 0, ["a b", "c d"]),
])
def test_fixed_chunks(spark, text, length, overlap, want):
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    got = [r.chunk for r in oc.chunk_fixed(df, length, overlap).orderBy("chunk_no").collect()]
    assert got == want


def test_chunk_arguments(spark):
    df = spark.createDataFrame([(1, "One. Two? Three! Four")], "doc_id int, text string")
    assert [r.chunk for r in oc.chunk(df, "sentence", overlap_size=2).orderBy("chunk_no").collect()] == ["One. Two?", "Three! Four"]
    for bad in (lambda: oc.chunk_fixed(df, 3, 3), lambda: oc.chunk(df, "fixed-length"), lambda: oc.chunk(df, "x", 5)):
        with pytest.raises(ValueError):
            bad()


@pytest.mark.parametrize("a,b,same", [
    ("The moon!", "moon", True), ("An  apple a day", "apple day", True), ("2 atoms", "two atoms", False), ("theatre", "atre", False), ("yes", "Yes.", True),
])
def test_answers_match_in_normal_form(spark, a, b, same):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(ft.answer_form("a") == ft.answer_form("b")).first()[0] is same


@pytest.mark.parametrize("text,want", [("0.5", 0.5), ('{"a": 0.25}', 0.25), ('{"a": {"b": 0.75, "c": 1}}', 0.75), ("x", 0.0), (None, 0.0), ("{}", 0.0)])
def test_first_number(spark, text, want):
    assert one(spark, text, ft.first_number("t")) == want


def test_prompt(spark):
    assert one(spark, "Why?", ft.prompt("t", F.array(F.lit("x"), F.lit("y")))) == "Question: Why?\n\nContext: x, y\n\n"


SENTENCES = [
    "Mara walked on the ridge during the second survey of the valley.",
    "The second survey was a large event in the history of the valley.",
    "Tom followed Mara on the ridge, the next person to walk there.",
    "Salt is a mineral made of sodium and chlorine.",
    "Salt is a mineral made of sodium and chlorine.",
    "of the and a",
]
ASKED = ["Who followed Mara on the ridge?", "What mineral is made of sodium?", "of the and"]


@pytest.fixture(scope="module")
def qa(spark):
    q = spark.createDataFrame(list(enumerate(ASKED)), "query_id bigint, text string")
    c = spark.createDataFrame(list(enumerate(SENTENCES)), "cand_id bigint, text string")
    return q, c


def table(df, value="score"):
    return {(r.query_id, r.cand_id): round(r[value], 9) for r in df.collect()}


@pytest.mark.parametrize("metric", orr.METRICS)
def test_corpus_kernel_equals_the_relational_plan(qa, metric):
    q, c = qa
    pairs = q.select("query_id").join(c)  # every question with the same candidates
    want = table(orr.tfidf_scores(q, pairs, metric), "distance")
    got = table(orr.rank_corpus(q, c, len(SENTENCES), ("tfidf",), metric))
    wide = table(orr.rank_corpus(q, c, len(SENTENCES), ("tfidf",), metric, vocabulary_limit=0))
    assert got == pytest.approx(want, abs=1e-9) and wide == pytest.approx(want, abs=1e-9)
    best = {r.query_id: r.cand_id for r in orr.rank_corpus(q, c, 1, ("tfidf",), metric).collect()}
    if metric != "manhattan":  # there the empty candidate is nearest
        assert best[0] == 2 and best[1] == 3  # the copy with the lower id comes first


def test_a_question_of_stop_words_is_at_distance_one_from_all(qa):
    q, c = qa
    got = orr.rank_corpus(q, c, 9, ("tfidf",)).filter("query_id = 2")
    assert {r.score for r in got.collect()} == {1.0}


def test_question_blocks_do_not_change_the_result(qa, monkeypatch):
    q, c = qa
    want = sorted(orr.rank_corpus(q, c, 4, ("tfidf", "cross_encoder", "hybrid")).collect())
    monkeypatch.setattr(orr, "SLICE", 2)
    monkeypatch.setattr(orr, "DENSE_BYTES", 1)
    monkeypatch.setattr(orr, "BLOCK_BYTES", 64)
    found = orr.rank_corpus(q, c, 4, ("tfidf", "cross_encoder", "hybrid"))
    assert "salt" in found._jdf.queryExecution().optimizedPlan().toString() and sorted(found.collect()) == want


@pytest.mark.parametrize("metric", orr.METRICS)
def test_own_candidates_rank_as_a_corpus_of_them_does(qa, metric):
    q, c = qa
    pairs = q.select("query_id").crossJoin(c)
    for strategy in ("tfidf", "cross_encoder", "hybrid"):
        want = table(orr.rank_corpus(q, c, 5, (strategy,), metric))
        assert table(orr.rerank_pairs(q, pairs, strategy, 5, metric)) == pytest.approx(want, abs=1e-9)
    assert table(orr.rerank_pairs(q, pairs, "sequential", 2, metric, 4)) == table(orr.sequential_rerank(q, c, 2, 4, metric=metric))
    with pytest.raises(ValueError):
        orr.rerank_pairs(q, pairs, "bm25")


def test_strategies_agree_with_their_definition(qa):
    q, c = qa
    every = orr.rerank_all(q, c, 3, 4)
    assert {r.strategy for r in every.select("strategy").distinct().collect()} == set(orr.STRATEGIES)
    assert every.filter("rank > 3").count() == 0
    f1 = table(orr.rerank(q, c, "cross_encoder", 6))
    tf = table(orr.rank_corpus(q, c, 6, ("tfidf",)))
    hy = table(orr.rerank(q, c, "hybrid", 6))
    assert hy == pytest.approx({k: 0.3 * (1 - tf[k]) + 0.7 * f1[k] for k in tf}, abs=1e-9)
    with pytest.raises(ValueError):
        orr.rerank(q, c, "bm25")
    report = orr.rerank_compare(every, q, c, 10)
    row = report.filter("query_id = 0 and strategy = 'tfidf'").first()
    assert len(row.top_scores) == 3 and row.top_texts[0] == SENTENCES[2][:10] and row.top_context == SENTENCES[2]


def test_plugged_in_pair_model(qa):
    q, c = qa

    def factory():
        return lambda a, b: [float(len(y)) for y in b]

    got = orr.rerank(q, c, "cross_encoder", 1, pair_factory=factory)
    assert {r.cand_id for r in got.collect()} == {max(range(6), key=lambda i: (len(SENTENCES[i]), -i))}
    pairs = c.select("cand_id", "text", F.lit("x").alias("other"))
    assert orr.score_pairs(pairs, "other", "text", factory).filter(F.col("score") != F.length("text")).count() == 0


def test_embeddings(spark):
    df = spark.createDataFrame([(1, "red ridge ridge"), (2, "")], "doc_id int, text string")
    got = {r.doc_id: r.embedding for r in oc.embed_text(df, "text", 16).collect()}
    assert sum(x * x for x in got[1]) == pytest.approx(1.0, abs=1e-6) and set(got[2]) == {0.0}
    out = batch_embed(df, "text", lambda: (lambda texts: [[len(t), 1] for t in texts])).collect()
    assert {r.doc_id: list(r.embedding) for r in out} == {1: [15.0, 1.0], 2: [0.0, 1.0]}


def test_candidates_of_each_question_are_ranked_on_their_own(spark):
    q = spark.createDataFrame([(1, "salt mineral"), (2, "ridge")], "query_id bigint, text string")
    p = spark.createDataFrame([(1, 0, "salt"), (1, 1, "ridge walk"), (2, 0, "ridge"), (2, 1, "")], "query_id bigint, cand_id bigint, text string")
    r = orr.tfidf_rank(q, p)
    assert sorted((x.query_id, x.rank, x.cand_id) for x in r.collect()) == [(1, 1, 0), (1, 2, 1), (2, 1, 0), (2, 2, 1)]
    assert r.filter("query_id = 2 and cand_id = 0").first().distance == 0.0
    for metric, worst in (("euclidean", 2**0.5), ("manhattan", None)):
        far = orr.tfidf_rank(q, p, metric, 1)
        assert {x.cand_id for x in far.collect()} == {0}
