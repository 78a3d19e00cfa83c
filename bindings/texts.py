"""Text: benchmark items are questions, word windows of documents the corpus.

Conversations give questions with their own candidates: the first turn asks, the others answer.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.common import rounded, table
from sparquill.functions import text as ft
from sparquill.operators import chunks as oc
from sparquill.operators import knn as ok
from sparquill.operators import rerank as orr
from sparquill.operators import sentences as sn
from sparquill.operators import split
from sparquill.plans.scale import exact_quantiles
from sparquill.session import work_path

LENGTH, OVERLAP = 50, 3


def documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def questions(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def corpus(spark, sf):
    pieces = oc.chunk_fixed(documents(spark, sf), LENGTH, OVERLAP)
    return pieces.select((F.col("doc_id") * 100000 + F.col("chunk_no")).alias("cand_id"), F.col("chunk").alias("text"))


def _talks(spark, sf):
    t = table(spark, sf, "conversations")
    asked = t.filter("turn = 0").select(F.col("conv_id").alias("query_id"), "text")
    said = t.filter("turn > 0").select(F.col("conv_id").alias("query_id"), F.col("turn").alias("cand_id"), "text")
    return asked, said


def trim_ws(spark, sf):
    return documents(spark, sf).select("doc_id", ft.trim_ws("text").alias("text"))


def chunk_fixed(spark, sf):
    return oc.chunk_fixed(documents(spark, sf), LENGTH, OVERLAP)


def chunk_sentences(spark, sf):
    return oc.chunk_sentences(documents(spark, sf), 3)


def _shortened(spark, sf):
    """The documents with a full stop after three short words, as abbreviations have."""
    return documents(spark, sf).withColumn("text", F.regexp_replace("text", " (in|de|of) ", " $1. "))


def abbreviation_scores(spark, sf):
    return rounded(sn.type_scores(_shortened(spark, sf)))


def chunk_learned(spark, sf):
    d = _shortened(spark, sf)
    return oc.chunk_learned(d, 3, sn.abbreviations(d))


def build_corpus(spark, sf):
    stored = oc.build_corpus(documents(spark, sf), work_path(spark, "corpus"), "fixed-length", LENGTH, OVERLAP, 64)
    return stored.select("doc_id", "chunk_no", F.length("chunk").alias("chars"), F.size("embedding").alias("dim"))


def embed_text(spark, sf):
    out = oc.embed_text(documents(spark, sf), "text", 64)
    unit = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    return rounded(out.select("doc_id", F.size("embedding").alias("dim"), unit.alias("norm2")), 4)


def _measure():
    """A plugged-in model: a text's length and its blanks as a vector."""
    return lambda texts: [[float(len(t)), float(t.count(" "))] for t in texts]


def _closeness():
    """A plugged-in model for pairs: texts of like length are close."""
    return lambda a, b: [1.0 / (1.0 + abs(len(x) - len(y))) for x, y in zip(a, b)]


def plugin_embed(spark, sf):
    out = oc.batch_embed(documents(spark, sf), "text", _measure)
    return out.select("doc_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(("chars", "blanks"))])


def plugin_rerank(spark, sf):
    asked, said = _talks(spark, sf)
    return rounded(orr.rerank_pairs(asked, said, "cross_encoder", pair_factory=_closeness))


def _tfidf(metric):
    def run(spark, sf):
        asked, said = _talks(spark, sf)
        return rounded(orr.tfidf_rank(asked, said, metric))

    return run


def _own(strategy, k=None, metric="cosine"):
    def run(spark, sf):
        asked, said = _talks(spark, sf)
        return rounded(orr.rerank_pairs(asked, said, strategy, k, metric, 3))

    return run


def retrieve_rerank(spark, sf):
    """Search by vector, then rank the hits of each question by text."""
    q, c = questions(spark, sf), corpus(spark, sf)
    near = ok.knn(oc.embed_text(q, "text", 64), oc.embed_text(c.withColumnRenamed("cand_id", "vec_id"), "text", 64).select("vec_id", "embedding"), 20, "cosine")
    pairs = near.select("query_id", F.col("vec_id").alias("cand_id")).join(c, "cand_id")
    return rounded(orr.rerank_pairs(q, pairs, "hybrid", 5))


def tfidf_corpus(spark, sf):
    return rounded(orr.rerank(questions(spark, sf), corpus(spark, sf), "tfidf_corpus", 5))


def _corpus_metric(metric):
    def run(spark, sf):
        return rounded(orr.rank_corpus(questions(spark, sf), corpus(spark, sf), 5, ("tfidf",), metric))

    return run


def pair_rerank(spark, sf):
    return rounded(orr.rerank(questions(spark, sf), corpus(spark, sf), "cross_encoder", 5))


def hybrid_rerank(spark, sf):
    return rounded(orr.rerank(questions(spark, sf), corpus(spark, sf), "hybrid", 5))


def sequential_rerank(spark, sf):
    return rounded(orr.rerank(questions(spark, sf), corpus(spark, sf), "sequential", 5))


def rerank_all(spark, sf):
    return rounded(orr.rerank_all(questions(spark, sf), corpus(spark, sf), 5))


def rerank_by_question(spark, sf):
    """Every question is ranked by a strategy of its own."""
    names = F.element_at(F.array(*[F.lit(s) for s in orr.STRATEGIES]), (F.col("query_id") % 5 + 1).cast("int"))
    return rounded(orr.rerank_by_question(questions(spark, sf).withColumn("strategy", names), corpus(spark, sf), 5))


def rerank_compare(spark, sf):
    q, c = questions(spark, sf), corpus(spark, sf)
    out = orr.rerank_compare(orr.rerank_all(q, c, 5), q, c)
    short = F.transform("top_scores", lambda s: F.round(s, 5) + F.lit(0.0)).alias("top_scores")
    return rounded(out.select("query_id", "strategy", short, "top_texts", "top_context", "match_score"))


def score_quartiles(spark, sf):
    ranked = orr.rerank_all(questions(spark, sf), corpus(spark, sf), 5).filter("rank = 1")
    level = F.element_at(F.array(F.lit("easy"), F.lit("medium"), F.lit("hard")), (F.col("query_id") % 3 + 1).cast("int"))
    rows = ranked.withColumn("difficulty", level)
    return rounded(exact_quantiles(rows, "score", [0.25, 0.5, 0.75], ["strategy", "difficulty"]))


def assemble_context(spark, sf):
    q, c = questions(spark, sf), corpus(spark, sf)
    return orr.assemble_context(orr.rerank(q, c, "tfidf", 3), q, c)


def exact_match(spark, sf):
    t = table(spark, sf, "conversations")
    said = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("The "), F.col("text"), F.lit(" !"))).otherwise(F.reverse("text"))
    return t.select("conv_id", "turn", (ft.answer_form(said) == ft.answer_form("text")).alias("matched"))


def extract_score(spark, sf):
    e = table(spark, sf, "events")
    nested = F.concat(F.lit('{"truth": '), F.col("props"), F.lit("}"))
    shape = F.when(F.col("event_id") % 4 == 0, nested).when(F.col("event_id") % 4 == 1, F.col("props"))
    text = shape.when(F.col("event_id") % 4 == 2, F.col("value").cast("string")).otherwise(F.lit("none"))
    return rounded(e.select("event_id", ft.first_number(text).alias("score")))


def qa_filter(spark, sf):
    d = table(spark, sf, "documents").withColumn("answer", F.when(F.col("doc_id") % 5 == 0, None).when(
        F.col("doc_id") % 7 == 0, F.lit("NULL")).otherwise(F.col("text")))
    kept = d.filter(F.col("answer").isNotNull() & (F.col("answer") != "NULL") & (F.col("lang") == "fr"))
    return kept.select("doc_id", F.length("answer").alias("chars"))


def stratified_sample(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return split.stratified_sample(d, "lang", "doc_id", 3, 1).select("doc_id", "lang", "pick")


def top_n_preview(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", "n_chars")
    return split.preview(d, ["doc_id"], 10, "text")


QUERIES = {
    f.__name__: f
    for f in (
        trim_ws, chunk_fixed, chunk_sentences, abbreviation_scores, chunk_learned, build_corpus, embed_text, tfidf_corpus, pair_rerank, hybrid_rerank,
        sequential_rerank, rerank_all, rerank_by_question, rerank_compare, score_quartiles, assemble_context, exact_match, extract_score,
        qa_filter, stratified_sample, top_n_preview,
    )
}
QUERIES["plugin_embed"] = plugin_embed
QUERIES["plugin_rerank"] = plugin_rerank
QUERIES["retrieve_rerank"] = retrieve_rerank
QUERIES["pairs_cross_encoder"] = _own("cross_encoder")
QUERIES["pairs_hybrid"] = _own("hybrid", 4, "euclidean")
QUERIES["pairs_sequential"] = _own("sequential", 2)
QUERIES["tfidf_rank"] = _tfidf("cosine")
QUERIES["tfidf_euclidean"] = _tfidf("euclidean")
QUERIES["tfidf_manhattan"] = _tfidf("manhattan")
QUERIES["tfidf_corpus_euclidean"] = _corpus_metric("euclidean")
QUERIES["tfidf_corpus_manhattan"] = _corpus_metric("manhattan")

# ---- the same in SQL ------------------------------------------------------------------------------

_STOP = ", ".join(f"'{w}'" for w in ft.STOP_WORDS)
_TRIM = r"trim(regexp_replace(text, '[\s\x1c-\x1f\x0b]+', ' ', 'g'), ' ')"
_WORDS = f"list_filter(string_split({_TRIM}, ' '), lambda x: x <> '')"
_TERMS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]{{2,}}')"
_CHUNKS = f"""
w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
chunks AS (SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, array_to_string(ws[i * 47 + 1 : i * 47 + 50], ' ') AS chunk
  FROM w, range(0, 400000 // 47) r(i) WHERE i * 47 < len(ws))
"""
_EDGES = r"'^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$'"
_LEARNED = f"""WITH short AS (SELECT doc_id, regexp_replace(text, ' (in|de|of) ', ' \\1. ', 'g') AS text FROM documents),
ws AS (SELECT doc_id, {_WORDS} AS ws FROM short),
each AS (SELECT lower(regexp_replace(w, {_EDGES}, '', 'g')) AS type, regexp_matches(w, '\\.["'')\\]]*$')::BIGINT AS stop FROM (SELECT unnest(ws) AS w FROM ws)),
counts AS (SELECT type, sum(stop)::BIGINT AS n_stop, count(*) - n_stop AS n_plain FROM each WHERE type <> '' GROUP BY 1),
chance AS (SELECT sum(n_stop)::DOUBLE / sum(n_stop + n_plain)::DOUBLE AS p FROM counts),
long AS (SELECT *, length(type) - length(replace(type, '.', '')) AS inner_stops, length(replace(type, '.', ''))::DOUBLE AS size FROM counts, chance),
scores AS (
  SELECT type, n_stop, n_plain, -2 * ((n_stop * ln(p) + n_plain * ln(1 - p)) - (n_stop * ln(0.99::DOUBLE) + n_plain * ln(1 - 0.99::DOUBLE))) * exp(-size) * (inner_stops + 1)
    * pow(size, -n_plain::DOUBLE) AS score
  FROM long WHERE n_stop > 0 AND n_stop + n_plain >= 5 AND regexp_matches(type, '\\p{{L}}')),
known AS (SELECT coalesce(list(type), []) AS types FROM scores WHERE score >= 0.3),
split AS (
  SELECT doc_id, list_filter(string_split(rtrim(array_to_string(list_transform(ws, lambda w: CASE WHEN regexp_matches(w, '[.!?]$')
    AND NOT (w LIKE '%.' AND list_contains(types, lower(regexp_replace(w, {_EDGES}, '', 'g')))) THEN w || chr(1) ELSE w END), ' '), chr(1)), chr(1) || ' '), lambda s: s <> '') AS s
  FROM ws, known)
"""
_QA = f"""WITH {_CHUNKS},
c AS (SELECT doc_id * 100000 + chunk_no AS cand_id, chunk AS text FROM chunks),
q AS (SELECT item_id AS query_id, text FROM benchmark),
cd AS (SELECT cand_id, list_distinct({_TERMS.format("text")}) AS ts FROM c),
qd AS (SELECT query_id, list_distinct({_TERMS.format("text")}) AS ts FROM q)
"""
_TF = f""",
ct AS (SELECT cand_id, t, count(*) AS tf FROM (SELECT cand_id, unnest({_TERMS.format("text")}) AS t FROM c) WHERE t NOT IN ({_STOP}) GROUP BY ALL),
qt AS (SELECT query_id, t, count(*) AS tf FROM (SELECT query_id, unnest({_TERMS.format("text")}) AS t FROM q) WHERE t NOT IN ({_STOP}) GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM ct GROUP BY 1),
nn AS (SELECT count(*) + 1 AS n FROM c),
qw AS (SELECT query_id, t, tf * (ln((1 + n) / (1 + coalesce(df, 0) + 1)::DOUBLE) + 1) AS w FROM qt LEFT JOIN df USING (t), nn),
qn AS (SELECT query_id, sqrt(sum(w * w)) AS qn, sum(w) AS qs FROM qw GROUP BY 1),
base AS (SELECT query_id, cand_id, ct.t, tf * (ln((1 + n) / (1 + df + (qw.t IS NOT NULL)::INT)::DOUBLE) + 1) AS cw, w AS qw
  FROM (SELECT DISTINCT query_id FROM q) x CROSS JOIN ct JOIN df USING (t) CROSS JOIN nn LEFT JOIN qw USING (query_id, t)),
s AS (SELECT query_id, cand_id, sqrt(sum(cw * cw)) AS cn, sum(cw) AS cs, coalesce(sum(cw * qw), 0) AS dot FROM base GROUP BY ALL),
p AS (SELECT query_id, cand_id, coalesce(dot / (cn * qn), 0) AS cos, coalesce(qn, 0) AS qn, coalesce(cn, 0) AS cn, qs, cs
  FROM (SELECT query_id, cand_id FROM q, c) LEFT JOIN s USING (query_id, cand_id) LEFT JOIN qn USING (query_id))
"""
_MAN = """,
ms AS (SELECT query_id, cand_id, sum(least(cw / s.cn, qw / qn.qn)) AS common FROM base JOIN s USING (query_id, cand_id) JOIN qn USING (query_id)
  WHERE qw IS NOT NULL GROUP BY ALL)
"""
_PAIR = """,
f AS (SELECT query_id, cand_id, coalesce(2.0::DOUBLE * len(list_intersect(cd.ts, qd.ts)) / nullif(len(cd.ts) + len(qd.ts), 0), 0) AS f1 FROM qd, cd)
"""


def _best(src: str, order: str, k: int = 5, keys: str = "query_id") -> str:
    return f"""SELECT *, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY {order}, cand_id) AS INTEGER) AS rank
      FROM {src} QUALIFY rank <= {k}"""


_SEQ = ", s10 AS (" + _best("(SELECT query_id, cand_id, round(1 - cos, 12) AS d FROM p)", "d", 10) + "), " \
    "sq AS (" + _best("(SELECT query_id, cand_id, f1 AS score FROM s10 JOIN f USING (query_id, cand_id))", "score DESC") + ")"
_HYB = "(SELECT query_id, cand_id, round(0.3 * (1 - round(1 - cos, 12)) + 0.7 * f1, 12) AS score FROM p JOIN f USING (query_id, cand_id))"
_EVERY = _QA + _TF + _PAIR + _SEQ + """,
tf1 AS (""" + _best("(SELECT query_id, cand_id, round(1 - cos, 12) AS score FROM p)", "score") + """),
ce AS (""" + _best("(SELECT query_id, cand_id, f1 AS score FROM f)", "score DESC") + """),
hy AS (""" + _best(_HYB, "score DESC") + """),
allr AS (SELECT 'tfidf' AS strategy, query_id, rank, cand_id, score FROM tf1 UNION ALL SELECT 'tfidf_corpus', query_id, rank, cand_id, score FROM tf1
  UNION ALL SELECT 'cross_encoder', query_id, rank, cand_id, score FROM ce UNION ALL SELECT 'hybrid', query_id, rank, cand_id, score FROM hy
  UNION ALL SELECT 'sequential', query_id, rank, cand_id, score FROM sq)
"""
_ROW = "SELECT {s} AS strategy, query_id, rank, cand_id, round(score, 6) + 0.0::DOUBLE AS score FROM {t}"

_TALK = f"""WITH q AS (SELECT conv_id AS query_id, text FROM conversations WHERE turn = 0),
c AS (SELECT conv_id AS query_id, turn AS cand_id, text FROM conversations WHERE turn > 0),
ct AS (SELECT query_id, cand_id, t, count(*) AS tf FROM (SELECT query_id, cand_id, unnest({_TERMS.format("text")}) AS t FROM c) WHERE t NOT IN ({_STOP}) GROUP BY ALL),
qt AS (SELECT query_id, t, count(*) AS tf FROM (SELECT query_id, unnest({_TERMS.format("text")}) AS t FROM q) WHERE t NOT IN ({_STOP}) GROUP BY ALL),
df AS (SELECT query_id, t, count(*) AS df FROM (SELECT query_id, t FROM ct UNION ALL SELECT query_id, t FROM qt) GROUP BY ALL),
nn AS (SELECT query_id, count(*) + 1 AS n FROM c GROUP BY 1),
idf AS (SELECT query_id, t, ln((1 + n) / (1 + df)::DOUBLE) + 1 AS idf FROM df JOIN nn USING (query_id)),
qw AS (SELECT query_id, t, tf * idf AS qw FROM qt JOIN idf USING (query_id, t)),
cw AS (SELECT query_id, cand_id, t, tf * idf AS cw FROM ct JOIN idf USING (query_id, t)),
qn AS (SELECT query_id, sqrt(sum(qw * qw)) AS qn FROM qw GROUP BY 1),
cn AS (SELECT query_id, cand_id, sqrt(sum(cw * cw)) AS cn FROM cw GROUP BY ALL),
qu AS (SELECT query_id, t, qw / qn AS u FROM qw JOIN qn USING (query_id)),
cu AS (SELECT query_id, cand_id, t, cw / cn AS u FROM cw JOIN cn USING (query_id, cand_id)),
-- the whole union of terms, as the vector formulas have it
un AS (SELECT query_id, cand_id, t, sum(a) AS a, sum(b) AS b FROM (
    SELECT query_id, cand_id, t, u AS a, 0.0::DOUBLE AS b FROM cu UNION ALL
    SELECT c.query_id, c.cand_id, t, 0.0, u FROM c JOIN qu USING (query_id)) GROUP BY ALL),
d0 AS (SELECT query_id, cand_id, sum(a * b) AS cosine, sqrt(sum((a - b) * (a - b))) AS euclidean, sum(abs(a - b)) AS manhattan FROM un GROUP BY ALL),
d AS (SELECT query_id, cand_id, 1 - coalesce(cosine, 0) AS cosine, coalesce(euclidean, 0) AS euclidean, coalesce(manhattan, 0) AS manhattan
  FROM c LEFT JOIN d0 USING (query_id, cand_id))
"""


def _talk(metric: str) -> str:
    return _TALK + f"""SELECT query_id, cand_id, round({metric}, 6) + 0.0::DOUBLE AS distance,
      CAST(row_number() OVER (PARTITION BY query_id ORDER BY round({metric}, 12), cand_id) AS INTEGER) AS rank FROM d"""


_OWN = _TALK + f""",
f AS (SELECT query_id, cand_id, coalesce(2.0::DOUBLE * len(list_intersect(a, b)) / nullif(len(a) + len(b), 0), 0) AS f1 FROM (
  SELECT c.query_id, cand_id, list_distinct({_TERMS.format("c.text")}) AS a, list_distinct({_TERMS.format("q.text")}) AS b FROM c JOIN q USING (query_id)))
"""


def _own_sql(strategy: str, src: str, k: int) -> str:
    return _OWN + ", b AS (" + _best(src, "score DESC", k) + ") " + _ROW.format(s=f"'{strategy}'", t="b")


SQL = {
    "abbreviation_scores": _LEARNED + "SELECT type, n_stop, n_plain, round(score, 6) + 0.0::DOUBLE AS score FROM scores",
    "chunk_learned": _LEARNED + """SELECT doc_id, i::INTEGER AS chunk_no, array_to_string(s[i * 3 + 1:i * 3 + 3], ' ') AS chunk
      FROM split, range(0, 200000) r(i) WHERE i * 3 < len(s)""",
    "plugin_embed": "SELECT doc_id, length(text)::DOUBLE AS chars, (length(text) - length(replace(text, ' ', '')))::DOUBLE AS blanks FROM documents",
    "plugin_rerank": _TALK + ", s AS (SELECT c.query_id, c.cand_id, 1.0::DOUBLE / (1 + abs(length(q.text) - length(c.text))) AS score FROM c JOIN q USING (query_id)), b AS ("
    + _best("s", "score DESC", 1 << 30) + ") " + _ROW.format(s="'cross_encoder'", t="b"),
    "embed_text": f"""SELECT doc_id, 64::INTEGER AS dim, (len(list_filter({_TERMS.format("text")}, lambda t: t NOT IN ({_STOP}))) > 0)::INT::DOUBLE AS norm2 FROM documents""",
    "pairs_cross_encoder": _own_sql("cross_encoder", "(SELECT query_id, cand_id, f1 AS score FROM f)", 1 << 30),
    "pairs_hybrid": _own_sql("hybrid", "(SELECT query_id, cand_id, round(0.3 * (1 - round(euclidean, 12)) + 0.7 * f1, 12) AS score FROM d JOIN f USING (query_id, cand_id))", 4),
    "pairs_sequential": _own_sql("sequential", "(SELECT query_id, cand_id, f1 AS score FROM (" + _best("(SELECT query_id, cand_id, round(cosine, 12) AS dist FROM d)", "dist", 3) + ") JOIN f USING (query_id, cand_id))", 2),
    "trim_ws": f"SELECT doc_id, {_TRIM} AS text FROM documents",
    "chunk_fixed": f"WITH {_CHUNKS} SELECT doc_id, chunk_no, chunk FROM chunks",
    "chunk_sentences": rf"""WITH s AS (SELECT doc_id, list_filter(string_split(regexp_replace({_TRIM}, '([.!?]) ', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS ss FROM documents)
        SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, array_to_string(ss[i * 3 + 1 : i * 3 + 3], ' ') AS chunk FROM s, range(0, 100000) r(i) WHERE i * 3 < len(ss)""",
    "build_corpus": f"WITH {_CHUNKS} SELECT doc_id, chunk_no, CAST(length(chunk) AS INTEGER) AS chars, CAST(64 AS INTEGER) AS dim FROM chunks",
    "tfidf_rank": _talk("cosine"),
    "tfidf_euclidean": _talk("euclidean"),
    "tfidf_manhattan": _talk("manhattan"),
    "tfidf_corpus": _QA + _TF + ", b AS (" + _best("(SELECT query_id, cand_id, round(1 - cos, 12) AS score FROM p)", "score") + ") " + _ROW.format(s="'tfidf_corpus'", t="b"),
    "tfidf_corpus_euclidean": _QA + _TF + ", b AS (" + _best(
        "(SELECT query_id, cand_id, round(sqrt(greatest((qn > 0)::INT + (cn > 0)::INT - 2 * cos, 0)), 12) AS score FROM p)", "score") + ") " + _ROW.format(s="'tfidf'", t="b"),
    "tfidf_corpus_manhattan": _QA + _TF + _MAN + ", b AS (" + _best(
        "(SELECT query_id, cand_id, round(coalesce(qs / nullif(qn, 0), 0) + coalesce(cs / nullif(cn, 0), 0) - 2 * coalesce(common, 0), 12) AS score "
        "FROM p LEFT JOIN ms USING (query_id, cand_id))", "score") + ") " + _ROW.format(s="'tfidf'", t="b"),
    "pair_rerank": _QA + _PAIR + ", b AS (" + _best("(SELECT query_id, cand_id, f1 AS score FROM f)", "score DESC") + ") " + _ROW.format(s="'cross_encoder'", t="b"),
    "hybrid_rerank": _QA + _TF + _PAIR + ", b AS (" + _best(_HYB, "score DESC") + ") " + _ROW.format(s="'hybrid'", t="b"),
    "sequential_rerank": _QA + _TF + _PAIR + _SEQ + " " + _ROW.format(s="'sequential'", t="sq"),
    "rerank_all": _EVERY + _ROW.format(s="strategy", t="allr"),
    "rerank_compare": _EVERY + """, l AS (SELECT query_id, strategy, list(round(score, 5) + 0.0::DOUBLE ORDER BY rank) AS top_scores,
          list(substr(c.text, 1, 100) ORDER BY rank) AS top_texts, first(c.text ORDER BY rank) AS top_context, first(cand_id ORDER BY rank) AS cand_id
          FROM allr JOIN c USING (cand_id) GROUP BY ALL)
        SELECT query_id, strategy, top_scores, top_texts, top_context,
          round(coalesce(2.0::DOUBLE * len(list_intersect(cd.ts, qd.ts)) / nullif(len(cd.ts) + len(qd.ts), 0), 0), 6) AS match_score
        FROM l JOIN cd USING (cand_id) JOIN qd USING (query_id)""",
    "rerank_by_question": _EVERY + """SELECT strategy, query_id, rank, cand_id, round(score, 6) + 0.0::DOUBLE AS score FROM allr
        WHERE strategy = ['cross_encoder', 'tfidf', 'hybrid', 'sequential', 'tfidf_corpus'][query_id % 5 + 1]""",
    "score_quartiles": _EVERY + """SELECT strategy, difficulty, round(quantile_cont(score, 0.25), 6) AS q25, round(quantile_cont(score, 0.5), 6) AS q50,
          round(quantile_cont(score, 0.75), 6) AS q75 FROM (SELECT strategy, ['easy', 'medium', 'hard'][query_id % 3 + 1] AS difficulty, score
          FROM allr WHERE rank = 1) GROUP BY ALL""",
    "assemble_context": _QA + _TF + ", b AS (" + _best("(SELECT query_id, cand_id, round(1 - cos, 12) AS score FROM p)", "score", 3) + """)
        SELECT query_id, 'Question: ' || any_value(q.text) || chr(10) || chr(10) || 'Context: ' || string_agg(c.text, ', ' ORDER BY rank) || chr(10) || chr(10) AS prompt
        FROM b JOIN c USING (cand_id) JOIN q USING (query_id) GROUP BY 1""",
    "exact_match": r"""WITH t AS (SELECT conv_id, turn, text, CASE WHEN turn % 2 = 0 THEN 'The ' || text || ' !' ELSE reverse(text) END AS said FROM conversations),
        n AS (SELECT *, list_filter(string_split_regex(regexp_replace(lower(said), '[!-/:-@\[-`{-~]', '', 'g'), '\s+'), lambda x: x NOT IN ('a', 'an', 'the', '')) AS a,
          list_filter(string_split_regex(regexp_replace(lower(text), '[!-/:-@\[-`{-~]', '', 'g'), '\s+'), lambda x: x NOT IN ('a', 'an', 'the', '')) AS b FROM t)
        SELECT conv_id, turn, array_to_string(a, ' ') = array_to_string(b, ' ') AS matched FROM n""",
    "extract_score": """SELECT event_id, CASE event_id % 4 WHEN 0 THEN (props->>'$.k')::DOUBLE WHEN 1 THEN (props->>'$.k')::DOUBLE
        WHEN 2 THEN round(value, 6) ELSE 0 END AS score FROM events""",
    "qa_filter": """SELECT doc_id, CAST(length(text) AS INTEGER) AS chars FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0 AND lang = 'fr'""",
    "stratified_sample": """SELECT doc_id, lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY ('0x' || substr(md5('1-' || doc_id), 1, 15))::BIGINT, doc_id) AS INTEGER) AS pick
        FROM documents QUALIFY pick <= 3""",
    "top_n_preview": "SELECT doc_id, substr(text, 1, 100) AS text, n_chars FROM documents ORDER BY doc_id LIMIT 10",
}
