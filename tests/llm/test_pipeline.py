"""The pipeline: each stage on what its predecessor kept, held against the operators' own brute force."""

import collections

import corpus_pipeline
import __spark_entry__ as entry
from sparquill.llm import jaccard, pieces, quality
from tests.llm.test_links import expected_groups
from tests.llm.test_texts import expected_base, expected_lines, near_copies_and_junk


def test_stages(spark, docs, tmp_path):
    table = docs(near_copies_and_junk())
    kept = {0: table}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, kept[k], None)
        out.write.parquet(f"{tmp_path}/{k}")
        kept[k + 1] = spark.read.parquet(f"{tmp_path}/{k}")
        assert kept[k + 1].columns == table.columns or k == len(corpus_pipeline.STAGES) - 1
    rows = {k: [(r.doc_id, r.text) for r in df.collect()] for k, df in kept.items()}
    failed = {i for i, t in rows[0] if (b := expected_base(t)) and (b[0] < 10 or 100 * b[4] > 20 * b[0])}
    verdict = {r.doc_id: r.kept for r in quality.judge(table).collect()}
    assert sorted(i for i, _ in rows[1]) == sorted(i for i, _ in rows[0] if verdict[i]) and not failed & {i for i, _ in rows[1]}
    assert sorted(rows[2]) == sorted((i, t) for i, _, t in expected_lines(rows[1]))
    assert all(r.n_chars == len(r.text) for r in kept[2].collect())
    assert sorted(i for i, _ in rows[3]) == sorted(i for i, n, c in expected_groups(rows[2]) if i == c or n == 0)
    copies = collections.Counter(i for i, _ in rows[4])
    assert set(copies) <= {i for i, _ in rows[3]} and max(copies.values()) <= 3
    assert sorted(rows[5]) == sorted(rows[4]) and pieces.decode(kept[5]).where("decoded <> text").count() == 0


def test_stages_are_the_operators_in_order():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.QUERIES["pipeline"] is corpus_pipeline.run and "pipeline" in entry.queries()
    assert [f"op{n}_" for n in range(1, 11)] == [next(q for q in entry.queries() if q.startswith(f"op{n}_")).split("_")[0] + "_" for n in range(1, 11)]


def test_empty_documents_pass_through(spark, docs):
    out = docs([])
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, None)
    assert out.collect() == [] and jaccard.SHARE == 75
