"""The last stage decodes too, and documents without words pass the near-copy stage one by one."""

import corpus_pipeline
from sparquill.llm import jaccard


def test_ids_are_decoded(spark, docs):
    rows = [(1, "One two  three."), (2, ""), (3, None), (4, "Łódź\n\t漢字 " * 9000), (5, "x")]
    out = corpus_pipeline.to_pieces(spark, docs(rows), None)
    assert {r.doc_id: (r.text, r.exact, len(r.ids) > 0) for r in out.collect()} == {i: (t, True, bool(t)) for i, t in rows}


def test_documents_without_words_stay_one_by_one(docs):
    table = docs([(None, ""), (None, ""), (7, " \n"), (7, " \n"), (7, None), (8, "one two"), (8, "one two")])
    got = sorted((r.doc_id or 0, r.text or "") for r in jaccard.keep_one(table).collect())
    assert got == [(0, ""), (0, ""), (7, ""), (7, " \n"), (7, " \n"), (8, "one two")]
