"""SentencePiece: the scan gives the library's own ids, and texts come back."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from sparquill.llm import pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.vocabulary(pieces._read(pieces.MODEL))


def scanned(v, text, chunk):
    normal = v.prefix + text.replace(" ", pieces.SPACE)
    at = pieces.cuts(len(normal), chunk)
    chunks = []
    for k, (lo, hi) in enumerate(zip(at, at[1:], strict=False)):
        a = max(0, lo - v.longest)
        chunks.append(pieces.Chunk(v, normal[a : hi + v.longest], lo - a, hi - a, k == 0))
    matrices = [c.matrix() for c in chunks]
    states = pieces.chosen_states(matrices)
    assert pieces.combined(matrices)[states[0], states[-1]] == 0
    return [x for k, c in enumerate(chunks) for x in c.ids(states[k], states[k + 1])]


def texts(seed, n):
    draw = random.Random(seed)
    kinds = ("the shingles of a river ", "aabbetshingern", "   \n\t0019==--日本語😀éüqz", "a", " ", "=", "日", "\x00▁x ")
    for _ in range(n):
        alphabet = draw.choice(kinds)
        yield "".join(draw.choice(alphabet) for _ in range(draw.randint(90, 500)))


@pytest.mark.parametrize("seed", range(4))
def test_scan_equals_the_library(vocabulary, seed):
    for text in texts(seed, 60):
        for chunk in (40, 77):
            assert scanned(vocabulary, text, chunk) == vocabulary.whole.encode(text)


def test_products_of_matrices_associate():
    draw = np.random.default_rng(1)
    m = [np.where(draw.random((4, 4)) < 0.6, 0, -np.inf).astype(np.float32) for _ in range(5)]
    left = m[0]
    for x in m[1:]:
        left = pieces._product(left, x)
    assert (left == pieces.combined(m)).all()


def test_cuts():
    assert pieces.cuts(10, 40) == [0, 10] and pieces.cuts(100, 40) == [0, 40, 100] and pieces.cuts(120, 40) == [0, 40, 80, 120]


def test_encode_and_decode(docs):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rows = [(k, t) for k, t in enumerate(texts(9, 12))] + [(50, None), (51, ""), (None, "x y"), (52, "a b " * 3000), (52, "a b " * 3000), (None, "日本" * 3000), (53, "q" * 5000)]
    table = docs(rows)
    out = pieces.encode(table, chunk=64)
    assert [c for c in out.columns if c != "ids"] == [c for c in table.columns if c != "ids"] and out.columns[-1] == "ids"
    got = sorted((str(r.doc_id), r.text or "", r.ids) for r in out.collect())
    assert got == sorted((str(i), t or "", library.encode(t or "")) for i, t in rows)
    back = pieces.decode(out).collect()
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in back)
    digests = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256) for r in pieces.round_trip(table, chunk=64).collect())
    assert digests == sorted((str(i), len(library.encode(t or "")), hashlib.sha256(np.array(library.encode(t or ""), "<i4").tobytes()).hexdigest()) for i, t in rows)


def test_decode_of_odd_ids(spark):
    table = spark.createDataFrame([(1, None), (2, []), (3, [259, 3, 264])], "k int, ids array<int>")
    assert {r.k: r.decoded for r in pieces.decode(table).collect()}[1] is None
    assert {r.k: r.decoded for r in pieces.decode(table).collect()}[2] == ""


def test_no_documents(docs):
    assert pieces.encode(docs([])).collect() == [] and pieces.round_trip(docs([])).collect() == []
