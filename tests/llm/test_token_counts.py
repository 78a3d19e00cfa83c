"""Token counts against the libraries, and what the cache spares."""

import os

import pytest
import public_tokenizers
import sentencepiece
import tokenizers

from sparquill.llm import token_counts

MODEL, JSON = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
PIECES = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ROWS = [
    (1, "Hello world"), (2, None), (3, ""), (4, "Hello world"), (5, "Hello▁world"), (6, "  two  spaces \n lines\t\x0b"), (7, "é ∑ 漢字 🙂 \x00 end"), (None, "no id"), (8, " "), (8, " "),
    (9, "word " * 40000), (10, "x" * 200000), (11, "a  b " * 30000 + " "), (12, "<s> </s> <unk> <|endoftext|>"), (13, "▁▁ a ▁b"),
]


def want(count, rows, limit=4096):
    return sorted((str(i), len((t or "").encode()), count(t or ""), count(t or "") > limit) for i, t in rows)


def got(df):
    assert df.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    return sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect())


def test_counts_are_the_librarys(docs):
    assert token_counts.Tokenizer(MODEL).plain
    assert got(token_counts.count_tokens(docs(ROWS), MODEL)) == want(lambda t: len(PIECES.encode(t)), ROWS)
    other = tokenizers.Tokenizer.from_file(JSON)
    assert got(token_counts.count_tokens(docs(ROWS), JSON, limit=3)) == want(lambda t: len(other.encode(t, add_special_tokens=False).ids), ROWS, 3)
    assert token_counts.count_tokens(docs([]), MODEL).collect() == []


@pytest.mark.parametrize("size", [1, 2, 5, 17])
def test_cuts_change_no_count(size):
    for _, t in ROWS:
        t = (t or "")[:300]
        parts = token_counts.chunks(t, size)
        assert " ".join(parts) == t and sum(len(PIECES.encode(p)) for p in parts) == len(PIECES.encode(t))


def test_only_what_the_cache_lacks_is_encoded(spark, docs, tmp_path):
    cache = str(tmp_path / "cache")
    version = token_counts.Tokenizer(MODEL).version
    count = lambda t: len(PIECES.encode(t))

    def runs():
        return sorted(os.listdir(f"{cache}/{version}"))

    def added(before):
        new = set(runs()) - set(before)
        return sum(spark.read.parquet(f"{cache}/{version}/{r}").count() for r in new)

    first = ROWS[:8]
    assert got(token_counts.count_tokens(docs(first), MODEL, cache)) == want(count, first)
    distinct = len({(t or "").replace("▁", " ") for _, t in first})
    assert added([]) == distinct
    before = runs()
    assert got(token_counts.count_tokens(docs(ROWS), MODEL, cache)) == want(count, ROWS)
    assert added(before) == len({(t or "").replace("▁", " ") for _, t in ROWS}) - distinct
    # What stands in the cache is believed; another version's counts are not.
    false = spark.read.parquet(f"{cache}/{version}").selectExpr("digest", "n_tokens + 1000 AS n_tokens")
    lying = str(tmp_path / "lying")
    false.write.parquet(f"{lying}/{version}/run=a")
    false.write.parquet(f"{lying}/{version}/run=b")
    assert got(token_counts.count_tokens(docs(first), MODEL, lying)) == want(lambda t: count(t) + 1000, first)
    assert token_counts.Tokenizer(JSON).version != version


def test_one_text_holds_most_rows(docs):
    rows = [(i, "the hot text") for i in range(3000)] + [(5000 + i, f"text {i}") for i in range(1500)]
    assert got(token_counts.count_tokens(docs(rows), MODEL)) == want(lambda t: len(PIECES.encode(t)), rows)
