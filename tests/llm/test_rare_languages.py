"""Documents of languages that are too small for a reference."""

import random

import pytest

from sparquill.llm import quality
from tests.llm.test_texts import prose

GREEK = ("ο", "και", "του", "σπίτι", "ποτάμι,", "φως.", "πράσινο", "νερό", "δρόμος", "βουνό.", "θάλασσα", "ήλιος")
RUSSIAN = ("и", "на", "дом", "река,", "свет.", "идёт", "зелёный", "вода", "дорога", "гора.", "море", "солнце")
LATIN = ("et", "in", "domus", "flumen,", "lux.", "ambulat", "viridis", "aqua", "via", "mons.", "mare", "sol")


def unrepeated(n, seed, words):
    draw = random.Random(seed)
    return " ".join(draw.choice(words) for _ in range(n))


@pytest.mark.parametrize("words", [GREEK, RUSSIAN, LATIN])
def test_clean_documents_of_a_rare_language_stay(docs, words):
    clean = [(i, prose(120, i), "en") for i in range(150)]
    rare = [(1000 + i, unrepeated(80, i, words), "xx") for i in range(4)]
    junk = [(2000, " ".join(f"{w}#$%&*|<>{k}##" for k, w in enumerate(words * 6)), "xx")]
    table = docs(clean + rare + junk)
    got = {r.doc_id: r for r in quality.judge(table).collect()}
    assert all(got[i].kept and not got[i].base_failed for i, *_ in rare) and not got[2000].kept
    assert any(got[i].word_distance > quality.MAX_WORD_DISTANCE or got[i].char_distance > quality.MAX_CHAR_DISTANCE for i, *_ in rare)
    assert sorted(r.doc_id for r in quality.keep_good(table).collect()) == sorted(i for i, r in got.items() if r.kept)
