"""The trie of rebuilt conversations against brute force."""

import hashlib
import random
import re
import zlib

import pytest

from sparquill.llm import prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, depth int, k string, f1 long, owner string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 2, "o") for r in rows], SCHEMA)


def expected(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest(), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        b = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = tuple(own.get(b, [])[:h] + ts[h:])
    nodes = {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(ts[:d], []).append(c)
    children = {}
    for node in nodes:
        if node:
            children.setdefault(node[:-1], []).append(node)
    saved = {n: (len(m) - 1) * len(WORD.findall(n[-1][1])) if n else 0 for n, m in nodes.items()}
    leaves = {n: int(n not in children) for n in nodes}
    for node in sorted(nodes, key=len, reverse=True):
        if node:
            saved[node[:-1]] += saved[node]
            leaves[node[:-1]] += leaves[node]
    return sorted(
        (min(m), len(n), min(nodes[n[:-1]]) if n else -1, len(m), len(children.get(n, [])), leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(n)))).encode()).hexdigest())
        for n, m in nodes.items()
    )


def got(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == cols
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.collect())


def made(seed, convs=150):
    draw = random.Random(seed)
    words = ["a", "bb", "c c", "", "d\n e", "long " * 40]
    rows = []
    for c in range(convs):
        if c % 17 == 4:
            continue  # an absent base now and then
        for t in range(draw.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t, draw.choice(["user", "bot"]), draw.choice(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    rows = made(seed)
    assert got(prefix_trie.trie(table(spark, rows))) == expected(rows)


def test_absent_bases_nulls_ties_and_repeated_rows(spark):
    rows = [r for r in made(3, 60) if r[0] % 20] + [(None, 0, "user", "x"), (5, None, None, None), (5, None, "user", "n"), (7, 1, "u", "t"), (7, 1, "u", "t"), (-3, 0, "u", "minus"), (-23, 0, "u", "minus"), (-20, 4, "u", "t")]
    assert got(prefix_trie.trie(table(spark, rows))) == expected(rows)
    assert prefix_trie.trie(table(spark, [])).collect() == []
    assert prefix_trie.trie(table(spark, [(None, 1, "a", "b")])).collect() == []


def test_a_long_conversation_over_many_partitions_and_copies(spark):
    """One conversation holds most rows; many are equal to each other."""
    long = [(40, t, "user", f"turn {t % 7}") for t in range(1500)] + [(41, t, "user", f"turn {t % 7}") for t in range(1400)]
    copies = [(c, t, "u", f"hello {t}") for c in range(100, 500) for t in range(3)]
    rows = long + copies
    random.Random(1).shuffle(rows)
    assert got(prefix_trie.trie(table(spark, rows))) == expected(rows)


def test_a_collision_draws_new_bases(spark, monkeypatch):
    """With base 1 a fingerprint is a sum, so turns in another order collide; the stored turns show it."""
    rows = [(c, t, "u", x) for c, said in ((20, "ab"), (40, "ba"), (60, "bac")) for t, x in enumerate(said)]
    used, proper = [], prefix_trie.bases
    monkeypatch.setattr(prefix_trie, "bases", lambda attempt: used.append(attempt) or ((1, 1) if attempt == 0 else proper(attempt)))
    assert got(prefix_trie.trie(table(spark, rows))) == expected(rows) and used == [0, 1]
