"""Components, n-gram Jaccard join and near-duplicate vectors against brute force."""

import collections
import itertools
import random
import re

import numpy as np
import pytest

from sparquill.llm import graph, jaccard, near_vectors

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(n, links):
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]


def test_components(spark):
    draw = random.Random(4)
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(draw.randint(200, 400), draw.randint(200, 400)) for _ in range(90)] + [(5, 5), (3, 2)]
    want = roots(401, links)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: want[x] for x in touched}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def expected_groups(rows):
    sets = [shingles(t) for _, t in rows]
    linked = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = roots(len(rows), linked)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(i, least.get(root[k], i))
    return [(i, len(sets[k]), least.get(root[k]) if sets[k] else i) for k, (i, _) in enumerate(rows)]


def near_copies(seed, groups=25):
    """Groups of copies from light to heavy editing, around the threshold, over a small vocabulary with shared passages."""
    draw, rows = random.Random(seed), []
    vocabulary = [f"w{k}" for k in range(300)]
    passage = [draw.choice(vocabulary) for _ in range(60)]
    for _ in range(groups):
        base = [draw.choice(vocabulary) for _ in range(draw.choice((3, 5, 8, 30, 90, 200)))]
        if draw.random() < 0.4:
            base = base + passage
        for _ in range(draw.choice((1, 2, 3, 9))):
            copy = list(base)
            for _ in range(draw.choice((0, 0, 1, 1, 2, 3, 5))):
                at = draw.randrange(len(copy))
                if draw.random() < 0.5:
                    copy[at] = draw.choice(vocabulary)
                elif draw.random() < 0.5:
                    copy.insert(at, "new")
                else:
                    del copy[at : at + draw.randint(0, 4)]
                copy = copy or ["x"]
            rows.append((draw.randint(0, 10**6), ("  " if draw.random() < 0.3 else " ").join(w.upper() if draw.random() < 0.1 else w for w in copy)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_groups(docs, seed):
    rows = near_copies(seed) + [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE\ttwo"), (5, "one two"), (6, "É a b c d e"), (7, "é a b c d e"), (None, "one two three"), (8, "one two three"), (None, "alone without an id")]
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.groups(docs(rows)).collect())
    assert got == collections.Counter(expected_groups(rows))


def test_a_large_group_around_the_threshold(docs):
    """Lists of hundreds of sets: chains first, then what is left."""
    draw, rows = random.Random(8), []
    for k in range(220):
        words = [f"w{j}" for j in range(90)]
        for _ in range(draw.choice((0, 1, 2, 3))):
            words[draw.randrange(90)] = f"x{draw.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, " ".join(f"w{j}" for j in range(90 - k))) for k in range(0, 60, 4)]
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.groups(docs(rows)).collect())
    assert got == collections.Counter(expected_groups(rows))


def test_long_lists_are_cut_into_blocks(monkeypatch):
    """Lists longer than a block give the pairs that all pairs would give."""
    draw = np.random.default_rng(3)
    entries = np.empty(400, jaccard.ENTRY)
    entries["h"], entries["rid"], entries["cls"] = draw.integers(0, 3, 400), np.arange(400), draw.integers(0, 40, 400)
    entries["n"] = draw.integers(1, 60, 400)
    entries["pos"] = draw.integers(0, 15, 400) % entries["n"]
    found = {(min(a, b), max(a, b)) for x, y in jaccard._listed(entries) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    want = set()
    for a, b in itertools.permutations(entries, 2):
        if a["h"] == b["h"] and (a["n"], a["rid"]) < (b["n"], b["rid"]) and jaccard._possible(np.array([a]), np.array([b]))[0]:
            want.add((min(a["rid"], b["rid"]), max(a["rid"], b["rid"])))
    assert found == want and len(want) > 50
    unsettled: list = []
    chained = {(min(a, b), max(a, b)) for x, y in jaccard._listed(entries, False, unsettled) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    assert chained < want and sum(map(len, unsettled)) == 400
    monkeypatch.setattr(jaccard, "BLOCK", 1000)
    assert want == {(min(a, b), max(a, b)) for x, y in jaccard._listed(entries) for a, b in zip(x.tolist(), y.tolist(), strict=True)}


def test_sets_of_many_classes_are_never_pairs(docs, monkeypatch):
    """A group whose sets share most shingles but are not linked, with some that are: blocks of sets meet, and the rows of a step grow with the sets."""
    draw, rows = random.Random(12), []
    for k in range(300):
        words = [f"w{j}" for j in range(80)]
        for at in draw.sample(range(80), 3) if k < 280 else (k % 3, 40, 60 + k % 4):
            words[at] = f"x{k}y{at}" if k < 290 or at > 9 else f"x{at}"
        rows.append((k, " ".join(words)))
    made = []
    across = jaccard._across

    def counted(*given):
        made.append(across(*given))
        return made[-1]

    monkeypatch.setattr(jaccard, "_across", counted)
    for shingles_ in (jaccard.BLOCK_SHINGLES, 2000):
        monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", shingles_)
        got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.groups(docs(rows)).collect())
        assert got == collections.Counter(expected_groups(rows)) and 200 < len({c for _, _, c in got}) < 300
    assert len(made) == 2 and all(df.count() < 300 for df in made)


def test_links_of_two_blocks_join_classes_once():
    import pyarrow as pa

    draw = np.random.default_rng(5)
    words = [[f"w{j}" if draw.random() > 0.01 * (k % 8) else f"x{k}-{j}" for j in range(60)] for k in range(60)]
    sets = [shingles(" ".join(w)) for w in words]
    linked = [(a, b) for a, b in itertools.combinations(range(60), 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for side in (np.zeros(60, int), np.arange(60) % 2):
        columns = [np.zeros(60, int), np.full(60, side.max()), side, np.arange(60), np.arange(60)]
        batch = pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array([" ".join(w) for w in words])], names=["x", "y", "side", "rid", "cls", "text"])
        found = [p for b in jaccard._compared(iter([batch.slice(0, 25), batch.slice(25)])) for p in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        want = [(a, b) for a, b in linked if side[a] != side[b] or side.max() == 0]
        assert {(min(p), max(p)) for p in found} <= set(want) and len(found) < 60
        assert roots(60, found) == roots(60, want) and 5 < len(set(roots(60, want))) < 60


def test_few_entries_are_packed_into_few_rows():
    """The number of packed rows grows with the entries, not with the square of the partitions."""
    for total in (0, 1000, 5_000_000, 10**10):
        for partitions in (1, 8, 211, 2000):
            tasks, parts = jaccard._dealt(total, 50_000, partitions)
            needed = max(1, -(-total // 4 // jaccard.ENTRIES))
            assert tasks == max(partitions, needed) and 4 * needed <= parts <= 16 * tasks
            assert parts * partitions <= max(4 * needed * partitions, total // 4 // jaccard.PACK)


def test_one_of_each_group_stays(docs):
    rows = near_copies(7, 8) + [(1, None), (2, ""), (5, "one two"), (5, "one two"), (6, "One two"), (None, "no id here"), (None, "no  id here")]
    table = docs(rows)
    out = jaccard.keep_one(table)
    assert out.columns == table.columns
    want = collections.Counter({(i, c) for i, n, c in expected_groups(rows) if i == c and n and i is not None} | {(1, 1), (2, 2)})
    got = [(r.doc_id, r.doc_id) for r in out.collect() if r.doc_id is not None]
    assert collections.Counter(got) == want
    assert out.where("doc_id is null").count() == 1


def test_groups_of_an_empty_table(docs):
    assert jaccard.groups(docs([])).collect() == [] and jaccard.keep_one(docs([])).collect() == []


def vector_rows(seed, n=260, dim=24):
    draw = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        centre = draw.normal(size=dim)
        for _ in range(int(draw.choice([1, 1, 2, 7, 15]))):
            rows.append([float(x) for x in (centre + draw.normal(size=dim) * draw.choice([0.0, 0.2, 0.3, 0.33]) * 1.0) * draw.choice([1e-3, 1.0, 50.0])])
    return [(1000 + k, v) for k, v in enumerate(rows)]


def expected_vectors(rows, threshold=0.9):
    units = []
    for _, v in rows:
        sound = v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        units.append(np.array(v) / np.abs(v).max() / np.linalg.norm(np.array(v) / np.abs(v).max()) if sound else None)
    linked = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold]
    root, degree, least = roots(len(rows), linked), collections.Counter(x for link in linked for x in link), {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(i, least.get(root[k], i))
    return collections.Counter((i, degree[k], least.get(root[k]), i == least.get(root[k])) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("block, tile, lead", [(8192, 1024, 16), (50, 16, 2)])
def test_near_vectors(spark, monkeypatch, block, tile, lead):
    for name, value in (("BLOCK", block), ("TILE", tile), ("LEAD", lead)):
        monkeypatch.setattr(near_vectors, name, value)
    rows = vector_rows(block)
    rows += [(1, None), (2, []), (3, [0.0] * 24), (4, [float("nan")] + [1.0] * 23), (5, [None] + [1.0] * 23), (6, [float("inf")] * 24), (7, [1.0]), (8, [3.0]), (9, [-1.0]), (7, [1.0]), (None, [0.0, 1.0]), (10, [0.0, 2.0]), (None, [9.0, 0.0]), (11, [1e300] * 24), (12, [2e300] * 24)]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, n_links int, kept int")
    got = collections.Counter(tuple(r) for r in near_vectors.near_groups(table).collect())
    assert got == expected_vectors(rows)


def test_vectors_of_an_empty_table(spark):
    assert near_vectors.near_groups(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_pairs_stop_early_without_losing_any():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(300, 40)) * np.linspace(3, 0.1, 40)
    x[100:200] = x[:100] + draw.normal(size=(100, 40)) * 0.4
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    i, j = near_vectors.linked_pairs(x, x, axes, 0.9, True)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(a, b) for a, b in itertools.combinations(range(300), 2) if x[a] @ x[b] >= 0.9}
