"""Whitening against exact sums and numpy's own eigenvectors."""

import math

import numpy as np
import pytest

from sparquill.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, h int, n int, y double"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 0.5) for r in rows], SCHEMA)


def scaled(v):
    return tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)


def check(rows, got, weights="one"):
    sound = [(i, scaled(v)) for i, v in rows if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    for dim in {len(x) for _, x in sound}:
        every = [x for _, x in sound if len(x) == dim]
        fit = sorted(set(every)) if weights == "one" else every
        n, k = len(fit), min(16, dim)
        sums = [sum(c) for c in zip(*fit, strict=True)]
        c = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for x in fit])
        value, vector = np.linalg.eigh(c.T @ c / n)
        value, vector = value[::-1], vector[:, ::-1]
        mine = [r for r in got if any(r.vec_id == i and len(x) == dim for i, x in sound)]
        assert len(mine) == k * len(every)
        by_id = {}
        for r in mine:
            by_id.setdefault(r.vec_id, []).append(r)
        signs = {}
        for i, x in sound:
            if len(x) != dim:
                continue
            rs = sorted(by_id[i], key=lambda r: r.component)
            assert sorted({r.component for r in rs}) == list(range(1, k + 1))
            for r in rs:
                assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
                e, u = value[r.component - 1], vector[:, r.component - 1]
                assert r.explained == pytest.approx(e / value.sum(), rel=1e-8) and r.identity_error < 1e-8
                want = float(np.array([(n * a - s) / n for a, s in zip(x, sums, strict=True)]) @ u) / math.sqrt(e)
                if abs(want) > 1e-6:
                    sign = 1 if want * r.whitened > 0 else -1
                    assert signs.setdefault(r.component, sign) == sign
                assert abs(r.whitened) == pytest.approx(abs(want), abs=1e-6)


def made(n, dim, seed):
    draw = np.random.default_rng(seed)
    return [(k, (draw.normal(size=dim) * (1 + np.arange(dim))).tolist()) for k in range(n)]


@pytest.mark.parametrize("weights", ["one", "count"])
def test_copies_count_once_or_each(spark, weights):
    rows = made(80, 20, 1)
    rows += [(1000 + k, rows[3][1]) for k in range(60)] + [(2000 + k, [c + 1e-4 * (math.floor(64 * c) == math.floor(64 * (c + 1e-4))) for c in rows[5][1]]) for k in range(9)]
    rows += [(3000, None), (3001, [1.0] * 19 + [None]), (3002, [float("nan")] * 20), (3003, [float("inf")] + [0.0] * 19), (3004, [])]
    got = whitening.whiten(table(spark, rows), weights=weights).collect()
    check(rows, got, weights)
    assert not {r.vec_id for r in got} & {3000, 3001, 3002, 3003, 3004}


def test_lengths_are_fitted_apart_and_repeated_rows_stay(spark):
    rows = made(40, 5, 2) + [(500 + i, v) for i, v in made(30, 3, 3)]
    check(rows, whitening.whiten(table(spark, rows)).collect())
    twice = whitening.whiten(table(spark, [*rows, rows[0], (None, rows[1][1])])).collect()
    assert len(twice) == len(rows[:40]) * 5 + 30 * 3 + 10 and sum(r.vec_id is None for r in twice) == 5


def test_empty_tables_and_no_variance(spark):
    assert whitening.whiten(table(spark, [])).collect() == [] and whitening.whiten(table(spark, [(1, None)])).collect() == []
    assert whitening.whiten(table(spark, [])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = whitening.whiten(table(spark, [(1, [0.5, 2.0]), (2, [0.5, 2.0])])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got) == [(i, c, 1, 0, None, 0.0, 0.0) for i in (1, 2) for c in (1, 2)]
    flat = whitening.whiten(table(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [2.0, 1.0])])).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in flat) and {round(r.whitened, 9) for r in flat if r.component == 1 and r.vec_id == 2} == {0.0}


def test_huge_entries(spark):
    got = whitening.whiten(table(spark, [(1, [3e38, 1.0]), (2, [-3e38, 1.0]), (3, [0.0, 5.0]), (4, [1e12, 2.0])])).collect()
    assert len(got) == 8 and all(r.deviation is None for r in got if r.vec_id in (1, 2)) and all(r.n == 4 for r in got)


def test_the_given_table(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    check(rows, whitening.whiten(df).collect())
