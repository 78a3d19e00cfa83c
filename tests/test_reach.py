import numpy as np
import pytest

from sparquill.operators import knn as ok


@pytest.mark.parametrize("metric", ["euclidean", "minkowski", "dot_product", "cosine"])
def test_rows_out_of_reach_by_size_are_not_compared(metric, monkeypatch):
    draw, k = np.random.default_rng(3), 3
    q = draw.normal(size=(40, 16))
    q /= np.linalg.norm(q, axis=1)[:, None]
    g = np.concatenate([q + draw.normal(scale=0.02, size=q.shape) for _ in range(40)]) * (1 + np.arange(1600) // 40 % 8)[:, None]
    g[200:210] = g[100]  # rows that tie
    looked = []
    within = ok.within
    monkeypatch.setattr(ok, "within", lambda lower, *rest: looked.append(lower.size) or within(lower, *rest))
    every = ok.exact_keys(np.repeat(q, len(g), axis=0), np.tile(g, (len(q), 1)), metric, 3.0).reshape(len(q), -1)
    want = [sorted(zip(row, range(len(g))))[:k] for row in every]
    for edge in (np.full(len(q), np.inf), np.sort(every, axis=1)[:, k - 1]):
        best, looked[:] = ok.Best(k), []
        best.add_all((probe, key, column) for probe, column, key in ok.near_vectors(q, g, k, metric, 3.0, edge))
        assert [list(zip(best.key[best.probe == i], best.id[best.probe == i])) for i in range(len(q))] == want
        if metric != "cosine":
            assert sum(looked) < 0.5 * q.shape[0] * g.shape[0]


def test_no_rows_and_zero_vectors():
    q = np.zeros((2, 4))
    assert list(ok.near_vectors(q, np.empty((0, 4)), 2, "euclidean", 3.0, np.full(2, np.inf))) == []
    for metric in ok.METRICS:
        best = ok.Best(2)
        best.add_all((p, key, c) for p, c, key in ok.near_vectors(q, np.eye(4)[:3], 2, metric, 3.0, np.full(2, np.inf)))
        assert best.id.tolist() == [0, 1, 0, 1]


@pytest.mark.parametrize("p", [0.5, 1.0, 60.0])
def test_any_power_finds_the_nearest(p):
    draw = np.random.default_rng(5)
    q, g = draw.normal(size=(9, 6)) + 2e6, draw.normal(size=(900, 6)) + 2e6
    best = ok.Best(4)
    for part in (slice(0, 500), slice(500, 900)):
        best.add_all((probe, key, column + part.start) for probe, column, key in ok.near_vectors(q, g[part], 4, "minkowski", p, best.edge(len(q))))
    every = ok.exact_keys(np.repeat(q, len(g), axis=0), np.tile(g, (len(q), 1)), "minkowski", p).reshape(len(q), -1)
    assert best.id.reshape(len(q), 4).tolist() == np.argsort(every, axis=1, kind="stable")[:, :4].tolist()
