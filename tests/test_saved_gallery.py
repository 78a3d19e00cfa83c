"""The saved gallery against brute force, for every probe."""

import numpy as np

from bindings import vectors

SF = "/root/testdata/sf0.001"


def test_every_probe_is_searched_in_the_saved_gallery(spark):
    q = {r.query_id: np.array(r.embedding, float) for r in vectors.probes(spark, SF).collect()}
    g = sorted((r.vec_id, np.array(r.embedding, float)) for r in vectors.gallery(spark, SF).select("vec_id", "embedding").collect())
    ids, points = np.array([i for i, _ in g]), np.array([v for _, v in g])
    heads = points[:16]
    cells = ((points[:, None] - heads) ** 2).sum(-1).argmin(1)
    got = {}
    for r in vectors.knn_saved_gallery(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.distance))
    assert set(got) == set(q)
    for i, v in q.items():
        near = np.isin(cells, ((heads - v) ** 2).sum(1).argsort(kind="stable")[:4])
        d = np.sqrt(((points[near] - v) ** 2).sum(1))
        at = np.lexsort((ids[near], d))[:10]
        assert [k for k, _ in got[i]] == ids[near][at].tolist()
        assert np.allclose([x for _, x in got[i]], d[at], atol=2e-5)
