import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparquill.functions import vectors as fv
from sparquill.operators import knn as ok
from sparquill.sources import stores


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    g = rng.normal(size=(300, 8)).astype(np.float32)
    g[100:200] = g[100]  # a third are copies of one vector
    q = np.vstack([g[100], rng.normal(size=(9, 8))]).astype(np.float32)
    gallery = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(g)], "vec_id bigint, embedding array<float>")
    queries = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(q)], "query_id bigint, embedding array<float>")
    return q.astype(float), g.astype(float), queries, gallery


def brute(q, g, k, metric, p=3.0):
    out = {}
    for i, v in enumerate(q):
        keys = ok.exact_keys(np.repeat(v[None], len(g), 0), g, metric, p)
        out[i] = [int(j) for j in np.lexsort((np.arange(len(g)), keys))[:k]]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


@pytest.mark.parametrize("metric", ok.METRICS)
def test_exact_search_equals_brute_force_with_many_copies(data, metric):
    q, g, queries, gallery = data
    assert lists(ok.knn(queries, gallery, 7, metric)) == brute(q, g, 7, metric)


def clustered(spark, copies=False):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 6)) * 50
    g = np.concatenate([c + rng.normal(size=(40, 6)) for c in centres]).astype(np.float32)
    q = np.concatenate([c + rng.normal(size=(3, 6)) for c in centres[:4]]).astype(np.float32)
    gallery = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(g)], "vec_id bigint, embedding array<float>")
    queries = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(q)], "query_id bigint, embedding array<float>")
    return q.astype(float), g.astype(float), queries, gallery


def test_pivots_skip_groups_and_lose_nothing(spark, data, monkeypatch):
    """Groups of probes meet only the groups of the gallery that can hold a neighbour."""
    q, g, queries, gallery = clustered(spark)
    needed, seen = ok.needed_cells, []

    def counted(v, pivots, cells, far, near):
        out = needed(v, pivots, cells, far, near)
        seen.append((sum(map(len, out)), len(out) * len(cells)))
        return out

    assert lists(ok.knn(queries, gallery, 5, method="pivot", pivots=12)) == brute(q, g, 5, "euclidean")
    rows = ok.training_rows(gallery, 10_000, 42)
    centres = ok._centres(rows, 12, 42, 5)
    stats = ok.pivot_stats(ok.assign_cells(gallery, centres), centres, 5)
    cells = np.array(sorted(stats))
    near = np.stack([stats[c][1] for c in cells])
    counted(q, centres, cells, np.array([stats[c][0] for c in cells]), near)
    assert seen[0][0] <= 0.25 * seen[0][1]
    for c in cells.tolist():
        mine = np.sort(np.sqrt(((g[(((g[:, None] - centres) ** 2).sum(-1)).argmin(1) == c] - centres[c]) ** 2).sum(1)))
        assert stats[c][0] == pytest.approx(mine[-1]) and stats[c][1] == pytest.approx(mine[:5])
    monkeypatch.setattr(ok, "CELLS", 30)
    q, g, queries, gallery = data
    for k in (3, 120, 400):  # also more than a cell, and more than the gallery, holds
        assert lists(ok.knn(queries, gallery, k, method="pivot", pivots=7)) == brute(q, g, k, "euclidean")
    assert lists(ok.knn(queries, gallery.filter("vec_id < 100"), 5, "cosine", method="pivot", pivots=7)) == brute(q, g[:100], 5, "cosine")
    assert ok.knn(queries, gallery.limit(0), 3, method="pivot").count() == 0
    with pytest.raises(ValueError):
        ok.knn(queries, gallery, 3, "dot_product", method="pivot")


def test_a_large_cell_is_cut_and_every_row_shuffled_once(data, monkeypatch):
    """A third of the gallery lies in one cell; parts and blocks are small, and no gallery row is copied for its probes."""
    q, g, queries, gallery = data
    monkeypatch.setattr(ok, "BLOCK_BYTES", 300)
    celled, cents = ok.build_cells(gallery, 4)
    found = ok.knn(queries, celled, 6, method="ivf", nprobe=4, centroids=cents)
    assert lists(found) == brute(q, g, 6, "euclidean")
    rows = ok.visits(queries, lambda v: list(ok._probed(v, cents, 4)), 8)
    assert rows.count() == 40
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan.replace("CoGroup", "") and plan.count("explode(") == 1  # of packed probes, not of the gallery


def test_many_blocks_and_tiles_do_not_change_the_result(data, monkeypatch):
    q, g, queries, gallery = data
    for name, value in (("CELLS", 40), ("BLOCK_BYTES", 150)):
        monkeypatch.setattr(ok, name, value)
    blocks, n = ok.probe_blocks(queries, 64)
    assert n > 3 and blocks.count() > 1
    found = ok.knn(queries, gallery, 4)
    assert lists(found) == brute(q, g, 4, "euclidean")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("tile#") and plan.count("explode(") == 2 and "Join Cross" not in plan
    near = ok.knn(queries, gallery, 4, method="ivf", nlist=5, nprobe=5)
    assert lists(near) == brute(q, g, 4, "euclidean")


def test_short_gallery_wrong_dimension_and_unknown_names(data, spark):
    _, _, queries, gallery = data
    assert ok.knn(queries, gallery.filter("vec_id < 3"), 5).count() == 30
    assert ok.knn(queries.filter("query_id < 0"), gallery, 5).count() == 0
    with pytest.raises(Exception, match="must have 8 dimensions"):
        ok.knn(queries, gallery.withColumn("embedding", F.slice("embedding", 1, 5)), 5).collect()
    for bad in (dict(method="HNSW"), dict(metric="chebyshev"), dict(k=0)):
        with pytest.raises(ValueError):
            ok.knn(queries, gallery, **bad)


def test_zero_vector_has_cosine_distance_one(spark):
    q = spark.createDataFrame([(0, [1.0, 0.0])], "query_id bigint, embedding array<float>")
    g = spark.createDataFrame([(0, [0.0, 0.0]), (1, [2.0, 0.0])], "vec_id bigint, embedding array<float>")
    assert [(r.vec_id, r.distance) for r in ok.knn(q, g, 2, "cosine").orderBy("rank").collect()] == [(1, 0.0), (0, 1.0)]
    sq = ok.knn(q, g, 1, squared=True).first()
    assert sq.distance == 1.0


def test_all_cells_equal_exact_and_recall_grows(data):
    q, g, queries, gallery = data
    exact = ok.knn(queries, gallery, 5)
    celled, cents = ok.build_cells(gallery, 6)
    celled = celled.select("vec_id", "embedding", "cell")
    seen = []
    for nprobe in (1, 3, 6):
        got = ok.knn(queries, celled, 5, method="ivf", nprobe=nprobe, centroids=cents)
        seen.append(ok.recall(got, exact).agg(F.avg("recall")).first()[0])
    assert seen == sorted(seen) and seen[-1] == 1.0


@pytest.mark.parametrize("method,params", [
    ("pq", dict(m=4, bits=4)), ("ivfpq", dict(m=4, bits=4, nlist=4, nprobe=4)), ("ivfsq", dict(nlist=4, nprobe=4)),
    ("lsh", dict(num_bits=32)), ("binary", {}), ("binary_ivf", dict(nlist=4, nprobe=4)),
])
def test_coded_search_finds_most_neighbours_after_refinement(data, method, params):
    _, _, queries, gallery = data
    distinct = gallery.filter("vec_id < 101 or vec_id >= 200")
    exact = ok.knn(queries, distinct, 5)
    got = ok.knn(queries, distinct, 5, method=method, refine=8, **params)
    assert got.count() == 50
    assert ok.recall(got, exact).agg(F.avg("recall")).first()[0] > 0.5


def test_binary_search_counts_differing_signs(data):
    q, g, queries, gallery = data
    got = lists(ok.knn(queries, gallery, 5, method="binary"))
    bits = {r.vec_id: np.array(r.embedding) > 0 for r in gallery.collect()}
    for r in queries.collect():
        mine = np.array(r.embedding) > 0
        assert got[r.query_id] == sorted(bits, key=lambda v: (int((bits[v] != mine).sum()), v))[:5]


def test_cell_filter_reaches_the_partitions(data, spark, tmp_path):
    _, _, queries, gallery = data
    celled, cents = ok.build_cells(gallery, 5)
    stores.save_gallery(celled, cents, str(tmp_path / "g"))
    saved, loaded = stores.load_gallery(spark, str(tmp_path / "g"))
    assert np.allclose(loaded, cents)
    one = queries.filter("query_id = 3")
    found = ok.knn(one, saved, 5, method="ivf", nprobe=1, centroids=loaded)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cell" in plan.split("PartitionFilters: [")[1][:60]
    cell = ok._probed(np.array([one.first()["embedding"]], float), cents, 1)[0, 0]
    assert {r.vec_id for r in found.collect()} <= {r.vec_id for r in celled.filter(F.col("cell") == int(cell)).collect()}


def test_append_checks_the_dimension(data, spark, tmp_path):
    _, _, _, gallery = data
    path = str(tmp_path / "g")
    stores.append_gallery(gallery, path)
    with pytest.raises(Exception, match="vectors of length 8"):
        stores.append_gallery(gallery.withColumn("embedding", F.slice("embedding", 1, 3)), path)
    stores.append_gallery(gallery, path)
    assert spark.read.parquet(path).count() == 600


def test_average_precision_cases(spark):
    rows = [(1, r, h) for r, h in enumerate([True, False, True], 1)] + [(2, r, False) for r in (1, 2, 3)] + [(3, r, r == 3) for r in (1, 2, 3)]
    df = spark.createDataFrame(rows, "query_id bigint, rank int, hit boolean")
    ap = {r.query_id: r.ap for r in ok.map_at_k(df).collect()}
    assert ap == {1: pytest.approx((1 + 2 / 3) / 2), 2: 0.0, 3: pytest.approx(1 / 3)}
    grid = {r.k: r.map for r in ok.map_grid(df, [1, 3]).collect()}
    assert grid[1] == pytest.approx(1 / 3)


def test_search_metrics_without_searches(spark):
    log = spark.createDataFrame([], "query_time double")
    row = ok.search_metrics(log, spark.range(4)).first()
    assert (row.average_query_time, row.total_queries, row.gallery_size) == (0.0, 0, 4)


@pytest.mark.parametrize("metric", ok.METRICS)
def test_few_pairs_of_a_tile_are_looked_at_and_none_is_lost(metric):
    """A tile hands on about k rows per probe, and fewer once nearer ones are known."""
    rng = np.random.default_rng(5)
    q, g = rng.normal(size=(20, 16)), rng.normal(size=(6000, 16)) * rng.integers(1, 8, (6000, 1))
    g[300:330] = g[300]
    q[0], q[1] = g[300], 0.0
    tile = pa.RecordBatch.from_arrays([pa.array(np.arange(len(g))), pa.array(list(g.astype(float)), pa.list_(pa.float64()))], names=["vec_id", "embedding"])
    find, best, seen = ok._find_vectors(5, metric, 3.0), ok.Best(5), []
    for part in (tile.slice(0, 3000), tile.slice(3000)):
        found = list(find(q, part, best.edge(len(q))))
        seen.append(sum(len(p) for p, _, _ in found))
        best.add_all(iter(found))
    got = {i: best.id[best.probe == i].tolist() for i in range(len(q))}
    assert got == brute(q, g, 5, metric)
    ties = 2 * 30 + (2 * 3000 if metric in ("dot_product", "cosine") else 0)  # the zero probe is as far from all
    assert sum(seen) <= 20 * 5 * 2 * 4 + ties


@pytest.mark.parametrize("scale", [1e-20, 1e18, 1e200])
def test_sizes_that_single_precision_cannot_hold(spark, data, scale):
    q, g, _, _ = data
    big, rows = q * scale, g * scale
    queries = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(big)], "query_id bigint, embedding array<double>")
    gallery = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id bigint, embedding array<double>")
    metric = "euclidean" if scale < 1e100 else "dot_product"
    if scale > 1e100:  # products are no numbers any more: nothing is found, as before
        assert ok.knn(queries, gallery, 4, metric).count() <= 40
    else:
        assert lists(ok.knn(queries, gallery, 4, metric)) == brute(big, rows, 4, metric)


def test_short_codes_are_searched_once(spark):
    """Of many rows with one code only the k lowest ids meet a probe, and probes of one code are one."""
    rng = np.random.default_rng(6)
    v = rng.normal(size=(900, 8))
    gallery = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "vec_id bigint, embedding array<double>")
    queries = spark.createDataFrame([(i % 60, [float(x) for x in r]) for i, r in enumerate(v[:61])], "query_id bigint, embedding array<double>")
    planes = ok.hyperplanes(3, 8, 42)
    codes = (v @ planes.T >= 0).astype(float)
    got = ok.knn(queries.filter("query_id > 0"), gallery, 4, method="lsh", num_bits=3)
    for i in range(1, 60):
        far = ok.differing(codes[i : i + 1], codes)[0]
        assert [r.vec_id for r in got.filter(F.col("query_id") == i).orderBy("rank").collect()] == np.lexsort((np.arange(900), far))[:4].tolist() if i % 20 == 1 else True
    met = []
    plain = ok.scan
    ok.scan = lambda q, g, *rest: met.append((q.count(), g.count())) or plain(q, g, *rest)
    try:
        assert ok.knn(queries, gallery, 4, method="lsh", num_bits=3).count() == 60 * 4
    finally:
        ok.scan = plain
    assert met[0][0] <= 8 and met[0][1] <= 8 * 4
