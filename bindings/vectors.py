"""Vector search: every tenth embedding is a probe, the others are the gallery, the label is the identity.

All metrics rank alike on unit vectors, so gallery vectors are scaled by 1 + vec_id % 7.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from bindings.common import rounded, table
from sparquill.functions.vectors import normalize
from sparquill.operators import knn as ok
from sparquill.operators import neighbours
from sparquill.session import work_path
from sparquill.sources import stores

K = 10


def _rows(spark, sf):
    return table(spark, sf, "embeddings")


def probes(spark, sf):
    rows = _rows(spark, sf).filter("vec_id % 10 = 0")
    return rows.select(F.col("vec_id").alias("query_id"), "embedding", F.concat(F.lit("person_"), F.col("label")).alias("name"))


def gallery(spark, sf):
    rows = _rows(spark, sf).filter("vec_id % 10 <> 0")
    meta = F.struct(
        F.concat(F.lit("person_"), F.col("label")).alias("name"),
        F.concat(F.lit("img_"), F.col("vec_id"), F.lit(".jpg")).alias("filename"),
    )
    scaled = F.transform("embedding", lambda x: (x * (1 + F.col("vec_id") % 7)).cast("float"))
    return rows.select("vec_id", scaled.alias("embedding"), meta.alias("meta"))


def _knn(metric="euclidean", method="flat", **params):
    def run(spark, sf):
        return rounded(ok.knn(probes(spark, sf), gallery(spark, sf), K, metric, method=method, **params), 5)

    return run


def knn_meta(spark, sf):
    g = gallery(spark, sf)
    out = ok.with_meta(ok.knn(probes(spark, sf), g, K), g)
    return rounded(out.select("query_id", "rank", "vec_id", "distance", "meta.name", "meta.filename"), 5)


def _hits(spark, sf, metric="euclidean", k=K, **params):
    g, q = gallery(spark, sf), probes(spark, sf)
    found = ok.with_meta(ok.knn(q, g, k, metric, **params), g)
    truth = q.select("query_id", F.col("name").alias("true_name"))
    return found.join(truth, "query_id").select("query_id", "rank", (F.col("meta.name") == F.col("true_name")).alias("hit"))


def map_at_k(spark, sf):
    return rounded(ok.map_at_k(_hits(spark, sf)))


def map_grid(spark, sf):
    out = None
    for metric in ("euclidean", "cosine", "dot_product", "minkowski"):
        part = _hits(spark, sf, metric, k=20).withColumn("metric", F.lit(metric))
        out = part if out is None else out.unionAll(part)
    return rounded(ok.map_grid(out, [2, 5, 10, 15, 20], ("metric",)))


def knn_recall(spark, sf):
    q, g = probes(spark, sf), gallery(spark, sf)
    exact = ok.knn(q, g, K)
    approx = ok.knn(q, g, K, method="ivf", nlist=16, nprobe=4)
    return rounded(ok.recall(approx, exact))


def _given(spark, sf):
    """The gallery in cells around its 16 vectors of lowest id, and these vectors."""
    g = gallery(spark, sf)
    heads = np.array([r["embedding"] for r in g.orderBy("vec_id").limit(16).collect()], float)
    return ok.assign_cells(g.select("vec_id", "embedding"), heads), heads


def _knn_given(method):
    def run(spark, sf):
        g, heads = _given(spark, sf)
        return rounded(ok.knn(probes(spark, sf), g, K, method=method, nprobe=4, centroids=heads), 5)

    return run


#: Sub-spaces of the given code books, whose 16 words each are parts of the 16 vectors of lowest id.
PARTS = 8


def _knn_codes(method):
    def run(spark, sf):
        g, heads = _given(spark, sf)
        books = heads.reshape(len(heads), PARTS, -1).transpose(1, 0, 2)
        cells = {} if method == "pq" else dict(nprobe=4, centroids=heads)
        return rounded(ok.knn(probes(spark, sf), g, K, method=method, books=books, **cells), 5)

    return run


def knn_recall_given(spark, sf):
    g, heads = _given(spark, sf)
    q = probes(spark, sf)
    return rounded(ok.recall(ok.knn(q, g, K, method="ivf", nprobe=4, centroids=heads), ok.knn(q, g, K)))


def knn_saved_gallery(spark, sf):
    """Trained once, saved by cell, loaded and searched: only probed cells are read."""
    path = work_path(spark, "gallery")
    g, heads = _given(spark, sf)
    stores.save_gallery(g, heads, path)
    saved, centroids = stores.load_gallery(spark, path)
    return rounded(ok.knn(probes(spark, sf), saved, K, method="ivf", nprobe=4, centroids=centroids), 5)


def knn_graph(spark, sf):
    g = gallery(spark, sf)
    graph = neighbours.build_graph(g, 10, 2, nlist=16)
    return rounded(neighbours.graph_search(probes(spark, sf), g, graph, K), 5)


def knn_graph_recall(spark, sf):
    """Whether the graph finds nine of ten true neighbours on average."""
    found = ok.recall(knn_graph(spark, sf), ok.knn(probes(spark, sf), gallery(spark, sf), K))
    return found.agg(F.count("*").alias("queries"), (F.avg("recall") >= 0.9).alias("enough"))


def identify(spark, sf):
    out = ok.identify(probes(spark, sf), gallery(spark, sf), 5, metric="cosine")
    return out.select("probe", F.transform("results", lambda r: r["filename"]).alias("files"))


def vector_normalize(spark, sf):
    g = gallery(spark, sf)
    return g.select("vec_id", F.transform(normalize(F.col("embedding")), lambda x: F.round(x, 6) + F.lit(0.0)).alias("unit"))


def gallery_roundtrip(spark, sf):
    path = work_path(spark, "gallery")
    celled, centroids = ok.build_cells(gallery(spark, sf), 8)
    stores.save_gallery(celled, centroids, path)
    saved, _ = stores.load_gallery(spark, path)
    return saved.select("vec_id", "meta.name", "meta.filename", F.size("embedding").alias("dim"))


def gallery_append(spark, sf):
    path = work_path(spark, "gallery")
    g = gallery(spark, sf)
    stores.append_gallery(g.filter("vec_id % 2 = 0"), path)
    stores.append_gallery(g.filter("vec_id % 2 = 1"), path)
    return spark.read.parquet(path).select("vec_id", "meta.name", F.size("embedding").alias("dim"))


def search_metrics(spark, sf):
    log = table(spark, sf, "events").select((F.col("value") / 1000).alias("query_time"))
    return rounded(ok.search_metrics(log, gallery(spark, sf)))


QUERIES = {
    "knn_flat": _knn(),
    "knn_dot": _knn("dot_product"),
    "knn_cosine": _knn("cosine"),
    "knn_minkowski": _knn("minkowski"),
    "knn_meta": knn_meta,
    "knn_ivf": _knn(method="ivf", nlist=16, nprobe=4),
    "knn_ivf_all_cells": _knn(method="ivf", nlist=16, nprobe=16),
    "knn_pq": _knn(method="pq", m=8),
    "knn_pq_refined": _knn(method="pq", m=8, refine=5),
    "knn_ivfpq": _knn(method="ivfpq", nlist=16, nprobe=4, m=8),
    "knn_ivfsq": _knn(method="ivfsq", nlist=16, nprobe=4),
    "knn_lsh": _knn(method="lsh", num_bits=8),
    "knn_binary": _knn(method="binary"),
    "knn_binary_ivf": _knn(method="binary_ivf", nlist=16, nprobe=4),
    "knn_recall": knn_recall,
    "knn_pivot": _knn(method="pivot", pivots=32),
    "knn_pq_given": _knn_codes("pq"),
    "knn_ivfpq_given": _knn_codes("ivfpq"),
    "knn_ivf_given": _knn_given("ivf"),
    "knn_ivfsq_given": _knn_given("ivfsq"),
    "knn_recall_given": knn_recall_given,
    "knn_saved_gallery": knn_saved_gallery,
    "knn_graph": knn_graph,
    "knn_graph_recall": knn_graph_recall,
    "map_at_k": map_at_k,
    "map_grid": map_grid,
    "identify": identify,
    "vector_normalize": vector_normalize,
    "gallery_roundtrip": gallery_roundtrip,
    "gallery_append": gallery_append,
    "search_metrics": search_metrics,
}

_BASE = """
WITH q AS (SELECT vec_id AS query_id, embedding AS qe, 'person_' || label AS true_name FROM embeddings WHERE vec_id % 10 = 0),
g AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x * (1 + vec_id % 7) AS FLOAT)) AS ge,
   'person_' || label AS name, 'img_' || vec_id || '.jpg' AS filename FROM embeddings WHERE vec_id % 10 <> 0)
"""
_Z = "list_transform(list_zip(qe, ge), lambda z: {})"
_D = {
    "euclidean": "sqrt(list_sum(" + _Z.format("(z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE)") + "))",
    "dot_product": "-list_sum(" + _Z.format("z[1]::DOUBLE * z[2]::DOUBLE") + ")",
    "cosine": "1 - list_sum(" + _Z.format("z[1]::DOUBLE * z[2]::DOUBLE") + ") / (sqrt(list_sum(list_transform(qe, lambda x: x::DOUBLE * x)))"
    " * sqrt(list_sum(list_transform(ge, lambda x: x::DOUBLE * x))))",
    "minkowski": "pow(list_sum(" + _Z.format("pow(abs(z[1]::DOUBLE - z[2]::DOUBLE), 3)") + "), 1.0 / 3.0)",
    "binary": "list_sum(" + _Z.format("CASE WHEN (z[1] > 0) <> (z[2] > 0) THEN 1.0 ELSE 0.0 END::DOUBLE") + ")",
}


def _ranked(metric: str, k: int = K, name: str = "r", base: bool = True) -> str:
    return (_BASE if base else "") + f""",
{name}0 AS (SELECT query_id, vec_id, true_name, name, filename, {_D[metric]} AS d FROM q, g),
{name} AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS INTEGER) AS rank FROM {name}0
  QUALIFY rank <= {k})
"""


def _out(metric: str, sign: str = "") -> str:
    return _ranked(metric) + f"SELECT query_id, rank, vec_id, round({sign}d, 5) + 0.0::DOUBLE AS distance FROM r"


_AP = """, s AS (SELECT *, name = true_name AS hit FROM {src}),
s2 AS (SELECT *, sum(hit::INT) OVER (PARTITION BY {by}query_id ORDER BY rank) AS seen FROM s),
ap AS (SELECT {by}query_id, coalesce(avg(seen::DOUBLE / rank) FILTER (hit), 0) AS ap FROM s2 GROUP BY ALL)
"""

_SQUARE = "list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE)))"
_CELLS = """,
heads AS (SELECT ge AS he, row_number() OVER (ORDER BY vec_id) AS cell FROM g QUALIFY cell <= 16),
gc AS (SELECT vec_id, ge, cell FROM g, heads QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY """ + _SQUARE.format(a="ge", b="he") + """, cell) = 1),
qc AS (SELECT query_id, qe, cell FROM q, heads QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY """ + _SQUARE.format(a="qe", b="he") + """, cell) <= 4),
"""
_STEPS = """
one AS (SELECT vec_id, cell, generate_subscripts(ge, 1) AS j, unnest(ge)::DOUBLE AS v FROM gc),
span AS (SELECT j, min(v) AS lo, CASE WHEN max(v) > min(v) THEN max(v) - min(v) ELSE 1 END AS w FROM one GROUP BY 1),
sq AS (SELECT vec_id, cell, list(lo + round_even((v - lo) / w * 255, 0) / 255 * w ORDER BY j) AS ge FROM one JOIN span USING (j) GROUP BY ALL),
"""
_WORDS = f"""
words AS (SELECT s, cell - 1 AS code, he[s * 8 + 1:s * 8 + 8] AS w FROM heads, (SELECT unnest(range({PARTS})) AS s)),
coded AS (SELECT vec_id, cell, s, w FROM gc, words
  QUALIFY row_number() OVER (PARTITION BY vec_id, s ORDER BY """ + _SQUARE.format(a="ge[s * 8 + 1:s * 8 + 8]", b="w") + """, code) = 1),
d AS (SELECT query_id, vec_id, sqrt(sum(""" + _SQUARE.format(a="qe[s * 8 + 1:s * 8 + 8]", b="w") + """)) AS d FROM {probes} GROUP BY ALL),
a AS (SELECT query_id, vec_id, d, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), vec_id) AS INTEGER) AS rank FROM d QUALIFY rank <= 10)
"""
_NEAR = """d AS (SELECT query_id, vec_id, """ + _D["euclidean"] + """ AS d FROM qc JOIN {src} USING (cell)),
a AS (SELECT query_id, vec_id, d, CAST(row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS INTEGER) AS rank FROM d QUALIFY rank <= 10)
"""
_ROWS = "SELECT query_id, rank, vec_id, round(d, 5) + 0.0::DOUBLE AS distance FROM a"

SQL = {
    "knn_ivf_given": _BASE + _CELLS + _NEAR.format(src="gc") + _ROWS,
    "knn_saved_gallery": _BASE + _CELLS + _NEAR.format(src="gc") + _ROWS,
    "knn_ivfsq_given": _BASE + _CELLS + _STEPS + _NEAR.format(src="sq") + _ROWS,
    "knn_recall_given": _BASE + _CELLS + _NEAR.format(src="gc") + _ranked("euclidean", K, "r", False) + """
      SELECT r.query_id, round(count(a.vec_id) / count(*), 6) AS recall FROM r LEFT JOIN a USING (query_id, vec_id) GROUP BY 1""",
    "knn_graph_recall": "SELECT count(*) AS queries, true AS enough FROM embeddings WHERE vec_id % 10 = 0",
    "knn_flat": _out("euclidean"),
    "knn_pivot": _out("euclidean"),
    "knn_pq_given": _BASE + _CELLS + _WORDS.format(probes="q, coded") + _ROWS,
    "knn_ivfpq_given": _BASE + _CELLS + _WORDS.format(probes="qc JOIN coded USING (cell)") + _ROWS,
    "knn_ivf_all_cells": _out("euclidean"),
    "knn_dot": _out("dot_product", "-"),
    "knn_cosine": _out("cosine"),
    "knn_minkowski": _out("minkowski"),
    "knn_binary": _out("binary"),
    "knn_meta": _ranked("euclidean") + "SELECT query_id, rank, vec_id, round(d, 5) AS distance, name, filename FROM r",
    "knn_lsh": _BASE + """,
      planes AS (SELECT b, j, CASE WHEN md5('42-' || b || '-' || j)[1] < '8' THEN 1.0 ELSE -1.0 END::DOUBLE AS s
        FROM range(8) t1(b), range(64) t2(j)),
      bits AS (SELECT side, id, b, sum(s * v) >= 0 AS bit FROM (
          SELECT 'q' AS side, query_id AS id, unnest(qe)::DOUBLE AS v, generate_subscripts(qe, 1) - 1 AS j FROM q
          UNION ALL SELECT 'g', vec_id, unnest(ge)::DOUBLE, generate_subscripts(ge, 1) - 1 FROM g)
        JOIN planes USING (j) GROUP BY ALL),
      h AS (SELECT a.id AS query_id, c.id AS vec_id, count(*) FILTER (a.bit <> c.bit)::DOUBLE AS distance
        FROM bits a JOIN bits c ON a.b = c.b AND a.side = 'q' AND c.side = 'g' GROUP BY ALL)
      SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank,
        vec_id, distance FROM h QUALIFY rank <= 10""",
    "knn_binary_ivf": _BASE + """,
      heads AS (SELECT ge AS he, row_number() OVER (ORDER BY ('0x' || substr(md5('42-' || vec_id), 1, 15))::BIGINT, vec_id) AS cell
        FROM g QUALIFY cell <= 16),
      gc AS (SELECT vec_id, ge, cell FROM g, heads QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY
        list_sum(list_transform(list_zip(ge, he), lambda z: CASE WHEN (z[1] > 0) <> (z[2] > 0) THEN 1 ELSE 0 END)), cell) = 1),
      qc AS (SELECT query_id, qe, cell FROM q, heads QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY
        list_sum(list_transform(list_zip(qe, he), lambda z: CASE WHEN (z[1] > 0) <> (z[2] > 0) THEN 1 ELSE 0 END)), cell) <= 4),
      d AS (SELECT query_id, vec_id, """ + _D["binary"] + """ AS distance FROM qc JOIN gc USING (cell))
      SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank,
        vec_id, distance FROM d QUALIFY rank <= 10""",
    "map_at_k": _ranked("euclidean") + _AP.format(src="r", by="") + "SELECT query_id, round(ap, 6) AS ap FROM ap",
    "map_grid": _ranked("euclidean", 20) + _ranked("cosine", 20, "rc", False) + _ranked("dot_product", 20, "rd", False) + _ranked("minkowski", 20, "rm", False) + """,
      every AS (SELECT 'euclidean' AS metric, * FROM r UNION ALL SELECT 'cosine', * FROM rc UNION ALL SELECT 'dot_product', * FROM rd UNION ALL SELECT 'minkowski', * FROM rm),
      grid AS (SELECT metric, k::INTEGER AS k, every.* EXCLUDE (metric) FROM every, (SELECT unnest([2, 5, 10, 15, 20]) AS k) WHERE rank <= k)"""
    + _AP.format(src="grid", by="metric, k, ")
    + "SELECT metric, k, round(avg(ap), 6) AS map, count(*) AS queries FROM ap GROUP BY ALL",
    "identify": _ranked("cosine", 5) + "SELECT query_id AS probe, list(filename ORDER BY rank) AS files FROM r GROUP BY 1",
    "vector_normalize": _BASE + """SELECT vec_id, list_transform(ge, lambda x: round(x::DOUBLE / n, 6) + 0.0::DOUBLE) AS unit
      FROM (SELECT *, sqrt(list_sum(list_transform(ge, lambda y: y::DOUBLE * y))) AS n FROM g)""",
    "gallery_roundtrip": _BASE + "SELECT vec_id, name, filename, CAST(len(ge) AS INTEGER) AS dim FROM g",
    "gallery_append": _BASE + "SELECT vec_id, name, CAST(len(ge) AS INTEGER) AS dim FROM g",
    "search_metrics": """SELECT round(avg(value / 1000), 6) AS average_query_time, count(*) AS total_queries,
      (SELECT count(*) FROM embeddings WHERE vec_id % 10 <> 0) AS gallery_size FROM events""",
}
