"""Files, pictures, frames and streams: everything is written from the given tables first."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import boxes as bb
from bindings import transactions as bt
from bindings import vectors as bv
from bindings.common import rounded, table
from sparquill.operators import boxes as ob
from sparquill.operators import images as oi
from sparquill.operators import knn as ok
from sparquill.operators import model as om
from sparquill.session import work_path
from sparquill.sources import label_files as labels
from sparquill.sources import readers, stores, writers
from sparquill.streaming import streams


def scan_parquet(spark, sf):
    return readers.read_parquet(spark, f"{sf}/part.parquet")


def scan_csv(spark, sf):
    path = work_path(spark, "csv")
    c = bt.customers(spark, sf)
    fields = [f.split()[0] for f in readers.CUSTOMER_SCHEMA.split(", ")]
    full = c.select(*[F.col(f) if f in c.columns else F.lit(None).cast("string").alias(f) for f in fields])
    full.write.option("header", True).csv(path)
    return rounded(readers.read_csv(spark, path).select("cc_num", "last", "state", "lat", "job", "city_pop"))


def scan_label_map(spark, sf):
    path = work_path(spark, "labels")
    pairs = bt.labels(spark, sf).withColumn("part", F.floor(F.substring("trans_num", 2, 18).cast("bigint") / 1000))
    # a thousand pairs per object, one object per line
    entries = F.map_from_entries(F.collect_list(F.struct("trans_num", "is_fraud")))
    pairs.groupBy("part").agg(F.to_json(entries, {"ignoreNullFields": "false"}).alias("value")).select("value").write.text(path)
    return readers.read_label_map(spark, path, whole=False)


def scan_label_lines(spark, sf):
    path = work_path(spark, "labels")
    value = F.coalesce(F.col("is_fraud").cast("string"), F.lit("null"))
    line = F.concat(F.lit('    "'), F.col("trans_num"), F.lit('": '), value, F.lit(","))
    bt.labels(spark, sf).select(line.alias("value")).write.text(path)
    return readers.read_label_lines(spark, path)


def scan_txn_json(spark, sf):
    path = work_path(spark, "json")
    t = bt.transactions(spark, sf)
    text = [F.col(c).cast("string").alias(c) for c in readers.TRANSACTION_FIELDS]
    t.select(*text).write.json(path)
    back = readers.read_transactions_json(spark, path, lines=True)
    return rounded(back.select("cc_num", "merchant", "category", F.expr("try_cast(amt as double)").alias("amt"),
                               F.expr("try_cast(unix_time as double)").alias("unix_time")))


def scan_tsv(spark, sf):
    path = work_path(spark, "tsv")
    p = table(spark, sf, "part")
    rows = p.select(
        F.col("p_brand").alias("ArticleTitle"),
        F.concat(F.lit('Is "'), F.col("p_name"), F.lit('" small?')).alias("Question"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_type")).alias("Answer"),
        F.lit("easy").alias("DifficultyFromQuestioner"),
        F.when(F.col("p_size") > 20, "hard").alias("DifficultyFromAnswerer"),
        F.col("p_partkey").cast("string").alias("ArticleFile"),
    )
    out = rows.write.option("header", True).option("sep", "\t").option("nullValue", "NULL").option("quote", "")
    out.csv(path)
    return readers.read_questions(spark, path)


def scan_corpus(spark, sf):
    path = work_path(spark, "texts")
    s = table(spark, sf, "supplier").select(F.concat_ws("\n", "s_name", "s_nationkey").alias("value"), "s_suppkey")
    tasks = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))  # writing a file takes its time, whatever it holds; tasks move their files themselves
    s.repartition(tasks).write.option("mapreduce.fileoutputcommitter.algorithm.version", 2).partitionBy("s_suppkey").text(path)
    back = readers.read_corpus(spark, path)
    return back.select(F.regexp_extract("path", r"s_suppkey=(\d+)", 1).cast("bigint").alias("key"), F.trim(F.regexp_replace("text", r"\n$", "")).alias("text"))


def class_names(spark, sf):
    path = work_path(spark, "names")
    table(spark, sf, "nation").orderBy("n_nationkey").select(F.col("n_name").alias("value")).coalesce(1).write.text(path)
    return readers.read_class_names(spark, path)


def format_boxes(spark, sf):
    p = bb.predictions(spark, sf)
    return p.select("image_id", "det_no", writers.box_line(True, True).alias("line"))


def parse_box_labels(spark, sf):
    path = work_path(spark, "boxes")
    p = bb.predictions(spark, sf).withColumn("value", writers.box_line(True, True))
    t = bb.annotations(spark, sf).withColumn("value", writers.box_line(False, False))
    lines = p.select("image_id", "value").unionByName(t.select("image_id", "value"))
    writers.write_parquet(lines, path)
    back = readers.parse_box_lines(spark.read.parquet(path))
    return rounded(back.select("image_id", "class_id", "cx", "cy", "w", "h", "score", F.size("class_scores").alias("n_scores"), "bad"))


def label_files(spark, sf):
    """Predictions written as one text file per image, and read back."""
    path = work_path(spark, "labels").removeprefix("file://")
    labels.write_label_files(bb.predictions(spark, sf), path, "det_no", True, True)
    back = labels.read_label_files(spark, path).withColumn("image_id", F.col("image_id").cast("bigint"))
    return rounded(back.select("image_id", "line_no", "class_id", "cx", "cy", "w", "h", "score", F.size("class_scores").alias("n_scores"), "bad"))


def pair_by_stem(spark, sf):
    p = table(spark, sf, "part")
    stem = F.concat_ws("_", F.regexp_replace("p_brand", "#", ""), F.col("p_partkey").cast("string"))
    img = p.select(F.concat(F.lit("data/images/"), stem, F.lit(".jpg")).alias("path"))
    lab = p.filter("p_size > 10").select(F.concat(F.lit("data/labels/"), stem, F.lit(".txt")).alias("path"))
    return readers.pair_by_stem(img, lab)


def frame_sample(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("frame_index"), "value")
    return rounded(readers.frame_sample(e, 20))


# ---- pictures -----------------------------------------------------------------------------------------


def pictures(spark, sf):
    """8 x 8 pictures: every vector component becomes one pixel."""
    e = table(spark, sf, "embeddings")
    level = F.transform("embedding", lambda x: F.least(F.lit(255), F.greatest(F.lit(0), F.floor((x.cast("double") + 0.5) * 255).cast("int"))))
    two = lambda v: F.lpad(F.hex(v.cast("bigint")), 2, "0")
    pixel = F.transform(level, lambda v: F.concat(two(v), two(255 - v), two(v.bitwiseAND(127) * 2)))
    return e.select(
        F.col("vec_id").alias("image_id"),
        F.concat(F.lit("data/person_"), F.col("label"), F.lit("/img_"), F.col("vec_id"), F.lit(".jpg")).alias("origin"),
        F.lit(8).alias("height"),
        F.lit(8).alias("width"),
        F.lit(3).alias("nChannels"),
        F.lit(16).alias("mode"),
        F.unhex(F.array_join(pixel, "")).alias("data"),
    )


def _bytes_sum(weighted: bool):
    """Sum of the bytes, or of position times byte, as a check value."""
    hexed = F.hex("data")
    at = F.sequence(F.lit(0), F.length("data") - 1)
    byte = lambda i: F.conv(F.substring(hexed, i * 2 + 1, F.lit(2)), 16, 10).cast("bigint")
    return F.aggregate(at, F.lit(0).cast("bigint"), lambda a, i: a + byte(i) * ((i + 1) if weighted else F.lit(1)))


def scan_gallery(spark, sf):
    """A folder per person with picture files, written by tasks and read as a gallery. A third of the files has another ending and is no picture."""
    path = work_path(spark, "pictures").removeprefix("file://")
    part = F.split("origin", "/")
    ending = F.when(F.col("image_id") % 3 == 0, F.lit(".bin")).otherwise(F.lit(".png"))
    named = pictures(spark, sf).withColumns({"name": F.element_at(part, -2), "filename": F.concat(F.regexp_replace(F.element_at(part, -1), r"\.jpg$", ""), ending)})
    writers.write_pictures(named, path)
    seen = readers.read_gallery_images(spark, path)
    size = [F.col(f"image.{c}").alias(c) for c in ("height", "width", "nChannels")]
    return seen.select("meta.name", "meta.filename", *size, F.col("image.data").alias("data")).select("name", "filename", "height", "width", "nChannels", _bytes_sum(True).alias("check_sum"))


def augment_images(spark, sf):
    out = oi.augment(pictures(spark, sf))
    return out.select(oi.augmented_name("origin", "augmentation").alias("name"), "height", "width", F.length("data").alias("n"))


def augment_images_exact(spark, sf):
    """The three augmentations whose bytes are whole-number arithmetic."""
    out = oi.augment(pictures(spark, sf), ["flipped", "rotated", "contrast"])
    return out.select("origin", "augmentation", "height", "width", _bytes_sum(True).alias("check_sum"))


def robustness_variants(spark, sf):
    out = oi.robustness_variants(pictures(spark, sf))
    return out.select("origin", "augmentation", _bytes_sum(False).alias("total"))


def image_to_tensor(spark, sf):
    out = oi.to_tensor(pictures(spark, sf))
    return rounded(out.select("origin", F.size("tensor").alias("n"), F.array_max("tensor").cast("double").alias("top")), 4)


def _large_pictures(spark, sf):
    """The same pictures with every pixel as a square of 20 x 20: they need no resizing."""
    p = pictures(spark, sf)
    row = lambda y: F.repeat(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda x: F.repeat(F.substring(F.hex("data"), y * 48 + x * 6 + 1, F.lit(6)), F.lit(20))), ""), F.lit(20))
    data = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), row), ""))
    return p.withColumns({"data": data, "height": F.lit(160), "width": F.lit(160)})


def image_to_tensor_exact(spark, sf):
    out = oi.to_tensor(_large_pictures(spark, sf))
    return rounded(out.select("origin", F.size("tensor").alias("n"), F.array_max("tensor").cast("double").alias("top")), 4)


def robustness_variants_exact(spark, sf):
    """The four variants whose bytes follow from a whole-number mean."""
    out = oi.robustness_variants(pictures(spark, sf)).filter("augmentation <> 'blur'")
    return out.select("origin", "augmentation", _bytes_sum(True).alias("check_sum"))


def embed_image(spark, sf):
    """Colour histograms, exact up to single precision."""
    out = oi.embed_image(pictures(spark, sf))
    return out.select("origin", F.transform("embedding", lambda x: F.round(x.cast("double"), 6) + F.lit(0.0)).alias("embedding"))


def identify_images(spark, sf):
    """Pictures to vectors to neighbours: every tenth picture is the probe."""
    vec = F.regexp_extract("origin", r"img_(\d+)", 1).cast("bigint")
    e = oi.embed_image(pictures(spark, sf)).withColumn("vec_id", vec)
    parts = F.split("origin", "/")
    meta = F.struct(parts[1].alias("name"), parts[2].alias("filename"))
    g = e.filter("vec_id % 10 <> 0").select("vec_id", "embedding", meta.alias("meta"))
    q = e.filter("vec_id % 10 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return ok.identify(q, g, 5)


def detect_frames(spark, sf):
    out = oi.detect_frames(pictures(spark, sf), every=2, score_threshold=0.5)
    return out.select("frame_index", F.size("bboxes").alias("n"), "class_ids")


# ---- history and streams --------------------------------------------------------------------------------


def history_log(spark, sf):
    """Search results appended to the log and read back."""
    path = work_path(spark, "searches")
    found = ok.identify(bv.probes(spark, sf), bv.gallery(spark, sf), 3)
    rows = found.select(F.col("probe").cast("string").alias("probe_image"), "results", (F.col("probe") / 1000.0).alias("query_time"))
    stores.append_history(rows.filter("query_time < 0.2"), path)
    stores.append_history(rows.filter("query_time >= 0.2"), path)
    back = stores.read_history(spark, path)
    return rounded(back.select("probe_image", F.transform("results", lambda r: r["filename"]).alias("files"), "query_time"))


def _table_stream(spark, sf, name):
    """A table as a stream of its files. As a pattern of one name the path may be a file or a folder of files, which a plain path may not."""
    return streams.file_stream(spark, f"{sf}/{{{name}.parquet}}", table(spark, sf, name).schema)


def _event_stream(spark, sf):
    return _table_stream(spark, sf, "events")


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def stream_frame_sample(spark, sf):
    out, point = work_path(spark, "stream"), work_path(spark, "point")
    frames = _event_stream(spark, sf).select(F.col("event_id").alias("frame_index"), "value")
    _finish(streams.append(streams.sampled_frames(frames, 20), out, point))
    return rounded(spark.read.parquet(out))


def stream_score(spark, sf):
    package, _ = bt._package(spark, sf)
    e = _event_stream(spark, sf)
    records = e.select(
        F.concat(F.lit("T"), "event_id").alias("trans_num"),
        F.col("user_id").cast("string").alias("cc_num"),
        F.col("ts").alias("trans_date_trans_time"),
        F.lit(None).cast("double").alias("unix_time"),
        F.concat(F.lit("Fraud_"), F.get_json_object("props", "$.k")).alias("merchant"),
        F.upper("event_type").alias("category"),
        F.col("value").alias("amt"),
        (F.col("value") / 8).alias("merch_lat"),
        (F.col("user_id") - 100.0).alias("merch_long"),
    )
    out, point = work_path(spark, "stream"), work_path(spark, "point")
    _finish(streams.append(streams.scored(records, package, ("trans_num",)), out, point))
    return spark.read.parquet(out).select("trans_num", "model", *bt.checks(package))


def stream_gallery(spark, sf):
    g = bv.gallery(spark, sf)
    _, centroids = ok.build_cells(g, 8)
    arriving = _table_stream(spark, sf, "embeddings").filter("vec_id % 10 <> 0")
    out, point = work_path(spark, "stream"), work_path(spark, "point")
    _finish(streams.grow_gallery(arriving, out, point, 64, centroids))
    return spark.read.parquet(out).select("vec_id", "label", F.size("embedding").alias("dim"), F.col("cell").between(0, 7).alias("celled"))


def _frames_with_boxes(spark, sf, path):
    """Frames that carry their predictions as one array, as a detector emits them."""
    p = bb.predictions(spark, sf).drop("class_scores", "class_id")
    item = F.struct("det_no", "cx", "cy", "w", "h", "score")
    p.groupBy("image_id").agg(F.collect_list(item).alias("detections")).write.parquet(path)
    return spark.read.parquet(path).schema


def stream_nms(spark, sf):
    landing, out, point = (work_path(spark, n) for n in ("landing", "stream", "point"))
    schema = _frames_with_boxes(spark, sf, landing)
    frames = streams.file_stream(spark, landing, schema)
    _finish(streams.append(streams.suppressed(frames), out, point))
    kept = spark.read.parquet(out).select("image_id", F.inline("detections"))
    return rounded(kept.select("image_id", "det_no", "score"))


def stream_time_since_prev(spark, sf):
    """The transactions land in four steps, in the order of time, and the stream is stopped and taken up again between them."""
    t = bt.transactions(spark, sf).select("trans_num", "cc_num", "trans_date_trans_time")
    time = F.col("trans_date_trans_time")
    lo, hi = t.agg(F.unix_micros(F.min(time).cast("timestamp")), F.unix_micros(F.max(time).cast("timestamp"))).first()
    step = F.least(F.floor((F.unix_micros(time.cast("timestamp")) - lo) * 4 / max(1, hi - lo)), F.lit(3))
    landing, out, point = (work_path(spark, n) for n in ("landing", "stream", "point"))
    for k in range(4):
        t.filter(step == k).write.mode("append").parquet(landing)
        timed = streams.time_since_prev(streams.file_stream(spark, landing, t.schema), "cc_num", "trans_date_trans_time", "trans_num")
        _finish(streams.append(timed, out, point))
    return rounded(spark.read.parquet(out).select("trans_num", "cc_num", "minutes_since_prev"))


def stream_metrics(spark, sf):
    out, point = work_path(spark, "stream"), work_path(spark, "point")
    log = _event_stream(spark, sf).select((F.col("value") / 1000).alias("query_time"))
    _finish(streams.running_metrics(log, out, point))
    return rounded(streams.newest_metrics(spark, out))


QUERIES = {
    f.__name__: f
    for f in (
        scan_parquet, scan_csv, scan_label_map, scan_label_lines, scan_txn_json, scan_tsv, scan_corpus, class_names,
        format_boxes, parse_box_labels, label_files, scan_gallery, pair_by_stem, frame_sample, augment_images, augment_images_exact,
        robustness_variants, robustness_variants_exact, image_to_tensor, image_to_tensor_exact, embed_image, identify_images, detect_frames, history_log,
        stream_frame_sample, stream_score, stream_gallery, stream_nms, stream_metrics, stream_time_since_prev,
    )
}

# ---- the same in SQL ----------------------------------------------------------------------------------------

_LABELS = """SELECT 'T' || event_id AS trans_num, CASE WHEN event_id % 97 <> 0 THEN (event_type = 'error')::INTEGER END AS is_fraud FROM events"""
_SAMPLE = "SELECT event_id AS frame_index, round(value, 6) AS value FROM events WHERE event_id % 20 = 0"
_STEM = "replace(p_brand, '#', '') || '_' || p_partkey"
_LINE = """printf('%d %.6f %.6f %.6f %.6f %.2f', class_id, cx, cy, w, h, score) || ' '
        || array_to_string(list_transform([0, 1, 2], lambda i: printf('%.6f', CASE WHEN i = class_id THEN score ELSE (1 - score) / 2 END)), ' ')"""
_PIXELS = """WITH p AS (SELECT vec_id, 'data/person_' || label || '/img_' || vec_id || '.jpg' AS origin, i,
    least(255, greatest(0, floor((embedding[i + 1]::DOUBLE + 0.5) * 255)))::BIGINT AS v FROM embeddings, range(0, 64) r(i)),
c AS (SELECT origin, i // 8 AS y, i % 8 AS x, unnest([0, 1, 2]) AS ch, unnest([v, 255 - v, (v & 127) * 2]) AS b FROM p),
a AS (SELECT origin, 'flipped' AS augmentation, y AS y2, 7 - x AS x2, ch, b FROM c
  UNION ALL SELECT origin, 'rotated', x, 7 - y, ch, b FROM c
  UNION ALL SELECT origin, 'contrast', y, x, ch, least(255, round_even(b * 1.5, 0))::BIGINT FROM c)
"""

SQL = {
    "scan_parquet": "SELECT * FROM part",
    "scan_csv": """SELECT c_custkey::VARCHAR AS cc_num, c_name AS last, c_nationkey::VARCHAR AS state, round(c_acctbal, 6) AS lat,
        c_mktsegment AS job, NULL::BIGINT AS city_pop FROM customer""",
    "scan_label_map": _LABELS,
    "scan_label_lines": _LABELS,
    "scan_txn_json": """SELECT user_id::VARCHAR AS cc_num, CASE WHEN event_id % 11 <> 0 THEN 'Fraud_' || (props->>'$.k') END AS merchant,
        CASE WHEN event_id % 7 <> 0 THEN upper(event_type) END AS category, round(value, 6) AS amt,
        CASE WHEN event_id % 5 <> 0 THEN floor(epoch_us(ts) / 1e6::DOUBLE)::DOUBLE - 220924800.0::DOUBLE END AS unix_time FROM events""",
    "scan_tsv": """SELECT p_brand AS "ArticleTitle", 'Is "' || p_name || '" small?' AS "Question", CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS "Answer",
        'easy' AS "DifficultyFromQuestioner", CASE WHEN p_size > 20 THEN 'hard' END AS "DifficultyFromAnswerer", p_partkey::VARCHAR AS "ArticleFile" FROM part""",
    "scan_corpus": "SELECT s_suppkey AS key, s_name || chr(10) || s_nationkey AS text FROM supplier",
    "class_names": "SELECT n_nationkey AS class_id, n_name AS class_name FROM nation",
    "format_boxes": bb._BASE + f"SELECT image_id, det_no, {_LINE} AS line FROM pred",
    "parse_box_labels": bb._BASE + """SELECT image_id, class_id, round(cx, 6) AS cx, round(cy, 6) AS cy, round(w, 6) AS w, round(h, 6) AS h,
        CASE WHEN predicted THEN round(score, 2) END AS score, CASE WHEN predicted THEN 3 END::INTEGER AS n_scores, false AS bad FROM b""",
    # Boxes of one number follow each other in the order of their lines.
    "label_files": bb._BASE + f""", lines AS (SELECT *, {_LINE} AS line FROM pred)
      SELECT image_id, (row_number() OVER (PARTITION BY image_id ORDER BY det_no, line) - 1)::INTEGER AS line_no, class_id,
        round(cx, 6) AS cx, round(cy, 6) AS cy, round(w, 6) AS w, round(h, 6) AS h, round(score, 2) AS score, 3::INTEGER AS n_scores, false AS bad FROM lines""",
    "pair_by_stem": f"""SELECT {_STEM} AS stem, 'data/images/' || {_STEM} || '.jpg' AS left_path, 'data/labels/' || {_STEM} || '.txt' AS right_path
        FROM part WHERE p_size > 10""",
    "scan_gallery": _PIXELS + """SELECT split_part(origin, '/', 2) AS name, replace(split_part(origin, '/', 3), '.jpg', '.png') AS filename, 8::INTEGER AS height, 8::INTEGER AS width,
        3::INTEGER AS nChannels, sum(((y * 8 + x) * 3 + ch + 1) * b)::BIGINT AS check_sum FROM c WHERE regexp_extract(origin, '_([0-9]+)\\.jpg', 1)::BIGINT % 3 <> 0 GROUP BY origin""",
    "frame_sample": _SAMPLE,
    "stream_frame_sample": _SAMPLE,
    "augment_images": """SELECT 'img_' || vec_id || '_' || k AS name, CASE WHEN k = 'resized' THEN 224 ELSE 8 END::INTEGER AS height,
        CASE WHEN k = 'resized' THEN 224 ELSE 8 END::INTEGER AS width, CASE WHEN k = 'resized' THEN 224 * 224 * 3 ELSE 192 END::INTEGER AS n
        FROM embeddings, (SELECT unnest(['flipped', 'blurred', 'resized', 'rotated', 'brightness', 'contrast']) AS k)""",
    "augment_images_exact": _PIXELS + """SELECT origin, augmentation, 8::INTEGER AS height, 8::INTEGER AS width,
        sum((y2 * 24 + x2 * 3 + ch + 1) * b)::BIGINT AS check_sum FROM a GROUP BY ALL""",
    "robustness_variants_exact": _PIXELS + """,
        gray AS (SELECT origin, y, x, sum(b * [0.114, 0.587, 0.299][ch + 1]::DOUBLE) AS g FROM c GROUP BY ALL),
        mean AS (SELECT origin, floor(avg(g) + 0.5) AS m FROM gray GROUP BY 1),
        v AS (SELECT origin, k AS augmentation, y * 24 + x * 3 + ch + 1 AS i, least(255, greatest(0, round_even(CASE k WHEN 'low_brightness' THEN b * 0.5::DOUBLE
          WHEN 'high_brightness' THEN b * 1.5::DOUBLE WHEN 'low_contrast' THEN m + 0.5::DOUBLE * (b - m) ELSE m + 1.5::DOUBLE * (b - m) END, 0)))::BIGINT AS b
          FROM c JOIN mean USING (origin), (SELECT unnest(['low_brightness', 'high_brightness', 'low_contrast', 'high_contrast']) AS k))
        SELECT origin, augmentation, sum(i * b)::BIGINT AS check_sum FROM v GROUP BY ALL""",
    "image_to_tensor_exact": _PIXELS + """SELECT origin, 76800::INTEGER AS n, round(max(((b / 255.0::DOUBLE) - [0.406, 0.456, 0.485][ch + 1]) / [0.225, 0.224, 0.229][ch + 1])::FLOAT::DOUBLE, 4) AS top
        FROM c GROUP BY 1""",
    "embed_image": _PIXELS + """, h AS (SELECT origin, ch, b * 8 // 256 AS bin, count(*) AS n FROM c GROUP BY ALL),
        every AS (SELECT origin, ch::BIGINT AS ch, bin::BIGINT AS bin FROM (SELECT DISTINCT origin FROM c), range(3) a(ch), range(8) d(bin)),
        f AS (SELECT origin, ch, bin, coalesce(n, 0) AS n, sqrt(sum(coalesce(n, 0) * coalesce(n, 0)) OVER (PARTITION BY origin)) AS norm FROM every LEFT JOIN h USING (origin, ch, bin))
        SELECT origin, list(round((n / norm)::FLOAT::DOUBLE, 6) + 0.0::DOUBLE ORDER BY ch, bin) AS embedding FROM f GROUP BY 1""",
    "stream_score": "SELECT 'T' || event_id AS trans_num, 'bagging' AS model, true AS consistent, true AS in_range FROM events",
    "history_log": bv._ranked("euclidean", 3) + """SELECT query_id::VARCHAR AS probe_image, list(filename ORDER BY rank) AS files,
        round(query_id / 1000.0::DOUBLE, 6) AS query_time FROM r GROUP BY query_id""",
    "stream_gallery": """SELECT vec_id, label, 64::INTEGER AS dim, true AS celled FROM embeddings WHERE vec_id % 10 <> 0""",
    "stream_nms": bb.SQL["nms"],
    "stream_time_since_prev": bt.SQL["time_since_prev"],
    "stream_metrics": "SELECT round(avg(value / 1000), 6) AS average_query_time, count(*) AS total_queries FROM events",
}
