import numpy as np
from pyspark.sql import functions as F

from sparquill.operators import boxes as ob
from sparquill.streaming import streams


def drained(q):
    q.awaitTermination()
    assert q.exception() is None


def test_new_files_are_appended_once(spark, tmp_path):
    src, out, point = (str(tmp_path / n) for n in ("src", "out", "point"))
    spark.range(0, 50).write.parquet(src)
    schema = spark.read.parquet(src).schema
    frames = streams.file_stream(spark, src, schema, files_per_batch=1)
    drained(streams.append(streams.sampled_frames(frames, 10, "id"), out, point))
    spark.range(50, 100).write.mode("append").parquet(src)
    drained(streams.append(streams.sampled_frames(streams.file_stream(spark, src, schema), 10, "id"), out, point))
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(0, 100, 10))


def test_gallery_grows_with_cells(spark, tmp_path):
    src, out, point = (str(tmp_path / n) for n in ("src", "out", "point"))
    rows = [(i, [float(i % 2) * 10, 1.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    df.write.parquet(src)
    cents = np.array([[0.0, 1.0], [10.0, 1.0]])
    arriving = streams.file_stream(spark, src, df.schema)
    drained(streams.grow_gallery(arriving, out, point, 2, cents))
    got = spark.read.parquet(out)
    assert got.count() == 20 and got.filter(F.col("cell") != F.col("vec_id") % 2).count() == 0


def test_suppression_on_arrays_equals_the_batch(spark, tmp_path):
    src, out, point = (str(tmp_path / n) for n in ("src", "out", "point"))
    rng = np.random.default_rng(0)
    rows = [(i, d, *map(float, rng.uniform(0.2, 0.6, 4)), float(rng.uniform(-0.1, 1))) for i in range(6) for d in range(8)]
    df = spark.createDataFrame(rows, "image_id int, det_no int, cx double, cy double, w double, h double, score double")
    df.groupBy("image_id").agg(F.collect_list(F.struct("det_no", "cx", "cy", "w", "h", "score")).alias("detections")).write.parquet(src)
    frames = streams.file_stream(spark, src, spark.read.parquet(src).schema)
    drained(streams.append(streams.suppressed(frames), out, point))
    a = {(r.image_id, r.det_no) for r in spark.read.parquet(out).select("image_id", F.inline("detections")).collect()}
    assert a == {(r.image_id, r.det_no) for r in ob.nms(df).collect()}


def test_metrics_keep_the_newest_state(spark, tmp_path):
    src, out, point = (str(tmp_path / n) for n in ("src", "out", "point"))
    for t in (1.0, 3.0):
        spark.createDataFrame([(t,)], "query_time double").coalesce(1).write.mode("append").parquet(src)
    log = streams.file_stream(spark, src, spark.read.parquet(src).schema, files_per_batch=1)
    drained(streams.running_metrics(log, out, point))
    row = streams.newest_metrics(spark, out).first()
    assert (row.average_query_time, row.total_queries) == (2.0, 2)


def _landed(spark, tmp_path, batches, **options):
    """Rows (card, minute, id) land batch by batch; the stream is started anew for each."""
    src, out, point = (str(tmp_path / n) for n in ("src", "out", "point"))
    for rows in batches:
        df = spark.createDataFrame(rows, "card string, minute bigint, id bigint").select("card", F.timestamp_seconds(F.col("minute") * 60 + 1_700_000_000).alias("ts"), "id")
        df.repartition(3).write.mode("append").parquet(src)
        timed = streams.time_since_prev(streams.file_stream(spark, src, df.schema), "card", "ts", "id", **options)
        drained(streams.append(timed, out, point))
    return {r.id: (r.minutes_since_prev, r.late, r.late_so_far) for r in spark.read.parquet(out).collect()}


def test_state_lasts_from_batch_to_batch_and_late_rows_are_counted(spark, tmp_path):
    batches = [
        [("a", 10, 1), ("a", 12, 2), ("b", 5, 3), (None, 7, 4), ("c", None, 5)],
        [("a", 12, 6), ("a", 30, 7), ("b", 4, 8), ("b", 3, 9), ("b", 9, 10)],
        [("b", 8, 11), ("a", 31, 13), ("a", 31, 12)],
    ]
    got = _landed(spark, tmp_path, batches)
    assert got == {
        1: (None, False, 0), 2: (2.0, False, 0), 3: (None, False, 0), 4: (None, False, 0), 5: (None, False, 0),
        6: (0.0, False, 0), 7: (18.0, False, 0), 8: (None, True, 2), 9: (None, True, 1), 10: (4.0, False, 2),
        11: (None, True, 3), 12: (1.0, False, 0), 13: (0.0, False, 0),
    }


def test_cards_are_forgotten_behind_the_watermark(spark, tmp_path):
    batches = [[("a", 0, 1), ("b", 0, 2)], [("b", 600, 3)], [("b", 601, 4)], [("b", 602, 5), ("a", 603, 6)]]
    got = _landed(spark, tmp_path, batches, expire="60 minutes")
    assert got[3][0] == 600.0 and got[4][0] == 1.0 and got[5][0] == 1.0 and got[6] == (None, False, 0)
    assert _landed(spark, tmp_path / "kept", batches)[6][0] == 603.0


def test_a_table_is_streamed_from_a_file_or_a_folder_of_files(spark, tmp_path):
    from bindings import files

    rows = spark.range(40).select(F.col("id").alias("vec_id"), F.array([F.lit(0.5).cast("float") + F.col("id").cast("float") / (i + 1) for i in range(64)]).alias("embedding"), F.lit(1).alias("label"))
    rows.repartition(3).write.parquet(str(tmp_path / "folder" / "embeddings.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "written"))
    (tmp_path / "file").mkdir()
    next((tmp_path / "written").glob("*.parquet")).rename(tmp_path / "file" / "embeddings.parquet")
    for kind in ("folder", "file"):
        got = files.stream_gallery(spark, str(tmp_path / kind))
        assert sorted(r.vec_id for r in got.collect()) == [i for i in range(40) if i % 10]
