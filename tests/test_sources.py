import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from sparquill.sources import readers, stores, writers

RECORD = {
    "trans_date_trans_time": "2020-01-02 03:04:05", "cc_num": "0042", "unix_time": "1.5", "merchant": "m", "category": "c",
    "amt": "2.25", "merch_lat": "1", "merch_long": "-1",
}


def png(path, rgb=(10, 20, 30), size=2):
    def part(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    line = b"\0" + bytes(rgb) * size
    data = b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", size, size, 8, 2, 0, 0, 0))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data + part(b"IDAT", zlib.compress(line * size)) + part(b"IEND", b""))


def test_records_as_array_or_single_object(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([RECORD, {**RECORD, "cc_num": "7"}], indent=4))
    (tmp_path / "b.json").write_text(json.dumps({**RECORD, "amt": 2.25, "unix_time": 3.0}, indent=4))
    assert [r.cc_num for r in readers.read_transactions_json(spark, str(tmp_path / "a.json"), lines=False).collect()] == ["0042", "7"]
    one = readers.read_transactions_json(spark, str(tmp_path / "b.json"), lines=False).collect()
    assert len(one) == 1 and one[0].amt == "2.25"


def test_label_map_whole_and_by_lines(spark, tmp_path):
    (tmp_path / "l.json").write_text(json.dumps({"a": 1, "b": 0, "c": None}, indent=2))
    want = {("a", 1), ("b", 0), ("c", None)}
    for read, how in ((readers.read_label_map, {"whole": True}), (readers.read_label_lines, {})):
        got = read(spark, str(tmp_path / "l.json"), **how)
        assert {tuple(r) for r in got.collect()} == want and got.columns == ["trans_num", "is_fraud"]


def test_questions_with_bare_quotes_and_null(spark, tmp_path):
    head = "ArticleTitle\tQuestion\tAnswer\tDifficultyFromQuestioner\tDifficultyFromAnswerer\tArticleFile\n"
    (tmp_path / "q.tsv").write_text(head + 'A\tWho said "x?\tNULL\teasy\tNULL\tf\n')
    r = readers.read_questions(spark, str(tmp_path / "q.tsv")).first()
    assert r.Question == 'Who said "x?' and r.Answer is None and r.DifficultyFromAnswerer is None


def test_csv_keeps_card_numbers_and_rejects_bad_files(spark, tmp_path):
    (tmp_path / "c.csv").write_text("cc_num,name,lat\n0012,ann,1.5\n")
    r = readers.read_csv(spark, str(tmp_path / "c.csv"), "cc_num string, name string, lat double").first()
    assert r.cc_num == "0012" and r.lat == 1.5
    with pytest.raises(Exception):
        readers.read_csv(spark, str(tmp_path / "missing.csv")).collect()


def test_corpus_reads_whole_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo")
    (tmp_path / "b.txt").write_text("three")
    rows = {r.path.rsplit("/", 1)[1]: r.text for r in readers.read_corpus(spark, str(tmp_path)).collect()}
    assert rows == {"a.txt": "one\ntwo", "b.txt": "three"}


def test_gallery_takes_the_folder_as_identity(spark, tmp_path):
    png(tmp_path / "g" / "Ann_Lee" / "1.png")
    png(tmp_path / "g" / "Bo_Ray" / "2.png", (200, 0, 0))
    (tmp_path / "g" / "Bo_Ray" / "notes.txt").write_text("x")
    rows = readers.read_gallery_images(spark, str(tmp_path / "g")).orderBy("path").collect()
    assert [(r.meta.name, r.meta.filename, r.image.height) for r in rows] == [("Ann_Lee", "1.png", 2), ("Bo_Ray", "2.png", 2)]
    assert bytes(rows[0].image.data[:3]) == bytes([30, 20, 10])  # BGR
    assert readers.read_gallery_images(spark, str(tmp_path / "g"), image=False).count() == 2


def test_box_files_round_trip(spark, tmp_path):
    rows = [("a", 1, 0.5, 0.25, 0.125, 0.1, 0.876, [0.1, 0.876]), ("b", 0, 0.5, 0.25, 0.125, 0.1, 0.5, [0.5, 0.25])]
    df = spark.createDataFrame(rows, "image_id string, class_id int, cx double, cy double, w double, h double, score double, class_scores array<double>")
    writers.write_boxes(df, str(tmp_path / "out"), True, True)
    text = spark.read.text(str(tmp_path / "out"))
    assert text.filter("image_id = 'a'").first().value == "1 0.500000 0.250000 0.125000 0.100000 0.88 0.100000 0.876000"
    back = {r.image_id: r for r in readers.parse_box_lines(text.select("image_id", "value")).collect()}
    assert back["a"].score == 0.88 and back["a"].class_scores == [0.1, 0.876] and not back["b"].bad


def test_box_lines_of_wrong_length(spark, tmp_path):
    (tmp_path / "img_1.txt").write_text("0 0.5 0.5 0.1 0.1\n2 0.5 0.5 0.1 0.1 0.9\n")
    rows = readers.read_box_labels(spark, str(tmp_path)).collect()
    assert [(r.image_id, r.class_id, r.score, r.class_scores) for r in rows] == [("img_1", 0, None, None), ("img_1", 2, 0.9, [])]
    bad = spark.createDataFrame([("1 2 3",), ("x 0.1 0.1 0.1 0.1",), ("",), ("1 0.1 0.1 0.1 0.1",)], "value string")
    assert [r.bad for r in readers.parse_box_lines(bad, strict=False).collect()] == [True, True, True, False]
    with pytest.raises(Exception, match="unexpected box line"):
        readers.parse_box_lines(bad).collect()


def test_class_names_count_from_zero(spark, tmp_path):
    (tmp_path / "n.txt").write_text("person\nsafety vest\nhelmet\n")
    assert [tuple(r) for r in readers.read_class_names(spark, str(tmp_path / "n.txt")).collect()] == [(0, "person"), (1, "safety vest"), (2, "helmet")]


def test_frames_and_stems(spark):
    f = spark.range(10).select(F.col("id").alias("frame_index"))
    assert [r.frame_index for r in readers.frame_sample(f, 4).collect()] == [0, 4, 8]
    with pytest.raises(ValueError):
        readers.frame_sample(f, 0)
    a = spark.createDataFrame([("x/1.jpg",), ("x/2.jpg",)], "path string")
    b = spark.createDataFrame([("y/2.txt",), ("y/3.txt",)], "path string")
    assert [r.stem for r in readers.pair_by_stem(a, b).collect()] == ["2"]


def test_registry_lists_and_rejects(spark, tmp_path):
    reg = stores.Registry(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        reg.list()
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        reg.list()
    with pytest.raises(FileNotFoundError):
        reg.load("x")


def test_a_package_with_threshold_zero_loads_and_scores(spark, tmp_path):
    from sparquill.operators import model

    rows = [(f"t{i}", f"2024-01-{1 + i % 28:02d} {i % 24:02d}:00:00", "a" if i % 2 else "b", f"m{i % 3}", float(i % 7), 1.0, float(i % 5), i % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "trans_num string, t string, category string, merchant string, amt double, merch_lat double, merch_long double, is_fraud int")
    df = df.withColumn("trans_date_trans_time", F.col("t").cast("timestamp_ntz")).withColumns({"cc_num": F.lit("1"), "unix_time": F.lit(0.0)})
    package = model.train(df, df, "bagging", numTrees=3, maxDepth=3)
    assert package["stats"]["recall"] >= 0.6
    reg = stores.Registry(spark, str(tmp_path / "models"))
    reg.save("v1", package["model"], package["scaler"], package["encodings"], 0.0, package["stats"])
    loaded = reg.load("v1")
    assert reg.list() == ["v1"] and loaded["threshold"] == 0.0 and reg.stats("v1") == package["stats"]
    out = model.score(df, loaded)
    assert out.filter("prediction").count() == 120  # at or above 0
    with pytest.raises(ValueError):
        model.score(df, {**loaded, "threshold": None})
    with pytest.raises(ValueError):
        model.classifier("svm")


def test_pictures_are_written_and_read_back(spark, tmp_path):
    import os

    rows = [(f"p{i % 3}", f"{i}.png", 2, 3, 3 if i % 2 else 1, bytes((i * 7 + j) % 256 for j in range(18 if i % 2 else 6))) for i in range(9)]
    df = spark.createDataFrame(rows, "name string, filename string, height int, width int, nChannels int, data binary").repartition(3)
    path = str(tmp_path / "pictures")
    assert writers.write_pictures(df, path) == 9 and writers.write_pictures(df, path) == 9  # a repeated job changes nothing
    (tmp_path / "pictures" / "p0" / "notes.txt").write_text("no picture")
    assert sorted(f for _, _, files in os.walk(path) for f in files) == sorted([*(r[1] for r in rows), "notes.txt"])
    got = {(r.meta.name, r.meta.filename): (r.image.height, r.image.width, r.image.nChannels, bytes(r.image.data)) for r in readers.read_gallery_images(spark, path).collect()}
    assert got == {(r[0], r[1]): (r[2], r[3], r[4], r[5]) for r in rows}
    with pytest.raises(Exception, match="cannot name a picture"):
        writers.write_pictures(df.withColumn("filename", F.lit("../x.png")), path)


def test_corpus_files_are_written_by_all_tasks(spark, tmp_path, monkeypatch):
    from bindings import files

    spark.createDataFrame([(k, f"name {k}", k % 3) for k in range(40)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(files, "work_path", lambda spark, name: f"{tmp_path}/{name}")
    assert sorted(files.scan_corpus(spark, str(tmp_path)).collect()) == [(k, f"name {k}\n{k % 3}") for k in range(40)]
    assert len({f.name.split("-")[1] for f in tmp_path.glob("texts/*/part-*.txt")}) > 4
