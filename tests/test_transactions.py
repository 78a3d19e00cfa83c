import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparquill.operators import clean, features, profile, split, stats

T0 = datetime(2024, 1, 1, 23, 30)


def test_mode_ties_take_the_smallest_and_the_rest_becomes_unknown(spark):
    rows = [("a", "y"), ("a", "x"), ("a", None), ("b", None), (None, None), (None, "z"), ("c", "q"), ("c", "q"), ("c", "r"), ("c", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, merchant string, category string")
    out = {r.id: (r.merchant, r.category) for r in clean.impute_category(df).collect()}
    assert out[2] == ("a", "x") and out[3] == ("b", "unknown") and out[4] == ("unknown", "unknown")
    assert out[5] == ("unknown", "z") and out[9] == ("c", "q")


def test_cleaning_drops_unlabelled_rows_and_marks_imputed_times(spark):
    t = spark.createDataFrame(
        [("T1", "7", "2024-01-02 03:04:05", None, "SHOP", "Food", 1.0), ("T2", "7", "2024-01-01 00:00:00", 5.0, "SHOP", None, 2.0),
         ("T3", "8", "2024-01-01 00:00:00", 6.0, "SHOP", "Food", 3.0), ("T4", "9", "2024-01-01 00:00:00", 6.0, "SHOP", "Food", 3.0)],
        "trans_num string, cc_num string, trans_date_trans_time string, unix_time double, merchant string, category string, amt double")
    labels = spark.createDataFrame([("T1", 1), ("T2", 0), ("T3", None), ("T4", 1), ("T9", 1)], "trans_num string, is_fraud int")
    people = spark.createDataFrame([("7", "ANN"), ("8", "BOB")], "cc_num string, first string")
    out = clean.clean_transactions(clean.join_sources(t, labels, people)).collect()
    assert [r.trans_num for r in out] == ["t2", "t1"]
    assert out[1].unix_time == datetime(2024, 1, 2, 3, 4, 5).timestamp() or out[1].unix_time == 1704164645.0
    assert out[0].category == "food" and out[0].first == "ann"
    assert out[0].asDict().keys() >= {"amt", "is_fraud"} and "lat" not in out[0].asDict()


def test_bad_time_fails_or_becomes_null(spark):
    df = spark.createDataFrame([("nope",)], "trans_date_trans_time string")
    assert clean.parse_time(df, strict=False).first()[0] is None
    with pytest.raises(Exception):
        clean.parse_time(df).collect()


def test_validation_flags_without_dropping(spark):
    row = ("2024-01-01 00:00:00", "1", "x", "m", "c", "20000", "1", "2")
    bad = ("2024-13-01", "1", None, "m", "c", "ten", "1", None)
    df = spark.createDataFrame([row, bad], ", ".join(f"{c} string" for c in (
        "trans_date_trans_time", "cc_num", "unix_time", "merchant", "category", "amt", "merch_lat", "merch_long")))
    good, wrong = clean.validate_input(df).orderBy(F.col("valid").desc()).collect()
    assert good.valid and good.outlier and good.unix_time is None
    assert wrong.problem == "trans_date_trans_time,amt,merch_long" and not wrong.outlier


@pytest.mark.parametrize("n,size", [(10, 0.25), (7, 0.2), (3, 1.0), (3, 0.0), (0, 0.2)])
def test_split_sizes_and_order(spark, n, size):
    rows = [(i, T0 + timedelta(hours=i // 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    out = split.time_split(df, "ts", "id", size).collect()
    train = [r for r in out if r.split == "train"]
    assert len(train) == int(n * (1 - size)) and len(out) == n
    test = [(r.ts, r.id) for r in out if r.split == "test"]
    if train and test:
        assert max((r.ts, r.id) for r in train) < min(test)


def test_samples_are_repeatable(spark):
    df = spark.range(90).select("id", (F.col("id") % 3).alias("g"))
    a = [r.id for r in split.stratified_sample(df, "g", "id", 3, 1).orderBy("id").collect()]
    b = [r.id for r in split.stratified_sample(df.repartition(7), "g", "id", 3, 1).orderBy("id").collect()]
    c = [r.id for r in split.stratified_sample(df, "g", "id", 3, 2).orderBy("id").collect()]
    assert a == b and len(a) == 9 and a != c
    s = split.stratified_split(df, "g", "id", 0.2)
    assert {(r.g, r.n) for r in s.filter("split = 'train'").groupBy("g").agg(F.count("*").alias("n")).collect()} == {(0, 24), (1, 24), (2, 24)}


@pytest.mark.parametrize("x,dof,p", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (18.307038, 10, 0.05), (35.172462, 23, 0.05), (0.0, 4, 1.0)])
def test_chi_square_tail(x, dof, p):
    assert stats.chi2_tail(x, dof) == pytest.approx(p, abs=1e-6)


def test_two_by_two_table_is_corrected(spark):
    rows = [(0, 1)] * 12 + [(0, 0)] * 5 + [(1, 1)] * 3 + [(1, 0)] * 9
    df = spark.createDataFrame(rows, "k int, y int")
    r = stats.chi_square(df, F.col("k"), "y").first()
    n, a, b, c, d = 29, 12, 5, 3, 9
    want = n * (abs(a * d - b * c) - n / 2) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d))
    assert r.statistic == pytest.approx(want) and r.dof == 1 and r.p_value == pytest.approx(stats.chi2_tail(want, 1))


def test_ks_with_an_empty_side_and_with_missing_values(spark):
    one = spark.createDataFrame([(1.0, 1), (2.0, 1), (None, 1)], "v double, y int")
    assert stats.ks_two_sample(one, "v", "y").first().statistic is None
    two = one.unionByName(spark.createDataFrame([(3.0, 0), (4.0, 0)], "v double, y int"))
    r = stats.ks_two_sample(two, "v", "y").first()
    assert (r.statistic, r.n1, r.n0) == (1.0, 2, 2)


def test_interval_of_equal_times_and_across_ranges(spark):
    rows = [("c", T0 + timedelta(minutes=m), i) for i, m in enumerate([0, 0, 5, 5, 5, 400000, 400030])] + [("d", T0, 99), (None, T0, 100)]
    df = spark.createDataFrame(rows, "card string, ts timestamp_ntz, id int")
    got = {r.id: r.minutes_since_prev for r in stats.time_since_prev(df, "card", "ts", "id").collect()}
    assert got == {0: None, 1: 0.0, 2: 5.0, 3: 0.0, 4: 0.0, 5: 399995.0, 6: 30.0, 99: None, 100: None}


def test_curve_and_threshold(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)], "s double, y int")
    curve = {r.threshold: (r.precision, r.recall) for r in stats.pr_curve(df, "s", "y").collect()}
    assert curve[0.8] == (1.0, 0.5) and curve[0.35] == (pytest.approx(2 / 3), 1.0) and curve[0.1] == (0.5, 1.0)
    assert stats.best_threshold(df, "s", "y").first().threshold == 0.35
    assert stats.best_threshold(df, "s", "y", 0.9, 0.9).count() == 0


def test_alert(spark):
    df = spark.createDataFrame([(True, 1), (True, 0), (False, 1)], "p boolean, y int")
    r = stats.metric_alert(df, "p", "y").first()
    assert (r.tp, r.fp, r.fn, r.alert) == (1, 1, 1, True)


def test_profile_of_a_small_table(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, None, "b"), (3, 4.0, None)], "id bigint, v double, s string")
    r = profile.profile_completeness(df).first()
    assert [round(x, 6) for x in r] == [round(7 / 9, 6), round(1 / 3, 6), round(1 / 3, 6)]
    cols = {r.column_name: (r.null_count, r["mean"]) for r in profile.profile_columns(df).collect()}
    assert cols == {"id": (0, 2.0), "v": (1, 3.0), "s": (1, None)}
    empty = profile.profile_completeness(df.filter("id > 9")).first()
    assert empty.table_completeness is None


def test_histogram_leaves_out_the_tail_and_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(i), 0) for i in range(101)], "v double, y int")
    rows = {r.bin: r.n for r in profile.density_histogram(df, "v", ["y"], 10).collect()}
    assert sum(rows.values()) == 100 and rows[9] == 10  # 99 sits on the upper edge
    d = profile.density_histogram(df, "v", ["y"], 10).agg(F.sum(F.col("density") * 9.9)).first()[0]
    assert d == pytest.approx(1.0)


def test_scaler_uses_the_population_deviation_and_survives_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    sc = features.fit_scaler(df, ["a", "b"])
    assert sc == {"a": (2.0, 1.0), "b": (5.0, 1.0)}
    assert [(r.a_scaled, r.b_scaled) for r in features.scale(df, sc).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_unseen_categories_get_the_global_mean(spark):
    train = spark.createDataFrame([("x", 1), ("x", 1), ("y", 0), ("y", 1)], "c string, y int")
    enc = features.fit_encodings(train, ["c"], "y")
    test = spark.createDataFrame([("x",), ("new",), (None,)], "c string")
    got = {r.c: r.c_encoded for r in features.apply_encodings(test, enc, ["c"]).collect()}
    assert got["new"] == got[None] == 0.75 and got["x"] == pytest.approx(1.0)


def test_time_features_of_a_monday(spark):
    df = spark.createDataFrame([("2024-01-01 06:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
    r = features.time_features(df, "ts").first()
    assert (r.hour_of_day, r.day_of_week, r.month) == (6, 0, 1)
    assert r.hour_sin == pytest.approx(1.0) and r.month_cos == pytest.approx(math.cos(math.pi / 6))


def test_range_filter_is_pushed_to_the_scan(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    df = clean.date_range(e, "ts", "2024-01-05", "2024-01-06").select("event_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "value" not in plan.split("ReadSchema")[1]


def test_training_rows_of_a_small_file_are_dealt_among_all_cores(spark, tmp_path, monkeypatch):
    from bindings import transactions as bt
    from sparquill.operators import model

    i = F.col("id")
    ts = F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id * 3 as int))")
    events = spark.range(0, 12_000, 1, 1).select(
        i.alias("event_id"), ts.alias("ts"), (i % 50).alias("user_id"), F.lit("view").alias("event_type"), (i % 120).cast("double").alias("value"), F.format_string('{"k": %d}', i % 9).alias("props")
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    seen = []

    def fitted(ready, *rest, **params):
        seen.append([n for n in ready.rdd.glom().map(len).collect() if n])
        raise InterruptedError

    monkeypatch.setattr(model, "fitted", fitted)
    train, test = bt._model_data(spark, str(tmp_path))
    with pytest.raises(InterruptedError):
        model.train(train, test, "mlp")
    assert len(seen[0]) >= spark.sparkContext.defaultParallelism and max(seen[0]) < 2 * sum(seen[0]) / len(seen[0])
