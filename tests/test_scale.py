import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparquill.plans import scale


def test_prefix_sums_match_a_plain_running_sum(spark):
    rng = random.Random(1)
    rows = [(g, float(k), rng.randint(1, 9)) for g in "ab" for k in range(500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k double, n bigint")
    for descending in (False, True):
        got = {(r.g, r.k): (r.cum_n, r.total_n) for r in scale.prefix_sums(df, "k", ["n"], ["g"], descending, 7).collect()}
        for g in "ab":
            run, mine = 0, sorted((r for r in rows if r[0] == g), key=lambda r: r[1], reverse=descending)
            for r in mine:
                run += r[2]
                assert got[(g, r[1])] == (run, sum(x[2] for x in mine))


def test_quantiles_interpolate_and_survive_a_value_that_holds_a_third(spark):
    values = [5.0] * 400 + [float(i) for i in range(800)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    row = scale.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.99, 1.0]).first()
    assert np.allclose(list(row), np.quantile(values, [0, 0.25, 0.5, 0.99, 1]))


@pytest.mark.parametrize("k", [1, 7, 150, 333, 334, 999, 1000])
def test_kth_row_narrows_through_ties(spark, k):
    t0 = datetime(2024, 1, 1)
    rows = [(t0 + timedelta(days=0 if i % 3 == 0 else i), i) for i in range(1000)]  # a third at one instant
    df = spark.createDataFrame(rows, "ts timestamp_ntz, id bigint")
    got = scale.kth_row(df, ["ts", "id"], k, small=5)
    assert (got.ts, got.id) == sorted(rows)[k - 1]
    assert df.filter(scale.up_to(got, ["ts", "id"])).count() == k


@pytest.mark.parametrize("small", [5, 200_000])
def test_selection_orders_strings_nulls_and_ties_alike_at_every_size(spark, small):
    t0 = datetime(2024, 1, 1)
    rows = [(None if i % 9 == 0 else t0 + timedelta(days=i % 7), None if i % 11 == 0 else f"T{i * 37 % 400}" + "é" * (i % 3), i % 2, None if i % 5 == 0 else float("nan") if i % 7 == 0 else -i / 3) for i in range(600)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, trans_num string, half int, x double")
    key = lambda v: (True,) if v is None else (False, v != v, 0 if v != v else v)
    for order in (["ts", "trans_num"], ["trans_num"], ["x", "trans_num"]):
        at = [df.columns.index(c) for c in order]
        text = lambda r: tuple((r[k] is None, (r[k] or "").encode()) if df.columns[k] == "trans_num" else key(r[k]) for k in at)
        for half in (0, 1):
            mine = sorted((r for r in rows if r[2] == half), key=text)
            ks = [1, 17, 150, 299, 300]
            got = scale.kth_rows(df, order, [(F.col("half") == half, k) for k in ks], small)
            assert [str(tuple(g)) for g in got] == [str(tuple(mine[k - 1][j] for j in at)) for k in ks]
    got = scale.kth_row(df, ["ts", "trans_num"], 480, small)
    assert df.filter(scale.up_to(got, ["ts", "trans_num"])).count() >= 480
    assert scale.kth_row(df, ["ts"], 601, small) is None


def test_ranges_grow_with_the_table(spark, monkeypatch):
    df = spark.range(1000).select((F.col("id") % 700).cast("double").alias("v"))
    want = scale.exact_quantiles(df, "v", [0.1, 0.5, 0.9]).first()
    assert scale.range_bounds(df, F.col("v")) == []
    monkeypatch.setattr(scale, "PER_RANGE", 20)
    assert len(scale.range_bounds(df, F.col("v"))) > 40
    assert scale.exact_quantiles(df, "v", [0.1, 0.5, 0.9]).first() == want


def test_top_k_per_group(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    out = scale.top_k(df, ["g"], [F.col("id").desc()], 2)
    assert sorted((r.g, r.id) for r in out.collect()) == [(0, 96), (0, 99), (1, 94), (1, 97), (2, 95), (2, 98)]
