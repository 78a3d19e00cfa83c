"""Time-ordered and stratified splits and samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.operators.clean import date_range
from sparquill.plans.scale import kth_rows, top_k, up_to


def seeded_order(seed: int | str, *ids: str) -> Column:
    """A 60-bit pseudo-random number that depends on the seed and the row id only."""
    text = F.concat_ws("-", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def time_split(
    df: DataFrame, ts: str, tie: str, test_size: float = 0.2, start: str | None = None, end: str | None = None, small: int = 200_000
) -> DataFrame:
    """First ``int(n * (1 - test_size))`` rows in time order are train, the rest test; rows without a time come last.

    ``tie`` may be a string or a number. The row at the cut is found by distributed selection over two columns, so the split
    itself is a projection with a literal bound: the rows are neither sorted nor shuffled.
    """
    if not 0 <= test_size <= 1:
        raise ValueError("test_size must lie between 0 and 1")
    rows = date_range(df, ts, start, end)
    cut = int(rows.count() * (1 - test_size))
    last = kth_rows(rows, [ts, tie], [(F.lit(True), cut)], small)[0] if cut else None
    train = up_to(last, [ts, tie]) if last is not None else F.lit(False)
    return rows.withColumn("split", F.when(train, "train").otherwise("test"))


def stratified_split(df: DataFrame, stratum: str, tie: str, test_size: float = 0.2, seed: int = 42, small: int = 200_000) -> DataFrame:
    """The same share of every stratum is train, in seeded pseudo-random order.

    For class labels; one selection finds the cuts of all strata.
    """
    ordered = df.withColumn("_order", seeded_order(seed, tie))
    sizes = df.groupBy(stratum).count().collect()  # one row per class label
    strata = [(F.col(stratum).eqNullSafe(F.lit(r[stratum])), math.floor(r["count"] * (1 - test_size))) for r in sizes]
    strata = [(mine, cut) for mine, cut in strata if cut]
    train = F.lit(False)
    for (mine, _), last in zip(strata, kth_rows(ordered, ["_order", tie], strata, small), strict=True):
        train = train | (mine & up_to(last, ["_order", tie]))
    return ordered.withColumn("split", F.when(train, "train").otherwise("test")).drop("_order")


def time_folds(df: DataFrame, ts: str, tie: str, folds: int = 5, small: int = 200_000) -> DataFrame:
    """Adds ``segment`` 0..folds by time, rows without a time last; fold i trains on segments below i and tests on segment i."""
    n = df.count()
    cuts = [(F.lit(True), n * i // (folds + 1)) for i in range(1, folds + 1)]
    segment = F.lit(0)
    for (_, cut), last in zip(cuts, kth_rows(df, [ts, tie], cuts, small), strict=True):
        segment = segment + (F.when(up_to(last, [ts, tie]), 0).otherwise(1) if last is not None else F.lit(0 if cut else 1))
    return df.withColumn("segment", segment)


def stratified_sample(df: DataFrame, stratum: str, tie: str, n: int = 3, seed: int = 1) -> DataFrame:
    """n rows per stratum in seeded pseudo-random order (a sampling operator, repeatable)."""
    ordered = df.withColumn("_order", seeded_order(seed, tie))
    return top_k(ordered, [stratum], [F.col("_order"), F.col(tie)], n, "pick").drop("_order")


def preview(df: DataFrame, order: list[str], n: int = 5, text: str | None = None, chars: int = 100) -> DataFrame:
    """First n rows in the given order, long text cut for display."""
    head = df.orderBy(*order).limit(n)
    return head if text is None else head.withColumn(text, F.substring(text, 1, chars))
