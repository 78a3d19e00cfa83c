"""Tests of independence and of equal distribution, score curves and thresholds."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparquill.operators.profile import rate_by
from sparquill.plans.scale import micros, prefix_sums, range_bounds, with_bucket


def chi2_tail(x: float, dof: int) -> float:
    """P(X > x) for a chi-square variable, by the closed sums for integer degrees of freedom."""
    if dof <= 0 or x <= 0:
        return 1.0
    y = x / 2.0
    a, total = (0.0, 0.0) if dof % 2 == 0 else (0.5, math.erfc(math.sqrt(y)))
    while a < dof / 2.0 - 0.25:
        total += math.exp(a * math.log(y) - y - math.lgamma(a + 1.0))
        a += 1.0
    return min(max(total, 0.0), 1.0)


@F.pandas_udf(T.DoubleType())
def _chi2_tail(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_tail(float(a), int(d)) for a, d in zip(x, dof)])


def chi_square(df: DataFrame, key: Column, label: str, alpha: float = 0.05) -> DataFrame:
    """Independence of a key and a 0/1 label: statistic, p, degrees of freedom, decision.

    With cells (n1, n0) per key value the statistic is
    (sum(n1^2/n) - P^2/N) / (p q): one aggregation over the grouped table.
    A 2x2 table gets the continuity correction.
    """
    cells = rate_by(df, key, label)
    n1, n = F.col("positives").cast("double"), F.col("n").cast("double")
    s = cells.agg(
        F.sum(n1 * n1 / n).alias("s"),
        F.sum(n1).alias("p1"),
        F.sum(n).alias("nn"),
        F.sum(1.0 / n).alias("inv"),
        F.count("*").alias("k"),
    )
    p = F.col("p1") / F.col("nn")
    raw = F.try_divide(F.col("s") - F.col("p1") * p, p * (1 - p))
    scale = F.col("nn") * F.col("inv") * (F.try_divide(F.lit(1.0), F.col("p1")) + F.try_divide(F.lit(1.0), F.col("nn") - F.col("p1")))
    gap = F.sqrt(F.greatest(F.lit(0.0), raw) / scale)
    corrected = F.pow(gap - F.least(F.lit(0.5), gap), 2) * scale
    out = s.select(
        F.when(F.col("k") == 2, corrected).otherwise(raw).alias("statistic"),
        (F.col("k") - 1).cast("bigint").alias("dof"),
    )
    return out.withColumn("p_value", _chi2_tail("statistic", "dof")).withColumn(
        "significant", F.col("p_value") < alpha
    )


def expected_counts(df: DataFrame, key: Column, label: str) -> DataFrame:
    """Observed and expected cell counts of the same table."""
    total = df.agg(F.avg(F.col(label).cast("double")).alias("p")).first()["p"]
    cells = rate_by(df, key, label)
    return cells.select(
        "key",
        "positives",
        "negatives",
        (F.col("n") * F.lit(total)).alias("expected_positives"),
        (F.col("n") * F.lit(1 - total if total is not None else None)).alias("expected_negatives"),
    )


def ks_two_sample(df: DataFrame, value: str, label: str) -> DataFrame:
    """Largest distance between the two empirical distributions, and the asymptotic p-value."""
    one = F.col(label).cast("bigint")
    counts = (
        df.filter(F.col(value).isNotNull() & F.col(label).isNotNull())
        .groupBy(value)
        .agg(F.sum(one).alias("n1"), F.sum(1 - one).alias("n0"))
    )
    cum = prefix_sums(counts, value, ["n1", "n0"])
    gap = F.abs(F.try_divide(F.col("cum_n1"), F.col("total_n1")) - F.try_divide(F.col("cum_n0"), F.col("total_n0")))
    stat = cum.agg(F.max(gap).alias("statistic"), F.max("total_n1").alias("n1"), F.max("total_n0").alias("n0"))
    size = F.col("n1") * F.col("n0") / (F.col("n1") + F.col("n0"))
    x = F.col("statistic") * F.sqrt(size)
    # the alternating series converges badly near 0, where the tail is 1
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * x * x),
    )
    tail = F.when(x < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))
    return stat.withColumn("p_value", F.when(F.col("statistic").isNotNull(), tail))


def time_since_prev(df: DataFrame, card: str, ts: str, tie: str, out: str = "minutes_since_prev") -> DataFrame:
    """Minutes since the previous transaction of the same card; the first one gets null.

    Works on distinct (card, time) pairs cut into time ranges: inside a range ``lag``
    sees the previous pair, and the first pair of a range takes the end of the last
    non-empty range of that card. A card with a large part of the rows is spread over
    all ranges, and rows with equal times collapse before the sort.
    """
    pairs = df.filter(F.col(card).isNotNull() & F.col(ts).isNotNull()).groupBy(card, ts).agg(F.min(tie).alias("_first"))
    time = micros(ts).cast("double")
    ranged = with_bucket(pairs, time, range_bounds(df.select(ts), time))
    inside = Window.partitionBy(card, "_bucket").orderBy(ts)
    ends = ranged.groupBy(card, "_bucket").agg(F.max(ts).alias("_end"))
    carry = ends.select(card, "_bucket", F.lag("_end").over(Window.partitionBy(card).orderBy("_bucket")).alias("_carry"))
    prev = (
        ranged.withColumn("_lag", F.lag(ts).over(inside))
        .join(carry, [card, "_bucket"])
        .select(card, ts, "_first", F.coalesce("_lag", "_carry").alias("_prev"))
    )
    gap = (micros(ts) - micros("_prev")) / F.lit(6e7)
    known = F.col(card).isNotNull() & F.col(ts).isNotNull()  # rows without a card or time have no previous one and stay where they are
    joined = df.filter(known).join(prev, [card, ts], "left").unionByName(df.filter(~known), allowMissingColumns=True)
    return joined.select(
        *df.columns, F.when(F.col(tie) == F.col("_first"), gap).when(F.col("_first").isNotNull(), F.lit(0.0)).alias(out)
    )


def mean_by(df: DataFrame, value: str, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.avg(value).alias(f"mean_{value}"), F.count(value).alias("n"))


def pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Precision, recall and F1 when every row with at least the threshold score is called positive."""
    counts = (
        df.filter(F.col(score).isNotNull())
        .groupBy(F.col(score).alias("threshold"))
        .agg(F.count("*").alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos"))
    )
    cum = prefix_sums(counts, "threshold", ["n", "pos"], descending=True)
    p = F.col("cum_pos") / F.col("cum_n")
    r = F.coalesce(F.try_divide(F.col("cum_pos"), F.col("total_pos")), F.lit(1.0))
    return cum.select(
        "threshold", p.alias("precision"), r.alias("recall"), (2 * p * r / (p + r + F.lit(1e-8))).alias("f1")
    )


def best_threshold(
    df: DataFrame, score: str, label: str, precision_min: float = 0.3, recall_min: float = 0.6
) -> DataFrame:
    """Threshold with the best F1 among those that meet both minima, the lowest on ties; no row if none does."""
    curve = pr_curve(df, score, label)
    valid = curve.filter((F.col("precision") >= precision_min) & (F.col("recall") >= recall_min))
    best = F.max(
        F.struct("f1", (-F.col("threshold")).alias("neg"), "precision", "recall")
    )
    return valid.agg(best.alias("b")).filter(F.col("b").isNotNull()).select(
        (-F.col("b.neg")).alias("threshold"), "b.precision", "b.recall", "b.f1"
    )


def metric_alert(history: DataFrame, predicted: str, label: str, precision_min: float = 0.35, recall_min: float = 0.6) -> DataFrame:
    """Precision and recall of logged decisions, with an alert if either falls below its minimum."""
    hit = F.col(predicted) & (F.col(label) == 1)
    s = history.agg(
        F.count_if(hit).alias("tp"),
        F.count_if(F.col(predicted) & (F.col(label) == 0)).alias("fp"),
        F.count_if(~F.col(predicted) & (F.col(label) == 1)).alias("fn"),
    )
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    return s.select(
        "tp", "fp", "fn", p.alias("precision"), r.alias("recall"),
        ((p < precision_min) | (r < recall_min)).alias("alert"),
    )
