"""Features of transactions: time, scaling, target encoding, assembly."""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparquill.operators.stats import time_since_prev

# The eleven features.
NUMERIC = ["amt", "merch_lat", "merch_long", "hour_sin", "hour_cos", "day_sin", "day_cos", "month_sin", "month_cos"]
CATEGORICAL = ["category", "merchant"]
FOLDS = 5


def time_features(df: DataFrame, ts: str = "trans_date_trans_time", since_prev: tuple[str, str] | None = None) -> DataFrame:
    """Hour, weekday (Monday 0), month and their points on the circle.

    ``since_prev`` = (card column, id column) adds the minutes since the card's last transaction.
    """
    def circle(fn, column: str, period: int) -> Column:
        return fn(F.lit(2 * math.pi) * F.col(column) / F.lit(period))

    out = df.withColumns(
        {"hour_of_day": F.hour(ts), "day_of_week": F.weekday(ts), "month": F.month(ts)}
    ).withColumns(
        {
            "hour_sin": circle(F.sin, "hour_of_day", 24),
            "hour_cos": circle(F.cos, "hour_of_day", 24),
            "day_sin": circle(F.sin, "day_of_week", 7),
            "day_cos": circle(F.cos, "day_of_week", 7),
            "month_sin": circle(F.sin, "month", 12),
            "month_cos": circle(F.cos, "month", 12),
        }
    )
    return out if since_prev is None else time_since_prev(out, since_prev[0], ts, since_prev[1])


def fit_scaler(train: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column (one row on the driver)."""
    row = train.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def scale(df: DataFrame, scaler: dict, suffix: str = "_scaled") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scaler.items()})


def _shrunk(n: Column, s: Column, mean: Column, var: Column) -> Column:
    """Group mean pulled to the global mean: weight n*var / (own variance + n*var)."""
    own = F.try_divide(s, n)
    weight = F.try_divide(n * var, own * (1 - own) + n * var)
    return F.coalesce(weight * own + (1 - weight) * mean, mean)


def _long(df: DataFrame, columns: list[str], label: str, *extra: str) -> DataFrame:
    items = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in columns]
    rows = df.select(F.col(label).cast("double").alias("y"), *extra, F.explode(F.array(*items)).alias("i"))
    return rows.select("i.feature", "i.category", "y", *extra)


def fit_encodings(train: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Shrunk label mean per (feature, category); the null category holds the global mean."""
    counts = _long(train, columns, label).groupBy("feature", "category").agg(F.count("*").alias("n"), F.sum("y").alias("s"))
    mean = train.agg(F.avg(F.col(label).cast("double")).alias("p")).first()["p"] or 0.0
    own = counts.filter(F.col("category").isNotNull()).select(
        "feature", "category", _shrunk(F.col("n"), F.col("s"), F.lit(mean), F.lit(mean * (1 - mean))).alias("encoding")
    )
    rows = [(c, None, float(mean)) for c in columns]
    rest = train.sparkSession.createDataFrame(rows, "feature string, category string, encoding double")
    return own.unionByName(rest)


def apply_encodings(df: DataFrame, encodings: DataFrame, columns: list[str], suffix: str = "_encoded") -> DataFrame:
    """Looks up every category, unseen ones get the global mean. Spark picks the join by the size of the side."""
    default = {r["feature"]: r["encoding"] for r in encodings.filter(F.col("category").isNull()).collect()}
    for c in columns:
        side = encodings.filter((F.col("feature") == c) & F.col("category").isNotNull())
        side = side.select(F.col("category").alias(f"_{c}"), F.col("encoding").alias("_e"))
        df = df.join(side, F.col(c).cast("string") == F.col(f"_{c}"), "left")
        df = df.withColumn(f"{c}{suffix}", F.coalesce("_e", F.lit(default[c]))).drop("_e", f"_{c}")
    return df


def cross_fit_encode(train: DataFrame, columns: list[str], label: str, fold: Column, id_col: str, suffix: str = "_encoded") -> DataFrame:
    """Encodes the training rows, each fold from the other folds only."""
    folded = train.withColumn("_fold", fold.cast("int"))
    totals = {
        r["_fold"]: (r["n"], r["s"])
        for r in folded.groupBy("_fold").agg(F.count("*").alias("n"), F.sum(F.col(label).cast("double")).alias("s")).collect()
    }  # one row per fold
    n_all, s_all = sum(n for n, _ in totals.values()), sum(s for _, s in totals.values())
    means = {f: ((s_all - s) / (n_all - n) if n_all > n else s_all / n_all) for f, (n, s) in totals.items()}
    if not means:
        return train.withColumns({f"{c}{suffix}": F.lit(None).cast("double") for c in columns})
    pick = F.create_map(*[F.lit(x) for kv in means.items() for x in kv])
    per_fold = _long(folded, columns, label, "_fold").filter(F.col("category").isNotNull()).groupBy("feature", "category", "_fold").agg(
        F.count("*").alias("n"), F.sum("y").alias("s")
    )
    group = Window.partitionBy("feature", "category")  # at most one row per fold
    mean = pick[F.col("_fold")]
    table = per_fold.select(
        "feature",
        "category",
        "_fold",
        _shrunk(
            F.sum("n").over(group) - F.col("n"), F.sum("s").over(group) - F.col("s"), mean, mean * (1 - mean)
        ).alias("_e"),
    )
    out = folded
    for c in columns:
        side = table.filter(F.col("feature") == c).select(F.col("category").alias("_key"), "_fold", "_e")
        out = out.withColumn("_key", F.col(c).cast("string")).join(side, ["_key", "_fold"], "left")
        out = out.withColumn(f"{c}{suffix}", F.coalesce("_e", pick[F.col("_fold")])).drop("_e", "_key")
    return out.drop("_fold")


def hashed_fold(id_col: str, folds: int = FOLDS) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(folds))


def feature_vector(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    """Features side by side on the same row."""
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="error").transform(df)
