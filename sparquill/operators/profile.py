"""Data-quality profile, rates and descriptions of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparquill.plans.scale import exact_quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of 64-bit integer or double type."""
    return [f.name for f in df.schema if isinstance(f.dataType, (T.LongType, T.DoubleType))]


def profile_table(df: DataFrame, label: str, key: str, approximate: bool = False) -> DataFrame:
    """Row and column count, positives and distinct keys (nulls ignored)."""
    distinct = F.approx_count_distinct(key) if approximate else F.count_distinct(F.col(key))
    return df.agg(
        F.count("*").alias("row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.sum(F.col(label).cast("bigint")).alias("positives"),
        distinct.alias("unique_keys"),
    )


def profile_completeness(df: DataFrame) -> DataFrame:
    """Share of filled cells, of complete rows and of complete columns, in one pass."""
    cols = df.columns
    filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    row = df.agg(
        F.count("*").alias("n"),
        F.count_if(filled).alias("full_rows"),
        *[F.count(c).alias(f"c{i}") for i, c in enumerate(cols)],
    )
    counts = [F.col(f"c{i}") for i in range(len(cols))]
    cells = reduce(lambda a, b: a + b, counts)
    whole = reduce(lambda a, b: a + b, [(c == F.col("n")).cast("int") for c in counts])
    return row.select(
        F.try_divide(cells, F.col("n") * len(cols)).alias("table_completeness"),
        F.try_divide(F.col("full_rows"), F.col("n")).alias("row_completeness"),
        (whole / F.lit(len(cols))).alias("column_completeness"),
    )


def profile_columns(df: DataFrame) -> DataFrame:
    """Null count of every column, mean and sample deviation of the numeric ones, in one pass."""
    nums = set(numeric_columns(df))
    row = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
        *[F.avg(c).alias(f"a{i}") for i, c in enumerate(df.columns) if c in nums],
        *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(df.columns) if c in nums],
    )
    nothing = F.lit(None).cast("double")
    items = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"n{i}").alias("null_count"),
            (F.col(f"a{i}") if c in nums else nothing).alias("mean"),
            (F.col(f"s{i}") if c in nums else nothing).alias("std"),
        )
        for i, c in enumerate(df.columns)
    ]
    return row.select(F.inline(F.array(*items)))


def profile_outliers(df: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Rows per numeric column whose z-score exceeds the threshold; the one-row
    statistics of the first pass enter the second pass as literals."""
    nums = numeric_columns(df)
    s = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c) for c in nums]).first()
    counts = []
    for c in nums:
        mean, std = s[c]["m"], s[c]["s"]
        far = F.lit(False) if not std else F.abs((F.col(c) - F.lit(mean)) / F.lit(std)) > threshold
        counts.append(F.count_if(far).alias(c))
    row = df.agg(*counts)
    return row.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("outliers_count")) for c in nums]))
    )


def rate_by(df: DataFrame, key: Column, label: str, name: str = "key") -> DataFrame:
    """Rows, positives, percentage and negatives per key value."""
    grouped = df.groupBy(key.alias(name)).agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("bigint")).alias("positives")
    )
    return grouped.select(
        name,
        "n",
        "positives",
        (F.col("positives") / F.col("n") * 100).alias("percent"),
        (F.col("n") - F.col("positives")).alias("negatives"),
    )


def describe_by(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max per group, missing values left out."""
    moments = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    return moments.join(exact_quantiles(df, value, [0.25, 0.5, 0.75], by), by)


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same description for several columns, one row per column."""
    kinds = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    return describe_by(df.select(F.inline(F.array(*kinds))), "value", ["column_name"])


def density_histogram(df: DataFrame, value: str, by: list[str], bins: int = 500, upper: float = 0.99) -> DataFrame:
    """Density histogram per group over [0, quantile]; the last bin is closed, larger values are left out."""
    rows = df.filter(F.col(value).isNotNull())
    counts = rows.groupBy(*by, value).agg(F.count("*").alias("n"))
    limit = exact_quantiles(rows, value, [upper], by, ["limit"])
    inside = counts.join(limit, by).filter((F.col(value) >= 0) & (F.col(value) <= F.col("limit")))
    width = F.col("limit") / F.lit(bins)
    slot = F.least(F.floor(F.col(value) / width), F.lit(bins - 1)).cast("int")
    binned = inside.groupBy(*by, F.coalesce(slot, F.lit(0)).alias("bin"), "limit").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*by))
    return binned.select(
        *by,
        "bin",
        (F.col("bin") * width).alias("bin_start"),
        "n",
        F.try_divide(F.col("n"), total * width).alias("density"),
    )


def split_profile(df: DataFrame, split: str, label: str) -> DataFrame:
    """Size, feature count and class share of every split, one row per (split, label)."""
    features = len([c for c in df.columns if c != split]) - 1
    counts = df.groupBy(split, label).agg(F.count("*").alias("n"))
    size = F.sum("n").over(Window.partitionBy(split))
    return counts.select(
        split,
        label,
        "n",
        size.alias("split_size"),
        (F.col("n") / size).alias("share"),
        F.lit(features).cast("bigint").alias("feature_count"),
    )
