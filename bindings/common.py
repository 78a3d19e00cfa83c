"""Helpers shared by the query bindings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, with -0.0 written as 0.0, so that both engines print the same value."""
    return df.select(
        [(F.round(c, digits) + F.lit(0.0)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    )
