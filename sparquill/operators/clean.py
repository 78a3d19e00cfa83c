"""Joining, cleaning and checking transaction records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Output column order and fill literal.
COLUMN_ORDER = [
    "trans_date_trans_time", "cc_num", "merchant", "category", "amt", "first", "last", "sex",
    "street", "city", "state", "zip", "lat", "long", "city_pop", "job", "dob", "trans_num",
    "unix_time", "merch_lat", "merch_long", "is_fraud",
]
UNKNOWN = "unknown"

REQUIRED = ["trans_date_trans_time", "cc_num", "amt", "merch_lat", "merch_long"]


def join_sources(txn: DataFrame, labels: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions with their label and customer (inner, SQL null semantics).

    One card may hold a large part of the transactions: adaptive execution splits its partition.
    """
    labelled = txn.join(labels, "trans_num", "inner")
    return labelled.join(customers, "cc_num", "inner")


def lower_strings(df: DataFrame) -> DataFrame:
    return df.select(
        [F.lower(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema]
    )


def parse_time(df: DataFrame, ts: str = "trans_date_trans_time", strict: bool = True) -> DataFrame:
    """Text to naive timestamp. Strict parsing fails the job, otherwise bad text becomes null."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df
    parsed = F.expr(f"cast(`{ts}` as timestamp_ntz)" if strict else f"try_cast(`{ts}` as timestamp_ntz)")
    return df.withColumn(ts, parsed)


def impute_unix_time(df: DataFrame, ts: str = "trans_date_trans_time", unix: str = "unix_time") -> DataFrame:
    """Fills missing epoch seconds from the timestamp and marks the filled rows."""
    seconds = F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(1e6)
    return df.withColumn("unix_time_imputed", F.col(unix).isNull()).withColumn(
        unix, F.coalesce(F.col(unix).cast("double"), seconds)
    )


def group_mode(df: DataFrame, group: str, target: str) -> DataFrame:
    """Most frequent target value per group, smallest value on ties; one row per group."""
    counts = (
        df.filter(F.col(group).isNotNull() & F.col(target).isNotNull())
        .groupBy(group, target)
        .agg(F.count("*").alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col(target).alias("v")))
    return counts.groupBy(group).agg(best.alias("m")).select(group, F.col("m.v").alias("_mode"))


def impute_category(df: DataFrame, group: str = "merchant", target: str = "category") -> DataFrame:
    """Missing target from the mode of its group; what is left becomes the unknown literal."""
    filled = df.join(group_mode(df, group, target), group, "left")
    return filled.select(
        [
            F.coalesce(F.col(target), F.col("_mode"), F.lit(UNKNOWN)).alias(target)
            if c == target
            else F.coalesce(F.col(group), F.lit(UNKNOWN)).alias(group)
            if c == group
            else F.col(c)
            for c in df.columns
        ]
    )


def prune_columns(df: DataFrame, order: list[str] = COLUMN_ORDER) -> DataFrame:
    return df.select(*[c for c in order if c in df.columns])


def clean_transactions(df: DataFrame, label: str = "is_fraud", sort: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse, lower-case, drop unlabelled rows, impute, prune and order by time.

    The final sort is a range shuffle; Spark drops it when an aggregation follows.
    """
    out = lower_strings(parse_time(df)).filter(F.col(label).isNotNull())
    out = impute_category(impute_unix_time(out))
    out = prune_columns(out, COLUMN_ORDER + [c for c in keep if c not in COLUMN_ORDER])
    return out.orderBy("trans_date_trans_time", "trans_num") if sort else out


def date_range(
    df: DataFrame,
    ts: str = "trans_date_trans_time",
    start: str | None = None,
    end: str | None = None,
    end_inclusive_day: bool = False,
) -> DataFrame:
    """Rows between two instants, both included. A bare end date means its midnight
    unless ``end_inclusive_day`` is set. The bounds are literals, so Parquet prunes on them."""
    def bound(text: str) -> Column:
        return F.lit(text).cast("timestamp_ntz")

    if start is not None:
        df = df.filter(F.col(ts) >= bound(start))
    if end is not None and end_inclusive_day:
        df = df.filter(F.col(ts) < F.expr(f"cast('{end}' as timestamp_ntz) + interval 1 day"))
    elif end is not None:
        df = df.filter(F.col(ts) <= bound(end))
    return df


def date_bounds(df: DataFrame, ts: str = "trans_date_trans_time") -> DataFrame:
    return df.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def validate_input(df: DataFrame, amount_limit: float = 10_000.0) -> DataFrame:
    """Raw text records to typed ones with ``valid``, ``problem`` and ``outlier`` flags.

    Nothing is dropped: filter on ``valid`` to score, and on its negation to quarantine.
    """
    typed = df.select(
        F.expr("try_cast(trans_date_trans_time as timestamp_ntz)").alias("trans_date_trans_time"),
        F.col("cc_num").cast("string").alias("cc_num"),
        F.expr("try_cast(unix_time as double)").alias("unix_time"),
        "merchant",
        "category",
        *[F.expr(f"try_cast({c} as double)").alias(c) for c in ("amt", "merch_lat", "merch_long")],
        *[c for c in df.columns if c not in (
            "trans_date_trans_time", "cc_num", "unix_time", "merchant", "category", "amt", "merch_lat", "merch_long")],
    )
    problems = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED]))
    return typed.withColumns(
        {
            "problem": F.array_join(problems, ","),
            "valid": F.size(problems) == 0,
            "outlier": F.coalesce(F.abs("amt") > F.lit(amount_limit), F.lit(False)),
        }
    )
