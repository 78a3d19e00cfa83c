"""Building blocks that keep every step spread over the cluster.

None of them sends a whole table, or one whole key, through a single task:
ordered work is cut into value ranges, as many as the rows need, whose bounds come
from approximate quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


PER_RANGE = 1_000_000  # rows in a value range, so ranges grow with the table
MOST_RANGES = 20_000  # bounds that one aggregate finds and every task holds


def micros(c: Column | str) -> Column:
    """Microseconds since the epoch of a naive (or zoned) timestamp, read as UTC."""
    return F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def numeric(df: DataFrame, name: str) -> Column:
    """A double that never decreases when the column increases."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return micros(name).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    raise TypeError(f"column {name} has no numeric order: {kind.simpleString()}")


def range_bounds(df: DataFrame, key: Column, buckets: int | None = None) -> list[float]:
    """At most ``buckets - 1`` distinct cut points of about equal weight; by default a range for every PER_RANGE rows."""
    if buckets is None:
        buckets = min(MOST_RANGES, -(-df.count() // PER_RANGE))
    if buckets < 2:
        return []
    probs = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(key, probs, buckets * 50).alias("q")).first()
    return sorted(set(row["q"] or []))


def with_bucket(df: DataFrame, key: Column, bounds: Sequence[float], out: str = "_bucket") -> DataFrame:
    """Adds the index of the value range a row falls in; equal keys share one range."""
    bounds = [b for b in bounds if b == b and abs(b) != float("inf")]
    if not bounds:
        return df.withColumn(out, F.lit(0))
    splits = [float("-inf"), *bounds, float("inf")]
    cutter = Bucketizer(splits=splits, inputCol="_range_key", outputCol=out, handleInvalid="keep")
    marked = cutter.transform(df.withColumn("_range_key", key))
    return marked.withColumn(out, F.col(out).cast("int")).drop("_range_key")


def prefix_sums(
    df: DataFrame,
    key: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Running sums ``cum_<s>`` and totals ``total_<s>`` in key order, per group of ``by``.

    Give one row per (by, key): reduce first, so that a frequent key is one row.
    """
    by = list(by)
    value = numeric(df, key)
    ranged = with_bucket(df, value, range_bounds(df, value, buckets))
    order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    group = Window.partitionBy(*(by or [F.lit(0)]))
    before = group.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*by, "_bucket").agg(*[F.sum(s).alias(f"_part_{s}") for s in sums])
    # one row per range and group
    offsets = totals.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(f"_part_{s}").over(before), F.lit(0)).alias(f"_before_{s}") for s in sums],
        *[F.sum(f"_part_{s}").over(group).alias(f"total_{s}") for s in sums],
    )
    inside = (
        Window.partitionBy(*by, "_bucket")
        .orderBy(F.col(key).desc() if descending else F.col(key).asc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    running = ranged.select("*", *[F.sum(s).over(inside).alias(f"_run_{s}") for s in sums])
    joined = running.join(offsets, [*by, "_bucket"])
    return joined.select(
        *df.columns,
        *[(F.col(f"_run_{s}") + F.col(f"_before_{s}")).alias(f"cum_{s}") for s in sums],
        *[f"total_{s}" for s in sums],
    )


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), names: Sequence[str] | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    Works on distinct values and their counts, so no task holds all values of a group
    (the built-in exact ``percentile`` does).
    """
    by = list(by)
    names = list(names or [f"q{round(p * 100)}" for p in probs])
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    cum = prefix_sums(counts, value, ["n"], by)
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1
    aggs = []
    for i, p in enumerate(probs):
        rank = F.lit(float(p)) * (F.col("total_n") - 1)
        for side, at in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            aggs.append(F.max(F.when((first <= at) & (at <= last), F.col(value))).alias(f"_{side}{i}"))
        aggs.append(F.max(rank - F.floor(rank)).alias(f"_part{i}"))
    picked = cum.groupBy(*by).agg(*aggs)
    return picked.select(
        *by,
        *[
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_part{i}")).alias(name)
            for i, name in enumerate(names)
        ],
    )


def order_keys(df: DataFrame, name: str) -> list[Column]:
    """Doubles that, compared one after the other, order the rows as ``name`` ascending does, nulls last.

    Strings are cut into six bytes per key, whole numbers and times into two halves, so that no key is rounded.
    """
    kind, c = df.schema[name].dataType, F.col(name)
    null = c.isNull().cast("double")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        longest = df.agg(F.max(F.octet_length(name))).first()[0] or 0
        digits = F.hex(c.cast("binary"))
        pieces = [F.conv(F.rpad(F.substring(digits, 12 * i + 1, 12), 12, "0"), 16, 10).cast("double") for i in range(-(-longest // 6))]
        return [null, *[F.coalesce(p, F.lit(0.0)) for p in pieces], F.coalesce(F.octet_length(c).cast("double"), F.lit(0.0))]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.IntegralType, T.BooleanType, T.DateType)):
        whole = numeric_long(c, kind)
        high = F.shiftright(whole, 26)
        return [null, F.coalesce(high.cast("double"), F.lit(0.0)), F.coalesce((whole - F.shiftleft(high, 26)).cast("double"), F.lit(0.0))]
    if isinstance(kind, T.DecimalType):
        high = F.floor(c / F.lit(10**9).cast("decimal(20,0)"))
        return [null, F.coalesce(high.cast("double"), F.lit(0.0)), F.coalesce((c - high * F.lit(10**9).cast("decimal(20,0)")).cast("double"), F.lit(0.0))]
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return [null, F.isnan(c).cast("double"), F.coalesce(F.when(~F.isnan(c), c.cast("double")), F.lit(0.0))]
    raise TypeError(f"column {name} has no order: {kind.simpleString()}")


def numeric_long(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return micros(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    return c.cast("int").cast("bigint") if isinstance(kind, T.BooleanType) else c.cast("bigint")


def kth_rows(df: DataFrame, order: Sequence[str], wanted: Sequence[tuple[Column, int]], small: int = 200_000) -> list:
    """For every (predicate, k): the k-th row, from 1, of the rows that satisfy the predicate; None beyond the last.

    Rows sort by the given columns ascending, nulls last, at every size. Distributed selection: each pass is one or two aggregates for all
    selections together and narrows the range of one key around each wanted rank; the last ``small`` rows of a selection are sorted. No
    other row is moved. Equal rows are interchangeable.
    """
    keys: list[Column] | None = None
    state = [{"keep": F.coalesce(p, F.lit(False)), "left": k, "at": 0} for p, k in wanted]
    if not state:
        return []
    sizes = df.agg(*[F.count_if(s["keep"]).alias(f"n{i}") for i, s in enumerate(state)]).first()
    for i, s in enumerate(state):
        s["n"] = sizes[i]
    while True:
        if keys is None and any(s["n"] > small for s in state):
            keys = [key for name in order for key in order_keys(df, name)]
        active = [s for s in state if s["n"] > small and s["at"] < len(keys or []) and 0 < s["left"] <= s["n"]]
        if not active:
            break
        aggs = []
        for i, s in enumerate(active):
            p = (s["left"] - 0.5) / s["n"]
            aggs.append(F.percentile_approx(F.when(s["keep"], keys[s["at"]]), [max(p - 0.002, 0.0), min(p + 0.002, 1.0)], 10_000).alias(f"q{i}"))
        bounds = df.agg(*aggs).first()
        aggs = []
        for i, s in enumerate(active):
            (lo, hi), value = bounds[i], keys[s["at"]]
            for name, test in (("below", value < lo), ("lo", value == lo), ("inside", (value >= lo) & (value <= hi)), ("hi", value == hi)):
                aggs.append(F.count_if(s["keep"] & test).alias(f"{name}{i}"))
        counts = df.agg(*aggs).first()
        for i, s in enumerate(active):
            (lo, hi), value, left = bounds[i], keys[s["at"]], s["left"]
            below, at_lo, inside, at_hi = (counts[f"{c}{i}"] for c in ("below", "lo", "inside", "hi"))
            if left <= below:
                test, n = value < lo, below
            elif left > below + inside:
                test, n, left = value > hi, s["n"] - below - inside, left - below - inside
            elif left <= below + at_lo:
                test, n, left, s["at"] = value == lo, at_lo, left - below, s["at"] + 1  # one value left: on to the next key
            elif left > below + inside - at_hi:
                test, n, left, s["at"] = value == hi, at_hi, left - (below + inside - at_hi), s["at"] + 1
            else:
                test, n, left = (value > lo) & (value < hi), inside - at_lo - at_hi, left - below - at_lo
            s.update(keep=s["keep"] & test, n=n, left=left)
    sort = [F.col(c).asc_nulls_last() for c in order]
    out = []
    for s in state:
        if not 0 < s["left"] <= s["n"]:
            out.append(None)
        elif s["n"] > small:  # equal in all keys: any of them
            out.append(df.filter(s["keep"]).select(*order).first())
        else:
            out.append(df.filter(s["keep"]).select(*order).orderBy(*sort).offset(s["left"] - 1).limit(1).first())
    return out


def kth_row(df: DataFrame, order: Sequence[str], k: int, small: int = 200_000):
    """The k-th row (from 1) in the order of the given columns, nulls last, as a Row of these columns."""
    return kth_rows(df, order, [(F.lit(True), k)], small)[0]


def up_to(row, order: Sequence[str]) -> Column:
    """Predicate: the row sorts at or before the given one (lexicographic, nulls last, literal bounds)."""
    test = F.lit(True)
    for name in reversed(list(order)):
        c, bound = F.col(name), row[name]
        if bound is None:
            test = c.isNotNull() | test
        else:
            test = F.coalesce((c < F.lit(bound)) | ((c == F.lit(bound)) & test), F.lit(False))
    return test


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, out: str = "rank") -> DataFrame:
    """First k rows per group. Spark cuts each partition to k rows per group before the shuffle."""
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col(out) <= k)
