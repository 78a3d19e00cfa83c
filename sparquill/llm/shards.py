"""Sharding by sampled splitters: size-weighted key samples give quantile bounds, records are range-partitioned, and overfull
ranges are divided again. Large records are dealt first; the others fill the shards up to one level, in the order of their keys."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparquill.llm.common import stored, uniform
from sparquill.plans.scale import with_bucket

#: Ranges per shard at least. A record larger than such a range is large: there are at most shards * FINE of them.
FINE = 64
#: Rows per range at most, on average, so that ranges stay small on any table.
ROWS = 1_000_000
#: Sampled keys per range; the sample on the driver is this often the number of ranges.
DRAWS = 16


def splitters(keys: DataFrame, total: int, ranges: int) -> list[float]:
    """Quantile bounds of the key column ``h`` from a sample in which a record comes up in proportion to its size.

    A key drawn for more than one range gets a range of its own, so that it can be divided without touching its neighbours.
    """
    draws = ranges * DRAWS
    expect = F.col("size") * F.lit(draws / max(1, total))
    n = F.floor(expect) + F.when(uniform(F.col("h"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) < expect - F.floor(expect), 1).otherwise(0)
    drawn = keys.select(F.col("h").cast("double").alias("h"), n.alias("n")).where("n > 0").groupBy("h").agg(F.sum("n").alias("n")).collect()  # about `draws`
    if not drawn:
        return []
    h, n = (np.array(x) for x in zip(*sorted(tuple(r) for r in drawn), strict=True))
    at = np.searchsorted(np.cumsum(n), np.arange(1, ranges) * n.sum() / ranges, side="left")
    bounds = set(h[at].tolist())
    for k in np.flatnonzero(n > 2 * DRAWS):
        bounds |= {float(h[k]), float(np.nextafter(h[k], np.inf))}
    return sorted(bounds)


def dealt(sizes: list[int], rest: int, shards: int) -> tuple[list[int], list[float]]:
    """(shard of each large record, bytes of the others that each shard takes): every record to the emptiest shard, the largest first, then one level for all that are below it."""
    have, to = [0] * shards, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        to[i] = min(range(shards), key=lambda k: (have[k], k))
        have[to[i]] += sizes[i]
    low, level = sorted(have), 0.0
    for k in range(1, shards + 1):
        level = (rest + sum(low[:k])) / k
        if k == shards or level <= low[k]:
            break
    return to, [max(0.0, level - h) for h in have]


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    Size is the UTF-8 bytes of the text plus 1, so null and empty texts weigh 1. Records larger than 1/64 of a mean shard are dealt to the emptiest shards. The others are
    ordered by a hash of the text, then by id, and cut where the shards are full: a shard is off by at most half a record at either end, unless one record is larger
    than a shard. Equal texts stay together but for those cuts and for overfull ranges, which are divided by the id, and, where ids repeat, by the place in the stored
    table; equal rows are interchangeable. Slots are gapless from 0 in each shard, large records first.
    """
    spark, text = docs.sparkSession, F.coalesce(F.col(text_col), F.lit(""))
    keys = stored(
        docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h")),
        "shard-keys",
    )
    rows, total = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    small = F.col("size") * (shards * FINE) <= total
    large = sorted((tuple(r) for r in keys.where(~small).select("doc_id", "size", "text_crc32", "h").collect()), key=lambda r: (-r[1], r[3], r[0] is None, r[0] or 0))  # at most shards * FINE
    to, quota = dealt([r[1] for r in large], total - sum(r[1] for r in large), shards)
    taken, first = [0] * shards, []
    for k, (doc, size, crc, _) in zip(to, large, strict=True):
        first.append((doc, size, crc, k, taken[k]))
        taken[k] += 1
    keys, total = keys.where(small), total - sum(r[1] for r in large)
    ranges = max(shards * FINE, -(-rows // ROWS))
    full = max(1.0, total / ranges)
    bounds = splitters(keys, total, ranges)
    cut = with_bucket(keys.select("*", F.col("_metadata.row_index").alias("at")), F.col("h").cast("double"), bounds, "range")
    cut = cut.withColumn("part", F.lit(0)).withColumn("piece", F.lit(0))
    for column, salt in (("part", F.xxhash64(F.lit(1), "doc_id")), ("piece", F.xxhash64("at"))):
        names = ["range", "part", "piece"]
        sums = cut.groupBy(*names).agg(F.sum("size").alias("bytes")).where(F.col("bytes") > 2 * full)
        over = [(*r[:3], int(np.ceil(r["bytes"] / full))) for r in sums.collect()]  # at most half as many as ranges
        if over:
            table = spark.createDataFrame(over, "range int, part int, piece int, ways int")
            cut = cut.join(F.broadcast(table), names, "left").withColumn(column, F.coalesce(F.pmod(salt, F.col("ways")), F.lit(0)).cast("int")).drop("ways")
    bytes_before, rows_before, starts = 0, 0, []
    for rng, part, piece, size, n in sorted(tuple(r) for r in cut.groupBy("range", "part", "piece").agg(F.sum("size"), F.count(F.lit(1))).collect()):  # one row per range
        starts.append((rng, part, piece, bytes_before, rows_before))
        bytes_before, rows_before = bytes_before + size, rows_before + n
    table = spark.createDataFrame(starts, "range int, part int, piece int, bytes_before long, rows_before long")
    order = Window.partitionBy("range", "part", "piece").orderBy("h", "doc_id")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    middle = F.col("bytes_before") + F.col("upto") - F.col("size") / 2
    ends = np.cumsum(quota)[:-1].tolist()
    placed = cut.withColumn("nth", F.row_number().over(order) - 1).withColumn("upto", upto).join(F.broadcast(table), ["range", "part", "piece"]).select(
        "doc_id", "size", "text_crc32", sum(((middle >= e).cast("int") for e in ends), F.lit(0)).alias("shard"), (F.col("rows_before") + F.col("nth")).alias("nth")
    )
    placed = stored(placed, "placed")
    offset = {r["shard"]: taken[r["shard"]] - r["nth"] for r in placed.groupBy("shard").agg(F.min("nth").alias("nth")).collect()}  # one row per shard
    at = F.array(*[F.lit(offset.get(k, 0)).cast("long") for k in range(shards)])
    slot = F.col("nth") + F.element_at(at, F.col("shard") + 1)
    kind = f"doc_id {keys.schema['doc_id'].dataType.simpleString()}, size long, text_crc32 long, shard int, slot long"
    every = placed.select("doc_id", "size", "text_crc32", "shard", slot.alias("slot")).unionByName(spark.createDataFrame(first, kind))
    return every.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
