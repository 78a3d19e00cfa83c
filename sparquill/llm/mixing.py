"""Mixing sources to target weights: tokens per source, repetition rates, and hash-seeded copies of each document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import n_words, partitions, stored, text_of, uniform

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"


def source_targets(docs: DataFrame, source_col: str = "source", text_col: str = "text", weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target): one row per source.

    The targets share all words by weight; a source stops at ``cap`` times its own words and its excess is shared again by weight until
    no source is above. Sources are ranked by code point (null last) through ranges, so no task holds all of them.
    """
    sizes = stored(
        docs.select(F.col(source_col).alias("source"), n_words(text_of(text_col)).alias("size")).groupBy("source").agg(F.sum("size").alias("source_size")),
        "source-sizes",
    )
    order = (F.col("source").isNull(), F.col("source"))
    ranged = stored(sizes.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("id")), "source-ranges")
    before, offsets = 0, {}
    for part, n, first in sorted(tuple(r) for r in ranged.groupBy("part").agg(F.count(F.lit(1)), F.min("id")).collect()):  # one row per partition
        offsets[part] = before - first
        before += n
    rank = F.col("id") + F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv])[F.col("part")] if offsets else F.col("id")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (rank % len(weights)).cast("int") + 1)
    table = ranged.select("source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * cap).alias("most"))
    total, all_weight = table.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    rest, left = total, all_weight
    while left:
        above = F.col("most").cast("decimal(38,0)") * F.lit(left) < F.col("weight").cast("decimal(38,0)") * F.lit(rest)
        capped, of = table.where(above).agg(F.coalesce(F.sum("most"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
        if (total - capped, all_weight - of) == (rest, left):
            break
        rest, left = total - capped, all_weight - of
    share = (F.col("weight") * F.lit(rest)).cast("double") / F.lit(float(left or 1))
    return table.select("source", "source_size", F.least(F.col("most").cast("double"), share).alias("target"))


def copies_of(rate: Column, *identity: Column) -> Column:
    """floor(rate), and one more with the probability of the fraction, decided by the hash of the document."""
    return (F.floor(rate) + F.when(uniform(F.lit(SEED), *identity) < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def with_copies(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(row, size, source_size, target, copies) per document.

    Null texts have no words. Null is a source of its own, ranked last. A source without words keeps each document once. The draw depends on
    the id and the text alone: reruns agree, and rows equal in both are drawn alike.
    """
    targets = source_targets(docs, source_col, text_col, weights, cap)
    rows = docs.select(F.struct("*").alias("row"), F.col(source_col).alias("of"), n_words(text_of(text_col)).alias("size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    row = F.col("row")
    identity = (F.coalesce(row[id_col].cast("string"), F.lit("null")), F.md5(F.coalesce(row[text_col], F.lit(""))))
    return rows.join(targets, F.col("of").eqNullSafe(F.col("source"))).select("row", "size", "source_size", "target", copies_of(rate, *identity).alias("copies"))


def mix_digests(docs: DataFrame, **kw) -> DataFrame:
    """doc_id, size, source_size, target, taken."""
    return with_copies(docs, **kw).select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The mixed corpus: each row as often as its copies say, columns unchanged."""
    out = with_copies(docs, **kw).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])
