"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and returns what it keeps of all its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm import jaccard, line_dedup, mixing, pieces, quality
from sparquill.session import use_utc, work_path


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the ids of their texts, and whether the ids decode to the text exactly."""
    done = pieces.decode(pieces.encode(docs), out="_decoded")
    return done.withColumn("exact", F.col("_decoded") == F.coalesce("text", F.lit(""))).drop("_decoded")


STAGES = [
    ("quality rules", drop_bad),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", to_pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    use_utc(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out, path = stage(spark, docs, sf_dir), work_path(spark, "pipeline-" + name.replace(" ", "-"))
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
