"""Documents to chunks to vectors."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.functions.text import once, sentences, terms, words
from sparquill.operators.sentences import learned_sentences
from sparquill.sources.stores import append_gallery


def _windows(pieces: Column, length: int, stride: int) -> Column:
    def cut(p: Column) -> Column:
        starts = F.when(F.size(p) > 0, F.sequence(F.lit(1), F.size(p), F.lit(stride)))
        return F.transform(starts, lambda i: F.array_join(F.slice(p, i, length), " "))

    return once(pieces, cut)


def _exploded(df: DataFrame, chunks: Column, text: str) -> DataFrame:
    kept = [c for c in df.columns if c != text]
    return df.select(*kept, F.posexplode(chunks).alias("chunk_no", "chunk"))


def chunk_fixed(df: DataFrame, length: int, overlap: int = 2, text: str = "text") -> DataFrame:
    """Windows of ``length`` words, each sharing ``overlap`` words with the next."""
    if length < 1 or overlap < 0 or length - overlap < 1:
        raise ValueError(f"windows of {length} words cannot share {overlap} words")
    return _exploded(df, _windows(words(text), length, length - overlap), text)


def chunk_sentences(df: DataFrame, sentences_per_chunk: int, text: str = "text") -> DataFrame:
    """Groups of consecutive sentences without overlap."""
    if sentences_per_chunk < 1:
        raise ValueError("sentences_per_chunk must be positive")
    return _exploded(df, _windows(sentences(text), sentences_per_chunk, sentences_per_chunk), text)


def chunk_learned(df: DataFrame, sentences_per_chunk: int, known: DataFrame, text: str = "text") -> DataFrame:
    """Groups of consecutive sentences, with abbreviations as ``sentences.abbreviations`` learns them."""
    if sentences_per_chunk < 1:
        raise ValueError("sentences_per_chunk must be positive")
    split = learned_sentences(df, known, text, "_sentences")
    return _exploded(split, _windows(F.col("_sentences"), sentences_per_chunk, sentences_per_chunk), text).drop("_sentences")


def chunk(df: DataFrame, strategy: str, fixed_length: int | None = None, overlap_size: int = 2) -> DataFrame:
    """Chunking by name: ``sentence`` (overlap_size sentences each) or ``fixed-length``."""
    ways = {"sentence": lambda: chunk_sentences(df, overlap_size), "fixed-length": lambda: chunk_fixed(df, fixed_length or 0, overlap_size)}
    if strategy not in ways:
        raise ValueError(f"{strategy!r} names no chunking; choose from {', '.join(sorted(ways))}")
    return ways[strategy]()


def embed_text(df: DataFrame, text: str, dim: int = 384, out: str = "embedding") -> DataFrame:
    """Default text vector: hashed term counts of unit length, computed by MLlib."""
    counted = HashingTF(numFeatures=dim, inputCol="_terms", outputCol="_tf").transform(df.withColumn("_terms", terms(text)))
    unit = Normalizer(inputCol="_tf", outputCol="_unit").transform(counted)
    return unit.select(*df.columns, vector_to_array("_unit").cast("array<float>").alias(out))


def batch_embed(df: DataFrame, column: str, factory: Callable[[], Callable[[list], list]], out: str = "embedding") -> DataFrame:
    """Vectors from a plugged-in model. ``factory`` runs once per task and returns a function
    from a list of values to a list of vectors."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def run(batches):
        encode = factory()
        for pdf in batches:
            yield pdf.assign(**{out: pd.Series([[float(x) for x in v] for v in encode(list(pdf[column]))], index=pdf.index, dtype=object)})

    return df.mapInPandas(run, f"{fields}, `{out}` array<float>")


def build_corpus(docs: DataFrame, path: str, strategy: str, fixed_length: int | None = None, overlap_size: int = 2, dim: int = 384) -> DataFrame:
    """Chunk, embed and append to the gallery at ``path``; returns the stored chunks."""
    chunks = chunk(docs, strategy, fixed_length, overlap_size)
    append_gallery(embed_text(chunks, "chunk", dim), path, dim)
    return docs.sparkSession.read.parquet(path)
