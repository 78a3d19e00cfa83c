"""Token counts with a digest cache.

The cache is a Parquet table in a shared folder, one sub-folder per tokenizer version (the SHA-256 of its file and of the library's name and version).
Distinct contents are found by digest, joined to the cache, and only what it lacks is encoded; the new counts are appended as a folder of their own, so
runs may append at the same time and a killed one leaves nothing half written. Counts then meet the rows by digest.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from sparquill.llm.common import attach, stored, text_of
from sparquill.session import work_path

LIMIT = 4096
#: Bytes of text that a worker holds as Python objects at a time; a longer text is one slice.
SLICE = 1 << 20
#: Code points after which a long text may be cut where the model allows it.
CHUNK = 1 << 16
SPACE = "▁"
MARKS = " " + SPACE
CACHED = "digest binary, n_tokens long"


class Tokenizer:
    """A tokenizer file (.model: sentencepiece, .json: tokenizers) as bytes, its version and what its counts depend on."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.data = f.read()
        self.kind = path.rsplit(".", 1)[-1]
        if self.kind not in ("model", "json"):
            raise ValueError(f"no library is known for {path}")
        library = "sentencepiece" if self.kind == "model" else "tokenizers"
        name = f"{library}-{importlib.metadata.version(library)}-"
        self.version = hashlib.sha256(name.encode() + self.data).hexdigest()
        self.plain = self.kind == "model" and _plain(self.data)

    def content(self, text: Column) -> Column:
        """What the count depends on: a plain model does not tell a space from its own mark for it."""
        return F.replace(text, F.lit(SPACE), F.lit(" ")) if self.plain else text


def _plain(proto: bytes) -> bool:
    """Whether the model is a byte-pair one that takes texts as they are, and merges nothing across the start of a word.

    Then a text may be cut before any space that follows another character: the prefix that the model puts before a text stands for that space.
    """
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(proto)
    spec, trained = model.normalizer_spec, model.trainer_spec
    as_is = spec.add_dummy_prefix and spec.escape_whitespaces and not spec.remove_extra_whitespaces and not spec.precompiled_charsmap
    own = any(p.type == p.USER_DEFINED for p in model.pieces)
    across = any(SPACE in p.piece.lstrip(SPACE) for p in model.pieces)
    return bool(trained.model_type == trained.BPE and as_is and not trained.treat_whitespace_as_suffix and not own and not across)


def chunks(text: str, size: int = CHUNK) -> list[str]:
    """The text cut before spaces that follow another character, about every ``size`` code points; each cut drops its space. Where there is none, no cut."""
    out, lo = [], 0
    while len(text) - lo > size:
        at = text.find(" ", lo + size)
        while at > 0 and text[at - 1] in MARKS:
            at = text.find(" ", at + 1)
        if at in (-1, len(text) - 1):  # an empty rest would lose the cut's space
            break
        out.append(text[lo:at])
        lo = at + 1
    return [*out, text[lo:]]


@lru_cache(maxsize=4)
def _counter(kind: str, plain: bool, data: bytes) -> Callable[[list[str]], list[int]]:
    if kind == "model":
        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        if not plain:
            return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        return lambda texts: [sum(len(model.encode(part)) for part in chunks(t)) if len(t) > CHUNK else len(model.encode(t)) for t in texts]
    tokenizer = tokenizers.Tokenizer.from_str(data.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(x.ids) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _encoded(batches: Iterator[pa.RecordBatch], count: Callable[[list[str]], list[int]]) -> Iterator[pa.RecordBatch]:
    """Counts where there is none yet."""
    names = ["digest", "copies", "n_tokens", "hit"]
    for batch in batches:
        n, hit = np.asarray(batch.column("n_tokens").fill_null(-1)).copy(), np.asarray(batch.column("n_tokens").is_valid())
        size = np.cumsum(np.asarray(pc.binary_length(batch.column("content")).fill_null(0), np.int64))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + SLICE, side="right")))
            new = np.flatnonzero(~hit[lo:hi]) + lo
            n[new] = count(batch.column("content").take(pa.array(new)).to_pylist())
            lo = hi
        yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("copies"), pa.array(n), pa.array(hit)], names=names)


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)


def cached_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) of a tokenizer version, one row per digest, although runs at the same time may have appended a digest twice."""
    folder = f"{cache}/{version}"
    if not _exists(spark, folder):
        return spark.createDataFrame([], CACHED)
    return spark.read.schema(f"{CACHED}, run string").parquet(folder).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per input row.

    ``tokenizer`` is a file of the driver; its bytes go to the tasks. ``cache`` is a folder that all executors reach; without it the run has a new, empty
    one below spark.checkpoint.dir. Null and empty texts have no bytes and no tokens. Repeated rows and rows without an id count like any other.
    """
    spark, of = docs.sparkSession, Tokenizer(tokenizer)
    cache = (cache or work_path(spark, "token-cache")).rstrip("/")
    text = text_of(text_col)
    content = of.content(text)
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), F.unhex(F.sha2(content, 256)).alias("digest"))
    distinct = docs.select(F.unhex(F.sha2(content, 256)).alias("digest"), content.alias("content")).groupBy("digest").agg(F.first("content").alias("content"), F.count(F.lit(1)).alias("copies"))
    known = distinct.join(cached_counts(spark, cache, of.version), "digest", "left")
    wanted = known.select("digest", "copies", "n_tokens", F.when(F.col("n_tokens").isNull(), F.col("content")).alias("content"))
    shared, kind, plain = spark.sparkContext.broadcast(of.data), of.kind, of.plain
    counts = stored(wanted.mapInArrow(lambda b: _encoded(b, _counter(kind, plain, shared.value)), "digest binary, copies long, n_tokens long, hit boolean"), "token-counts")
    counts.where("not hit").select("digest", "n_tokens").write.parquet(f"{cache}/{of.version}/run={uuid.uuid4().hex}")
    total = counts.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    back = attach(keyed, counts.drop("hit"), ["digest"], "copies", total, F.xxhash64("doc_id"))
    return back.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
