"""SentencePiece encoding and decoding, with a max-plus parallel scan for giant documents.

A document of ordinary length is encoded by the library. A giant one is cut into chunks anywhere. The states at a cut are the pieces that may cover it, and a
chunk yields a max-plus matrix from the states at its left cut to those at its right cut. The matrices of a document are combined, which fixes
the state at every cut, and then each chunk is traced back by itself.

The public vocabulary is a byte-pair one, so a path's weight is not a sum of piece scores (that would give another segmentation than the model's own): a sequence
of pieces is the model's encoding if and only if the model leaves each adjacent pair of them as it is. An edge therefore weighs 0 if the pair is
left alone and minus infinity if not, and the one path of weight 0 is the encoding. Inside a chunk no piece spans the start of a word, so
all paths meet there: the lattice is laid out from a cut to the next word start only, and over the whole chunk where it has none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from sparquill.llm.common import stored

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Code points per chunk; documents of more than two chunks are giant.
CHUNK = 1 << 14
#: Bytes of text that a worker turns into ids at a time.
SLICE = 1 << 20
SPACE = "▁"
#: The piece of a character that the vocabulary lacks; it becomes bytes.
UNKNOWN = -1
START = (-2, -2, -2)


class Vocabulary:
    """The model, and what its pieces allow."""

    def __init__(self, proto: bytes):
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(proto)
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only byte-pair models with identity normalization are supported")
        if any(p.type in (4, 5) for p in model.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        spec.add_dummy_prefix = False
        self.inner = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.piece = {p.piece: k for k, p in enumerate(model.pieces) if p.type == 1}
        self.text = {k: p for p, k in self.piece.items()}
        self.longest = max(map(len, self.piece))
        if any(c not in self.piece for p in self.piece for c in p):
            raise ValueError("a character of a piece is no piece")
        self.splits_words = not any(SPACE in p.lstrip(SPACE) for p in self.piece)
        self._stable: dict[int, bool] = {}
        self._pairs: dict[tuple[int, int], bool] = {}

    def encode(self, normal: str) -> list[int]:
        """Ids of a stretch of normalized text."""
        return self.inner.encode(normal)

    def stable(self, piece: int) -> bool:
        if piece not in self._stable:
            self._stable[piece] = self.encode(self.text[piece]) == [piece]
        return self._stable[piece]

    def stays(self, a: int, b: int) -> bool:
        """Whether the model leaves two adjacent pieces as they are; an unknown character takes part in no merge."""
        if a < 0 or b < 0:
            return True
        if (a, b) not in self._pairs:
            self._pairs[a, b] = self.encode(self.text[a] + self.text[b]) == [a, b]
        return self._pairs[a, b]

    def starting(self, normal: str, at: int) -> list[tuple[int, int]]:
        """(end, piece) of the pieces that may start here."""
        if normal[at] not in self.piece:
            return [(at + 1, UNKNOWN)]
        found = []
        for end in range(at + 1, min(len(normal), at + self.longest) + 1):
            piece = self.piece.get(normal[at:end])
            if piece is not None and self.stable(piece):
                found.append((end, piece))
        return found

    def states(self, normal: str, cut: int) -> list[tuple[int, int, int]]:
        """(start, end, piece), relative to the cut, of the pieces that may cover the character before it."""
        return [(s - cut, e - cut, p) for s in range(max(0, cut - self.longest), cut) for e, p in self.starting(normal, s) if e >= cut]


@lru_cache(maxsize=2)
def vocabulary(proto: bytes) -> Vocabulary:
    return Vocabulary(proto)


def _forward(v: Vocabulary, normal: str, sources: list[tuple[int, int, int]], stop: int, before: dict | None = None) -> tuple[dict, dict]:
    """Runs the lattice from the sources (end, piece, bits) up to ``stop``.

    Returns the bits that reach each piece (start, end, piece) at or over the stop, and per piece at the positions before it. ``before`` collects for each piece
    the one before it.
    """
    live: dict[int, dict] = {}
    done: dict[tuple[int, int, int], int] = {}
    for end, piece, bits in sources:
        live.setdefault(end, {})
        live[end][piece] = live[end].get(piece, 0) | bits
    first = min(live, default=stop)
    for at in range(first, stop):
        here = live.pop(at, None)
        if not here:
            continue
        for end, piece in v.starting(normal, at):
            bits = 0
            for left, mask in here.items():
                if v.stays(left, piece):
                    bits |= mask
                    if before is not None:
                        before[at, end, piece] = (at, left)
            if bits:
                if end >= stop:
                    done[at, end, piece] = done.get((at, end, piece), 0) | bits
                else:
                    of = live.setdefault(end, {})
                    of[piece] = of.get(piece, 0) | bits
    return done, live


class Chunk:
    """One chunk: normalized text with margins; ``lo`` and ``hi`` are its cuts in it."""

    def __init__(self, v: Vocabulary, text: str, lo: int, hi: int, first: bool):
        self.v, self.normal, self.lo, self.hi = v, text, lo, hi
        self.left = [START] if first else v.states(text, lo)
        self.right = v.states(text, hi)
        self.sources = [(lo, START[2], 1)] if first else [(lo + e, p, 1 << k) for k, (_, e, p) in enumerate(self.left)]
        self.meet = self._meetings() if v.splits_words else None

    def _meetings(self) -> tuple[int, int] | None:
        """The first and the last word start that lie clear of both cuts."""
        a = re.compile(f"(?<=[^{SPACE}]){SPACE}").search(self.normal, self.lo + self.v.longest, self.hi - self.v.longest)
        if a is None:
            return None
        b = self.normal.rfind(SPACE, a.start(), self.hi - self.v.longest)
        while b > a.start() and self.normal[b - 1] == SPACE:
            b -= 1
        return a.start(), b

    def matrix(self) -> np.ndarray:
        """Weights from the left to the right states: 0, or minus infinity."""
        out = np.full((len(self.left), len(self.right)), -np.inf, np.float32)
        if self.meet is None:
            done, _ = _forward(self.v, self.normal, self.sources, self.hi)
            for (s, e, p), bits in done.items():
                k = self.right.index((s - self.hi, e - self.hi, p))
                for i in range(len(self.left)):
                    if bits >> i & 1:
                        out[i, k] = 0
            return out
        a, b = self.meet
        head, _ = _forward(self.v, self.normal, self.sources, a)
        came = 0
        for bits in head.values():
            came |= bits
        for end, _, bits in self.sources:
            came |= bits if end == a else 0
        tail, _ = _forward(self.v, self.normal, [(b, START[2], 1)], self.hi)
        for s, e, p in tail:
            k = self.right.index((s - self.hi, e - self.hi, p))
            for i in range(len(self.left)):
                if came >> i & 1:
                    out[i, k] = 0
        return out

    def _walk(self, source: tuple[int, int, int], stop: int, target: tuple[int, int, int] | None) -> list[int]:
        """The pieces of the one path from the source to the target, or to any piece that ends at ``stop``."""
        before: dict = {}
        done, _ = _forward(self.v, self.normal, [(source[0], source[1], 1)], stop, before)
        if target is None:
            if source[0] == stop:
                return []
            target = next(t for t in done if t[1] == stop)
        path, at = [], target
        while True:
            path.append(at)
            start, left = before[at]
            if start == source[0] and left == source[1]:
                break
            size = 1 if left == UNKNOWN else len(self.v.text[left])
            at = (start - size, start, left)
        out: list[int] = []
        for start, end, piece in reversed(path):
            out += self.v.encode(self.normal[start:end]) if piece == UNKNOWN else [piece]
        return out

    def ids(self, i: int, k: int) -> list[int]:
        """Ids of the pieces that start in the chunk, between the chosen states."""
        end, piece, _ = self.sources[i]
        s, e, p = self.right[k]
        target = (s + self.hi, e + self.hi, p)
        if self.meet is None:
            return self._walk((end, piece), self.hi, target)
        a, b = self.meet
        middle = self.v.encode(self.normal[a:b]) if b > a else []
        return self._walk((end, piece), a, None) + middle + self._walk((b, START[2]), self.hi, target)


def cuts(n: int, chunk: int) -> list[int]:
    """Cuts of a normalized text of n characters; the last chunk takes the rest."""
    return [*range(0, max(1, n - chunk + 1), chunk)][: max(1, n // chunk)] + [n]


def combined(matrices: list[np.ndarray]) -> np.ndarray:
    """Max-plus product, taken in pairs: any bracketing gives the same."""
    while len(matrices) > 1:
        matrices = [_product(*matrices[k : k + 2]) if k + 1 < len(matrices) else matrices[k] for k in range(0, len(matrices), 2)]
    return matrices[0]


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def chosen_states(matrices: list[np.ndarray]) -> list[int]:
    """The state at every cut on the best path: prefixes from the left against suffixes from the right, each a product of matrices."""
    ahead = [np.zeros(matrices[0].shape[0], np.float32)]
    for m in matrices:
        ahead.append((ahead[-1][:, None] + m).max(axis=0))
    back = [np.zeros(matrices[-1].shape[1], np.float32)]
    for m in reversed(matrices):
        back.append((m + back[-1][None, :]).max(axis=1))
    best = [a + b for a, b in zip(ahead, reversed(back), strict=True)]
    if any(not np.isfinite(x.max()) for x in best):
        raise ValueError("no path: the model is not a byte-pair one")
    return [int(x.argmax()) for x in best]


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


KEY = ["doc", "sig"]


def _slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Runs of rows of at most SLICE bytes of text, or one row: what a worker holds as Python objects at a time."""
    ends = np.cumsum(np.asarray(pc.binary_length(batch.column(text)).fill_null(0), np.int64))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _short(batches: Iterator[pa.RecordBatch], proto: bytes) -> Iterator[pa.RecordBatch]:
    v = vocabulary(proto)
    for whole in batches:
        for batch in _slices(whole):
            ids = pa.array(v.whole.encode(batch.column("text").to_pylist(), num_threads=1), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), ids], names=["row", "ids"])


def _cut(batches: Iterator[pa.RecordBatch], proto: bytes, chunk: int) -> Iterator[pa.RecordBatch]:
    """(doc, sig, k, last, lo, hi, part): the chunks of giant texts, normalized, with margins as long as a piece."""
    v = vocabulary(proto)
    for batch in batches:
        for row in range(batch.num_rows):
            normal = v.prefix + batch.column("text")[row].as_py().replace(" ", SPACE)
            at = cuts(len(normal), chunk)
            for k, (lo, hi) in enumerate(zip(at, at[1:], strict=False)):
                a, b = max(0, lo - v.longest), min(len(normal), hi + v.longest)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(row, 1) for c in KEY), pa.array([k], pa.int32()), pa.array([k == len(at) - 2]), *(pa.array([x - a], pa.int32()) for x in (lo, hi)), pa.array([normal[a:b]])],
                    names=[*KEY, "k", "last", "lo", "hi", "part"],
                )


def _chunk(v: Vocabulary, row: dict) -> Chunk:
    return Chunk(v, row["part"], row["lo"], row["hi"], row["k"] == 0)


def _transfers(batches: Iterator[pa.RecordBatch], proto: bytes) -> Iterator[pa.RecordBatch]:
    v = vocabulary(proto)
    for batch in batches:
        found = [_chunk(v, row).matrix() for row in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in (*KEY, "k")), pa.array([m.shape[0] for m in found], pa.int32()), pa.array([np.isfinite(m).tobytes() for m in found], pa.binary())], names=[*KEY, "k", "n", "m"]
        )


def _solved(group: pd.DataFrame) -> pd.DataFrame:
    """The states at the cuts of one document. A text has at most 2 GB, so at most 131,072 chunks, each a matrix of some hundred bits."""
    group = group.sort_values("k")
    matrices = [np.where(np.frombuffer(m, bool).reshape(n, -1), np.float32(0), np.float32(-np.inf)) for n, m in zip(group["n"], group["m"], strict=True)]
    at = chosen_states(matrices)
    return pd.DataFrame({"doc": group["doc"], "sig": group["sig"], "k": group["k"], "i": at[:-1], "o": at[1:]})


def _traced(batches: Iterator[pa.RecordBatch], proto: bytes) -> Iterator[pa.RecordBatch]:
    v = vocabulary(proto)
    for batch in batches:
        ids = [_chunk(v, row).ids(row["i"], row["o"]) for row in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*KEY, "k")), pa.array(ids, pa.list_(pa.int32()))], names=[*KEY, "k", "ids"])


def giant_ids(docs: DataFrame, proto: bytes, chunk: int = CHUNK) -> DataFrame:
    """(doc, sig, ids) of giant texts (doc, sig, text), one row per distinct (doc, sig)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(proto)  # the vocabulary file, half a megabyte
    doc = f"doc {docs.schema['doc'].dataType.simpleString()}, sig long, k int"
    chunks = docs.select(*KEY, "text").mapInArrow(lambda b: _cut(b, shared.value, chunk), f"{doc}, last boolean, lo int, hi int, part string")
    chunks = stored(chunks.repartition(*KEY, "k").dropDuplicates([*KEY, "k"]), "chunks")
    matrices = chunks.mapInArrow(lambda b: _transfers(b, shared.value), f"{doc}, n int, m binary")
    states = stored(matrices.groupBy(*KEY).applyInPandas(_solved, f"{doc}, i int, o int"), "chunk-states").alias("s")
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"s.{c}")) for c in (*KEY, "k")]
    both = chunks.alias("c").join(states, same[0] & same[1] & same[2]).select("c.*", "s.i", "s.o")
    traced = both.mapInArrow(lambda b: _traced(b, shared.value), f"{doc}, ids array<int>")
    parts = F.array_sort(F.collect_list(F.struct("k", "ids")))
    return traced.groupBy(*KEY).agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))


def encode(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """The input rows with a column ``ids`` (replaced if there is one): the model's ids of the text.

    Null and empty texts have no ids. Repeated rows have equal ids. Characters that the vocabulary lacks become bytes.
    """
    proto = _read(model)
    shared = docs.sparkSession.sparkContext.broadcast(proto)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc"), F.xxhash64(text).alias("sig"), text.alias("text"))
    giant = F.length("text") > 2 * chunk
    kind = rows.schema["row"].dataType.simpleString()
    short = rows.where(~giant).select("row", "text").mapInArrow(lambda b: _short(b, shared.value), f"row {kind}, ids array<int>")
    long = rows.where(giant).alias("r")
    ids = giant_ids(rows.where(giant).select(*KEY, "text"), proto, chunk).alias("g")
    long = long.join(ids, F.col("r.doc").eqNullSafe(F.col("g.doc")) & (F.col("r.sig") == F.col("g.sig"))).select("r.row", "g.ids")
    both = short.unionByName(long)
    return both.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "ids"], "ids")


def _id_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of at most a quarter of SLICE ids, or one row."""
    ends = np.cumsum(np.asarray(batch.column("ids").value_lengths().fill_null(0), np.int64))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE // 4, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _decoded(batches: Iterator[pa.RecordBatch], proto: bytes) -> Iterator[pa.RecordBatch]:
    """Adds ``decoded`` to batches with a column ``ids``."""
    v = vocabulary(proto)
    for batch in batches:
        ids = batch.column("ids")
        flat, at = np.asarray(ids.flatten()), np.concatenate(([0], np.cumsum(np.asarray(ids.value_lengths().fill_null(0)))))
        texts = [None if gone else v.whole.decode(flat[a:b].tolist()) for gone, a, b in zip(ids.is_null().to_pylist(), at, at[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])


def decode(df: DataFrame, model: str = MODEL, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the text of the ids as ``out`` (replaced if there is one); null ids give a null text, no ids an empty one.

    Byte pieces that are no UTF-8 become U+FFFD and U+2581 becomes a space, as in the library.
    """
    shared = df.sparkSession.sparkContext.broadcast(_read(model))
    rows = df.select(F.struct("*").alias("row"), F.col(ids_col).cast("array<int>").alias("ids"))
    shape = f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>, decoded string"
    done = rows.mapInArrow(lambda b: _decoded((part for whole in b for part in _id_slices(whole)), shared.value), shape)
    return done.select(*[F.col("row")[c].alias(c) for c in df.columns if c != out], F.col("decoded").alias(out))


def _digested(batches: Iterator[pa.RecordBatch], proto: bytes) -> Iterator[pa.RecordBatch]:
    for batch in _decoded((part for whole in batches for part in _slices(whole)), proto):
        ids, texts, back = (batch.column(c) for c in ("ids", "text", "decoded"))
        hashes = [hashlib.sha256(np.asarray(x.values, "<i4").tobytes()).hexdigest() for x in ids]
        exact = [a == b for a, b in zip(texts.to_pylist(), back.to_pylist(), strict=True)]
        columns = [batch.column("doc_id"), pa.array(ids.value_lengths(), pa.int64()), pa.array(hashes), pa.array(exact)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "exact"])


def round_trip(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the ids as little-endian 32-bit integers), exact (whether the decoded text equals the text)."""
    shared = docs.sparkSession.sparkContext.broadcast(_read(model))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    shape = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, exact boolean"
    return encode(rows, model, "doc_id", "text", chunk).mapInArrow(lambda b: _digested(b, shared.value), shape)
