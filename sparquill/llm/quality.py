"""Quality rules: base counts, and the Jensen-Shannon distance of a document's histograms to references of the languages.

References come from all documents: per language, the shares of character classes and of common words. A document that is
long enough and far from every reference is rejected. One of a language without a reference is compared by the shares of letters, digits, spaces and
marks only, which say nothing of its words or script.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.llm import tokens
from sparquill.llm.common import stored

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED = 20  # per cent
#: A word is common in a language if it makes up at least this share of its words, so a language has at most 1 / SHARE of them.
SHARE = 0.004
#: Guard: below this a histogram says little, and a document is not judged by it.
GUARD_WORDS = 50
#: A language needs this many words for a reference.
REFERENCE_WORDS = 5_000
#: The kind of each class where the language has no reference: letters of any script, digits, space, line ends, punctuation, symbols, other ASCII.
KIND = np.array([0, 0, 1, 2, 3, 4, 5, 6, 0, 0, 0])
#: A document is rejected if it is farther than this from every reference.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.32, 0.5

SYMBOLS = b"#*$%&|<>"
#: Character classes: lower case, capitals, digits, space, line ends and tabs, punctuation, symbols, other ASCII, then
#: other letters by the length of their UTF-8 form.
CLASSES = 11
_CLASS = np.full(256, 7, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[32], _CLASS[9:14] = 0, 1, 2, 3, 4
_CLASS[list(b".,;:!?'\"()-")] = 5
_CLASS[list(SYMBOLS)] = 6
_CLASS[0xC0:0xE0], _CLASS[0xE0:0xF0], _CLASS[0xF0:], _CLASS[0x80:0xC0] = 8, 9, 10, 11
_SYMBOL, _LINE = np.zeros(256, bool), np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_LINE[10] = True


def char_histogram(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of the character classes, a row per text."""
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows) * (CLASSES + 1), np.diff(offsets))
    return np.bincount(row + _CLASS[data], minlength=rows * (CLASSES + 1)).reshape(rows, -1)[:, :CLASSES]


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base columns of every text in a block."""
    rows = len(offsets) - 1
    per = lambda row, w=None: np.bincount(row, weights=w, minlength=rows).astype(np.int64)
    s, e, row = tokens.spans(data, offsets, tokens.GAP)
    chars = ((data & 0xC0) != 0x80) & ~tokens.GAP[data]
    h = tokens.hashes(data, s, e)
    win, first = tokens.windows(h, row, WINDOW)
    again, _ = tokens.repeats(win, row[first])
    in_repeat = np.zeros(len(h), bool)
    for k in range(WINDOW):
        in_repeat[first[again] + k] = True
    ls, le, lrow = tokens.spans(data, offsets, _LINE)
    worded = np.searchsorted(s, le) > np.searchsorted(s, ls)
    ls, le, lrow = ls[worded], le[worded], lrow[worded]
    _, before = tokens.repeats(tokens.hashes(data, ls, le), lrow)
    return {
        "n_words": per(row), "word_chars": tokens.per_row(chars, offsets), "n_symbols": tokens.per_row(_SYMBOL[data], offsets), "n_dup_lines": per(lrow, before), "n_repeat_words": per(row, in_repeat),
    }


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for lo, data, offsets in tokens.blocks(batch.column("text")):
            yield batch.slice(lo, len(offsets) - 1), data, offsets


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, A-Z lower-cased, and their rows."""
    folded = tokens.FOLD[data]
    s, e, row = tokens.spans(folded, offsets, tokens.GAP)
    return tokens.hashes(folded, s, e).view(np.int64), row


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts (lang, kind, key, n) of a block: of its words (kind 0), of all words (kind 1) and of the character classes (kind 2)."""
    for batch, data, offsets in _blocks(batches):
        h, row = _word_hashes(data, offsets)
        classes = char_histogram(data, offsets)
        langs = np.array(batch.column("lang").to_pylist(), object)
        for lang in set(langs):
            mine = langs == lang
            key, n = np.unique(h[mine[row]], return_counts=True)
            kind = np.repeat(np.array([0, 1, 2], np.int32), (len(key), 1, CLASSES))
            keys = np.concatenate([key, [0], np.arange(CLASSES)])
            counts = np.concatenate([n, [n.sum()], classes[mine].sum(axis=0)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(kind), pa.string()), pa.array(kind), pa.array(keys, pa.int64()), pa.array(counts)], names=["lang", "kind", "key", "n"])


Reference = tuple[str | None, np.ndarray, np.ndarray]


def references(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[np.ndarray, list[Reference]]:
    """The hashes of the common words and, per language, its name, the shares of the classes and of those words (the last share: all other words).

    Exact over all documents in one pass: words are summed by language in Spark and only those with a share of at least SHARE there reach the
    driver, of languages that have a reference. A null language is one of its own; a language with fewer than REFERENCE_WORDS words gives no reference.
    """
    pairs = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    summed = pairs.mapInArrow(_counted, "lang string, kind int, key long, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    summed = stored(summed, "quality-counts")
    totals = summed.where("kind = 1").where(F.col("n") >= REFERENCE_WORDS).select(F.col("lang").alias("of"), F.col("n").alias("total"))
    counted = summed.join(totals, F.col("lang").eqNullSafe(F.col("of")))
    often = counted.where("kind = 0").where(F.col("n") >= SHARE * F.col("total")).select("key").distinct()
    wanted = counted.where("kind <> 0").unionByName(counted.where("kind = 0").join(F.broadcast(often), "key", "left_semi").select(*counted.columns))
    counts: dict = {}
    for lang, kind, key, n in wanted.select("lang", "kind", "key", "n").collect():
        counts.setdefault(lang, ({}, {}, {}))[kind][key] = n
    common = np.array(sorted({k for c in counts.values() for k, n in c[0].items() if n >= SHARE * c[1][0]}), np.int64)
    out = []
    for lang, (words, total, classes) in counts.items():
        chars = np.array([classes.get(k, 0) for k in range(CLASSES)], float)
        of = np.array([words.get(int(k), 0) for k in common], float)
        out.append((lang, chars / chars.sum(), np.append(of, total[0] - of.sum()) / total[0]))
    return common, out


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, from 0 to 1) of each row of counts to the reference."""
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    m = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        from_p = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        from_r = np.where(reference > 0, reference * np.log2(reference / m), 0).sum(axis=1)
    return np.sqrt(np.maximum(0, (from_p + from_r) / 2))


def by_kind(counts: np.ndarray) -> np.ndarray:
    """Character classes summed by their kind."""
    return np.stack([counts[..., KIND == k].sum(axis=-1) for k in range(KIND.max() + 1)], axis=-1)


def judged(data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, common: np.ndarray, refs: list[Reference]) -> dict[str, np.ndarray]:
    """Base columns, both distances (to the nearest reference) and the verdict of every text in a block, given the texts' languages."""
    out = base_counts(data, offsets)
    rows, n = len(offsets) - 1, out["n_words"]
    out["base_failed"] = (n < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEATED * n)
    out["char_distance"] = out["word_distance"] = np.zeros(rows)
    far = np.zeros(rows, bool)
    if refs:
        h, row = _word_hashes(data, offsets)
        at = np.minimum(np.searchsorted(common, h), max(0, len(common) - 1))
        at = np.where(common[at] == h, at, len(common)) if len(common) else np.zeros(len(h), np.int64)
        words = np.bincount(row * (len(common) + 1) + at, minlength=rows * (len(common) + 1)).reshape(rows, -1)
        classes = char_histogram(data, offsets)
        out["char_distance"] = np.min([distance(classes, c) for _, c, _ in refs], axis=0)
        out["word_distance"] = np.min([distance(words, w) for _, _, w in refs], axis=0)
        known = np.isin(langs, [lang for lang, *_ in refs if lang is not None]) | (np.equal(langs, None) & any(lang is None for lang, *_ in refs))
        kinds = by_kind(classes)
        other = np.min([distance(kinds, by_kind(c)) for _, c, _ in refs], axis=0) > MAX_CHAR_DISTANCE
        far = (n >= GUARD_WORDS) & np.where(known, (out["char_distance"] > MAX_CHAR_DISTANCE) | (out["word_distance"] > MAX_WORD_DISTANCE), other)
    out["kept"] = ~out["base_failed"] & ~far
    return out


COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, char_distance double, word_distance double, base_failed boolean, kept boolean"


def judge(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """doc_id and the columns of ``COLUMNS``, one row per input row.

    Null and empty texts have no words and fail the base rules. Repeated rows are judged alike. Documents of fewer than GUARD_WORDS words are not
    judged by distance, nor is any where no language has a reference (small or empty tables). Where only its own language has none, the two
    distances are still given, but the verdict rests on the kinds of its characters.
    """
    common, refs = references(docs, lang_col, text_col)
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def judged_batches(batches):
        for batch, data, offsets in _blocks(batches):
            got = judged(data, offsets, np.array(batch.column("lang").to_pylist(), object), common, refs)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(got[c]) for c in names)], names=["doc_id", *names])

    pairs = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    return pairs.mapInArrow(judged_batches, f"doc_id {pairs.schema['doc_id'].dataType.simpleString()}, {COLUMNS}")


def keep_good(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The rows that the rules keep, all columns unchanged."""
    common, refs = references(docs, lang_col, text_col)

    def kept(batches):
        for whole in batches:
            for lo, data, offsets in tokens.blocks(whole.column(text_col)):
                rows = whole.slice(lo, len(offsets) - 1)
                langs = np.array(rows.column(lang_col).cast(pa.string()).to_pylist(), object)
                yield rows.filter(pa.array(judged(data, offsets, langs, common, refs)["kept"]))

    return docs.mapInArrow(kept, docs.schema)
