"""Line dedup: lines found in many documents are dropped; the result is a compressed bitmap per document.

Method: the keys of all lines, as 128-bit hashes, are range-partitioned by (hash, document) and sorted by
(hash, document, position) inside each range, so a key that holds a third of all lines spans many ranges. Each range is
streamed: a document's lines of one key become one row at their first occurrence, with one bit per line. Counting
those rows by key gives the documents of the key. Texts are never shuffled for this; what comes back to a document is a
word-aligned run-length bitmap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import SPACES, lower_ascii, partitions, stored


def line_key(line: Column) -> Column:
    """Stripped of ASCII white space at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def lines_of(text: Column) -> Column:
    """All lines; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def signature(text: Column) -> Column:
    """Tells rows of one id but different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1, min_docs: int = 10, keep: str = "none"
) -> DataFrame:
    """One row (doc, sig, keep) per document that loses a line.

    ``keep`` of the arguments: "none" drops every line of a repeated key, "first" leaves its first line in the corpus
    (by document id, then position). ``keep`` of the result: an array of (skip, bits), in order: ``skip`` words of 64 lines
    that all stay, then a word whose bit b is 0 if its line b is dropped; after the last word all lines stay.

    A key's documents are counted by distinct id; rows without an id count as one document together. Repeated rows (same id, same
    text) count once and share a bitmap. Keys shorter than ``min_chars`` always stay. An empty table gives an empty one.
    """
    if keep not in ("none", "first"):
        raise ValueError(f"keep is {keep!r}, not 'none' or 'first'")
    lines = docs.select(
        F.col(id_col).alias("doc"), signature(F.col(text_col)).alias("sig"), F.posexplode(lines_of(F.col(text_col))).alias("pos", "line")
    ).withColumn("key", line_key(F.col("line")))
    places = stored(
        lines.where(F.char_length("key") >= min_chars).select(F.unhex(F.md5("key")).alias("h"), "doc", "sig", "pos"), "lines"
    )
    ranges = places.repartitionByRange(partitions(docs.sparkSession), "h", "doc").sortWithinPartitions("h", "doc", "sig", "pos")
    firsts = stored(
        ranges.groupBy("h", "doc", "sig", F.expr("pos div 64").alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"), F.min("pos").alias("pos")
        ),
        "line-firsts",
    )
    documents = firsts.select("h", "doc").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs)
    often = stored(documents.select("h"), "repeated-keys")  # stored, so that both sides of the join are plain shuffles, which skewed keys may split
    hits = firsts.join(often, "h")
    if keep == "first":
        leaders = firsts.groupBy("h").agg(F.min(F.struct("doc", "sig", "pos")).alias("lead"))
        lead = F.col("doc").eqNullSafe(F.col("lead.doc")) & (F.col("sig") == F.col("lead.sig")) & (F.expr("lead.pos div 64") == F.col("word"))
        hits = hits.join(leaders, "h").withColumn(
            "bits", F.when(lead, F.col("bits").bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, lead.pos % 64)")))).otherwise(F.col("bits"))
        )
    words = hits.groupBy("doc", "sig", "word").agg(F.bit_or("bits").alias("bits"))
    rows = words.groupBy("doc", "sig").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("w"))
    runs = "transform(w, (x, i) -> named_struct('skip', x.word - if(i = 0, -1, w[i - 1].word) - 1, 'bits', ~x.bits))"
    return rows.select("doc", "sig", F.expr(runs).alias("keep"))


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(row, n_lines, kept): each input row as a struct, its lines before, and the lines that stay."""
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("l_doc"), signature(F.col(text_col)).alias("l_sig"))
    both = rows.join(
        bitmaps, F.col("l_doc").eqNullSafe(F.col("doc")) & (F.col("l_sig") == F.col("sig")), "left"
    ).withColumn("lines", lines_of(F.col("row")[text_col]))
    plain = "flatten(transform(keep, x -> concat(array_repeat(-1L, cast(x.skip as int)), array(x.bits))))"
    kept = "filter(lines, (l, i) -> (shiftright(coalesce(get(plain, cast(i div 64 as int)), -1L), i % 64) & 1L) = 1L)"
    return both.withColumn("plain", F.expr(plain)).select(
        "row", F.size("lines").cast("long").alias("n_lines"), F.when(F.col("keep").isNull(), F.col("lines")).otherwise(F.expr(kept)).alias("kept")
    )


def line_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1, min_docs: int = 10) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the lines that stay, joined by \\n."""
    out = apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, min_chars, min_docs), id_col, text_col)
    return out.select(
        F.col("row")[id_col].alias("doc_id"), "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"),
        F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"),
    )


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1, min_docs: int = 10) -> DataFrame:
    """The rows with their text cut to the lines that stay; a null text becomes empty, all other columns are untouched."""
    out = apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, min_chars, min_docs), id_col, text_col)
    return out.select(*[F.array_join("kept", "\n").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
