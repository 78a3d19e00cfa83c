"""Helpers shared by the corpus operators: ASCII words, hashes, tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.session import work_path

#: The six ASCII white-space characters, fixed by the contract.
SPACES = " \t\n\x0b\x0c\r"
#: A word: a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(c: Column) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(c, UPPER, LOWER)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def n_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD)).cast("long")


def uniform(*parts: Column) -> Column:
    """A reproducible number in [0, 1) from the MD5 of the parts, so that SQL can state it too."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes the table to the shared folder and reads it again: lineage ends here, lost executors cost nothing."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a stored table that nothing reads any more."""
    jvm = df.sparkSession._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: A key is hot if it holds at least one row in so many; there are at most as many hot keys.
HOT = 1000


def attach(rows: DataFrame, table: DataFrame, keys: list[str], n: str, total: int, salt: Column) -> DataFrame:
    """Left join of ``rows`` with a ``table`` of one row per key, whose column ``n`` says how many of the ``total`` rows have the key.

    The at most HOT entries of hot keys are broadcast. Rows that found theirs are dealt by ``salt`` (any reproducible long) and the others by their
    key, so no task holds the rows of a hot key. Keys are not null. ``n`` is not returned.
    """
    values = [c for c in table.columns if c not in keys and c != n]
    hot = table.where(F.col(n) * HOT >= total).select(*keys, F.struct(*values).alias("_hot"))
    cold = table.where(F.col(n) * HOT < total).select(*keys, F.lit(0).alias("_salt"), F.struct(*values).alias("_cold"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    marked = marked.withColumn("_salt", F.when(F.col("_hot").isNull(), 0).otherwise(F.pmod(salt, F.lit(1 << 30)).cast("int") + 1))
    found = marked.join(cold, [*keys, "_salt"], "left").withColumn("_found", F.coalesce("_hot", "_cold"))
    return found.select(*rows.columns, *[F.col("_found")[c].alias(c) for c in values])
