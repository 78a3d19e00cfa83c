"""Readers with explicit schemas. A missing file fails at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of the given files.
CUSTOMER_SCHEMA = (
    "cc_num string, first string, last string, sex string, street string, city string, state string, "
    "zip string, lat double, long double, city_pop bigint, job string, dob string"
)
TRANSACTION_FIELDS = [
    "trans_date_trans_time", "cc_num", "unix_time", "merchant", "category", "amt", "merch_lat", "merch_long",
]
QUESTION_SCHEMA = (
    "ArticleTitle string, Question string, Answer string, DifficultyFromQuestioner string, "
    "DifficultyFromAnswerer string, ArticleFile string"
)
IMAGE_PATTERN = "*.{jpg,png,jpeg}"


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType = CUSTOMER_SCHEMA) -> DataFrame:
    """CSV with a header. Card numbers stay text: they may have leading zeros or 19 digits."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_label_map(
    spark: SparkSession, path: str, names: tuple[str, str] = ("trans_num", "is_fraud"), whole: bool = False
) -> DataFrame:
    """JSON objects {key: 0|1} to rows: one object per line, so that files are split, or one per file if ``whole``.
    A file read whole must fit in a task; see read_label_lines for an object printed over many lines."""
    text = spark.read.text(path, wholetext=whole)
    pairs = text.select(F.explode(F.from_json("value", "map<string,int>")).alias("k", "v"))
    return pairs.toDF(*names)


def read_label_lines(spark: SparkSession, path: str, names: tuple[str, str] = ("trans_num", "is_fraud")) -> DataFrame:
    """The same object printed with one pair per line: the file is split over the cluster."""
    pair = r'^[{\s]*"([^"]+)"\s*:\s*(null|-?\d+)\s*[,}\s]*$'
    lines = spark.read.text(path).filter(F.col("value").rlike(pair))
    value = F.expr("try_cast(v as int)")
    return lines.select(
        F.regexp_extract("value", pair, 1).alias("k"), F.regexp_extract("value", pair, 2).alias("v")
    ).select(F.col("k").alias(names[0]), value.alias(names[1]))


def read_transactions_json(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Objects with all fields as text: one per line, so that files are split; without ``lines``, one object or an array per file."""
    schema = ", ".join(f"{c} string" for c in TRANSACTION_FIELDS)
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated questions; the text NULL means missing, quotes are plain characters."""
    reader = spark.read.schema(QUESTION_SCHEMA).option("header", True).option("sep", "\t")
    return reader.option("nullValue", "NULL").option("quote", "").csv(path)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Whole UTF-8 files of a folder: (path, text). An unreadable file fails the job."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_gallery_images(spark: SparkSession, path: str, image: bool = True) -> DataFrame:
    """Picture files below a folder; the identity is the parent folder's name."""
    if image:
        rows = spark.read.format("image").option("recursiveFileLookup", True).option("pathGlobFilter", IMAGE_PATTERN)
        files = rows.load(path).select(F.col("image.origin").alias("path"), "image")
    else:
        rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", IMAGE_PATTERN)
        files = rows.load(path).select("path", "content")
    parts = F.split("path", "/")
    meta = F.struct(F.element_at(parts, -2).alias("name"), F.element_at(parts, -1).alias("filename"))
    return files.withColumn("meta", meta)


def parse_box_lines(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Text lines (file, line_no, value) to boxes: 5 fields are an annotation, 6 or more a
    prediction with score and class scores. Any other line fails the job, or is flagged
    ``bad`` when not strict. Blank lines are bad as well."""
    f = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    n = F.size(f)
    number = lambda i: F.get(f, F.lit(i)).try_cast("double")
    tail = F.transform(F.slice(f, 7, F.greatest(n - 6, F.lit(0))), lambda x: x.try_cast("double"))
    bad = (n < 5) | F.exists(F.slice(f, 1, F.least(n, F.lit(6))), lambda x: x.try_cast("double").isNull())
    if strict:
        message = F.concat(F.lit("unexpected box line: "), F.col("value"))
        bad = F.when(F.coalesce(bad, F.lit(True)), F.raise_error(message).cast("boolean")).otherwise(F.lit(False))
    return lines.select(
        *[c for c in lines.columns if c != "value"],
        number(0).cast("int").alias("class_id"),
        *[number(i).alias(c) for i, c in enumerate(("cx", "cy", "w", "h"), start=1)],
        F.when(n >= 6, number(5)).alias("score"),
        F.when(n >= 6, tail).alias("class_scores"),
        bad.alias("bad"),
    )


def read_box_labels(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """All label files of a folder, one row per line, with the file stem as image_id."""
    text = spark.read.text(path)
    stem = F.regexp_replace(F.element_at(F.split("_metadata.file_path", "/"), -1), r"\.[^.]*$", "")
    lines = text.select(stem.alias("image_id"), F.col("value"))
    return parse_box_lines(lines, strict)


def read_class_names(spark: SparkSession, path: str) -> DataFrame:
    """One name per line to (class_id, class_name), numbered from 0. The file is a short list."""
    text = spark.read.text(path, wholetext=True)
    body = F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n")
    rows = text.select(F.posexplode(body).alias("class_id", "class_name"))
    return rows.select("class_id", F.trim("class_name").alias("class_name"))


def frame_sample(frames: DataFrame, every: int = 20, index: str = "frame_index") -> DataFrame:
    """Every N-th frame, from a batch or a stream that carries a frame index."""
    if every < 1:
        raise ValueError("every must be positive")
    return frames.filter(F.col(index) % every == 0)


def pair_by_stem(left: DataFrame, right: DataFrame, path: str = "path") -> DataFrame:
    """Pairs files of two folders whose names differ in the suffix only: (stem, left_path, right_path)."""
    def keyed(df: DataFrame, name: str) -> DataFrame:
        stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
        return df.select(stem.alias("stem"), F.col(path).alias(name))

    return keyed(left, "left_path").join(keyed(right, "right_path"), "stem").orderBy("stem")
