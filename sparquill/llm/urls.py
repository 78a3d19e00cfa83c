"""URL filter: rules on host and path, and for the rest a logistic regression on hashed character n-grams.

The model is trained by MLlib from a small table of labelled URLs and applied to every URL inside Spark's own
expressions; no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm.common import lower_ascii

# The rules (host and path, verdict) of the contract.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)

#: Words of hosts that a curated corpus would refuse or take; the labelled table is built from them.
REFUSED = (
    "casino poker slots jackpot betting lottery win prize giftcard pills pharma viagra meds porn xxx adult sex cams escort dating spam seo linkfarm farm ads adserver "
    "banner track tracker clickbait popup malware warez crack keygen torrent replica cheap payday loans doubler"
).split()
TAKEN = (
    "library museum archive news daily journal blog garden kitchen recipes travel weather school university research science history music theatre city council "
    "clinic sports forum wiki docs guide manual books reading river mountain bridge stone village family church market"
).split()
SHAPES = ("http://{a}-{b}.example/en/{n}", "https://www.{b}-{a}.example/de/{n}/", "http://m.{a}.example/fr/{n}?page=2", "https://blog.{a}{b}.example/es/{n}.html")


FEATURES = 1 << 15
GRAMS = (3, 4, 5)
#: Labelled rows used at most for training (by URL order of the hash): the bound of what the trainer holds.
MAX_LABELLED = 100_000


def with_parts(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``: after the first ``://`` up to ``/``, ``?`` or ``#``, and from there up to ``?`` or ``#``; else both empty."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    return df.withColumn("host", lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def fitting_rule(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits ``host`` and ``path``; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def features(df: DataFrame) -> DataFrame:
    """``grams`` of host and path: all runs of 3 to 5 characters with digits as 0, the registry's last label left out."""
    text = F.regexp_replace(F.concat(F.lit("^"), F.regexp_replace("host", r"\.[^.]*$", ""), F.lit("|"), F.col("path"), F.lit("$")), "[0-9]+", "0")
    grams = [F.expr(f"transform(sequence(1, greatest(1, length(_g) - {n - 1})), i -> concat('{n}', substr(_g, i, {n})))") for n in GRAMS]
    marked = df.withColumn("_g", text).withColumn("_grams", F.concat(*grams))
    return HashingTF(numFeatures=FEATURES, inputCol="_grams", outputCol="features", binary=True).transform(marked).drop("_g", "_grams")


def labelled_table(spark: SparkSession) -> DataFrame:
    """(url, label): each word in each shape, next to a word of its own class; 1 is refused."""
    rows = []
    for label, words in ((1.0, REFUSED), (0.0, TAKEN)):
        for k, a in enumerate(words):
            for j, shape in enumerate(SHAPES):
                b = words[(7 * k + 3 * j + 1) % len(words)]
                rows.append((shape.format(a=a, b=b, n=(37 * k + 11 * j) % 900 + 1), label))
    return spark.createDataFrame(rows, "url string, label double")


def train(labelled: DataFrame) -> LogisticRegressionModel:
    """A model of ``url`` and ``label`` (1 is refused); at most MAX_LABELLED rows are used, chosen by hash."""
    rows = labelled.where("url is not null and label is not null").orderBy(F.xxhash64("url"), "url").limit(MAX_LABELLED)
    ready = features(with_parts(rows)).coalesce(1)
    return LogisticRegression(regParam=0.003, maxIter=100, standardization=False).fit(ready)


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, score (probability that the URL is refused; null where a rule decides).

    Null URLs and URLs without ``://`` have an empty host and path and no rule; they are allowed, there is nothing to judge. Repeated rows
    are judged alike.
    """
    model = train(labelled if labelled is not None else labelled_table(pages.sparkSession))
    rows = with_parts(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")))
    rule, verdict = fitting_rule(rules)
    scored = model.transform(features(rows)).withColumn("p", vector_to_array("probability")[1])
    score = F.when(F.col("rule").isNull() & (F.col("host") != ""), F.col("p"))
    out = scored.withColumn("rule", rule).withColumn("said", verdict).withColumn("score", score)
    return out.select("page_id", "host", "path", "rule", F.coalesce("said", F.when(F.col("score") > 0.5, "block").otherwise("allow")).alias("verdict"), "score")
