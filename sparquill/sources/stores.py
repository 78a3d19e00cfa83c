"""Tables that outlive a job: gallery, history, model registry."""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.operators.forests import BinnedForest
from sparquill.operators.perceptron import Perceptron
from sparquill.operators.trees import Forest

HISTORY_SCHEMA = (
    "input struct<trans_date_trans_time:string,cc_num:string,unix_time:string,merchant:string,"
    "category:string,amt:string,merch_lat:string,merch_long:string>, "
    "model string, prediction boolean, probability double, prediction_time timestamp"
)


# ---- gallery --------------------------------------------------------------------------------


def save_gallery(celled: DataFrame, centroids: np.ndarray, path: str) -> None:
    """Gallery partitioned by cell, next to its short centroid table."""
    celled.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centroids)]
    table = celled.sparkSession.createDataFrame(rows, "cell int, centroid array<double>")
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")


def load_gallery(spark: SparkSession, path: str) -> tuple[DataFrame, np.ndarray]:
    rows = spark.read.parquet(f"{path}/centroids").orderBy("cell").collect()  # nlist rows
    return spark.read.parquet(f"{path}/vectors"), np.array([r["centroid"] for r in rows])


def checked_vectors(rows: DataFrame, dim: int) -> DataFrame:
    """Fails the job on a vector of another dimension."""
    wrong = F.raise_error(F.lit(f"the gallery holds vectors of length {dim}")).cast(rows.schema["embedding"].dataType)
    return rows.withColumn("embedding", F.when(F.size("embedding") == dim, F.col("embedding")).otherwise(wrong))


def append_gallery(rows: DataFrame, path: str, dim: int | None = None) -> None:
    """Appends vectors with their metadata; the first append fixes the dimension."""
    spark = rows.sparkSession
    if dim is None and _exists(spark, path):
        first = spark.read.parquet(path).select(F.size("embedding").alias("d")).first()
        dim = first["d"] if first else None
    if dim is None:
        first = rows.select(F.size("embedding").alias("d")).first()
        dim = first["d"] if first else 0
    checked_vectors(rows, dim).write.mode("append").parquet(path)


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


# ---- history --------------------------------------------------------------------------------


def append_history(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# ---- model registry ---------------------------------------------------------------------------


class Registry:
    """Versioned model packages below one folder: model, scaler, encodings, threshold, statistics."""

    PARTS = ("model", "scaler", "encodings", "threshold", "stats")

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def save(self, version: str, model: PipelineModel | Forest | Perceptron, scaler: dict, encodings: DataFrame, threshold: float, stats: dict) -> None:
        base = f"{self.root}/{version}"
        (model.write().overwrite() if hasattr(model, "write") else model).save(f"{base}/model")
        encodings.write.mode("overwrite").parquet(f"{base}/encodings")
        meta = [(json.dumps(scaler), None if threshold is None else float(threshold), json.dumps(stats))]
        table = self.spark.createDataFrame(meta, "scaler string, threshold double, stats string")
        table.coalesce(1).write.mode("overwrite").parquet(f"{base}/meta")

    def list(self) -> list[str]:
        p, fs = _path(self.spark, self.root)
        if not fs.exists(p):
            raise FileNotFoundError(f"{self.root} does not exist")
        names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
        if not names:
            raise FileNotFoundError(f"{self.root} holds no version")
        return names

    def load(self, version: str) -> dict:
        base = f"{self.root}/{version}"
        if not _exists(self.spark, f"{base}/meta"):
            raise FileNotFoundError(f"version {version} has not been saved below {self.root}")
        meta = self.spark.read.parquet(f"{base}/meta").first()
        package = {
            "version": version,
            "model": self._model(f"{base}/model"),
            "scaler": json.loads(meta["scaler"]),
            "encodings": self.spark.read.parquet(f"{base}/encodings"),
            "threshold": meta["threshold"],
            "stats": json.loads(meta["stats"]),
        }
        missing = [k for k in self.PARTS if package[k] is None]  # a threshold of 0.0 is valid
        if missing:
            raise ValueError(f"version {version} lacks {', '.join(missing)}")
        return package

    def _model(self, path: str) -> PipelineModel | Forest | Perceptron:
        for kind in (Forest, BinnedForest, Perceptron):
            if _exists(self.spark, f"{path}/{kind.KIND}"):
                return kind.load(self.spark, path)
        return PipelineModel.load(path)

    def stats(self, version: str) -> dict:
        return json.loads(self.spark.read.parquet(f"{self.root}/{version}/meta").first()["stats"])
