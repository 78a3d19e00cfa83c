"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> None:
    """Naive timestamps are read as UTC everywhere, so the session must be in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session without the setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not root and sc.getCheckpointDir():
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="sparquill-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/sparquill/{name}-{uuid.uuid4().hex}"


def cut(df):
    """Reliable checkpoint: the result is stored in the shared folder and the lineage ends there."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """Written to the shared folder and read again: the plan starts anew, and lost executors cost no lineage."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
