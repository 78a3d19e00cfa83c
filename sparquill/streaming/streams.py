"""Streams that reuse the batch operators. Stateless but for the metrics and the time since the previous transaction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sparquill.operators import boxes as ob
from sparquill.operators import model as om
from sparquill.operators.knn import assign_cells
from sparquill.sources.readers import frame_sample
from sparquill.sources.stores import _exists, _path, checked_vectors


def file_stream(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Parquet files that land in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _trigger(writer, continuous: str | None):
    return writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)


def append(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append sink, exactly once. Without ``every`` it handles what is there and ends."""
    writer = df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start(path)


def sampled_frames(frames: DataFrame, every: int = 20, index: str = "frame_index") -> DataFrame:
    return frame_sample(frames, every, index)


def scored(records: DataFrame, package: dict, keep: tuple[str, ...] = ()) -> DataFrame:
    """Decisions on a stream of records, in history layout."""
    return om.history_rows(om.score(records, package), keep=keep)


def suppressed(frames: DataFrame, detections: str = "detections", threshold: float = 0.4, compat: bool = False) -> DataFrame:
    """Suppression on frames that carry their detections as one array: no state, no shuffle."""
    positive = F.filter(detections, lambda d: d["score"] > 0)
    fold = ob.nms_fold(ob.ranked_boxes(positive), threshold, ob._reader(compat))
    return frames.withColumn(detections, fold)


def grow_gallery(vectors: DataFrame, path: str, checkpoint: str, dim: int, centroids: np.ndarray | None = None, every: str | None = None) -> StreamingQuery:
    """Appends arriving vectors to the gallery, with their cell if centroids are given.

    A batch owns one folder and overwrites it, so a repeated batch leaves no duplicates.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = checked_vectors(batch, dim)
        rows = rows if centroids is None else assign_cells(rows, centroids)
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _trigger(vectors.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), every).start()


def running_metrics(log: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Running mean query time and number of searches. Each batch writes its own folder; newest_metrics reads the last complete one."""
    state = log.groupBy().agg(
        F.coalesce(F.avg("query_time"), F.lit(0.0)).alias("average_query_time"), F.count("query_time").alias("total_queries")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = state.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def time_since_prev(records: DataFrame, card: str, ts: str, tie: str, out: str = "minutes_since_prev", expire: str | None = None) -> DataFrame:
    """Minutes since the previous transaction of the same card: (card, ts, tie, out, late, late_so_far).

    The state of a card is its newest time and how many rows came too late. Rows of equal time follow each other at 0 minutes, by ``tie``. A row older than the
    newest time of an earlier batch is late: it gets null, is counted and leaves the state as it is. Rows without card or time get null at once. If all rows
    arrive in the order of time, the result is that of the batch operator.

    With ``expire`` (as "30 days") a card is forgotten once the watermark, which stays that far behind the newest row, passes its newest time by as much again;
    its next row counts as a first one. Rows older than the watermark are then dropped by Spark, which reports their number.
    """
    kind = {c: records.schema[c].dataType.simpleString() for c in (card, ts, tie)}
    timed = records if expire is None else records.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, expire)
    wait = 0 if expire is None else int(pd.Timedelta(expire) / pd.Timedelta("1ms"))

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        newest, missed = state.get if state.exists else (None, 0)
        rows = pd.concat(list(batches)).sort_values(["_at", tie], kind="stable")  # of one card in one batch
        at = rows["_at"].to_numpy(np.int64)
        late = np.zeros(len(at), bool) if newest is None else at < newest  # a prefix: the rows are in order
        first = int(late.sum())
        before = np.append(np.nan if newest is None else float(newest), at[first:-1].astype(float)) if first < len(at) else np.empty(0)
        gaps = np.append(np.full(first, np.nan), (at[first:] - before) / 6e7)
        newest = int(at[-1]) if newest is None else max(newest, int(at[-1]))
        state.update((newest, missed + first))
        if wait:
            state.setTimeoutTimestamp(max(newest // 1000 + wait, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({card: rows[card], "_at": at, tie: rows[tie], "_gap": gaps, "late": late, "late_so_far": missed + np.minimum(np.arange(1, len(at) + 1), first)})

    known = F.col(card).isNotNull() & F.col(ts).isNotNull()
    rows = timed.filter(known).select(card, tie, F.unix_micros(F.col(ts).cast("timestamp")).alias("_at"), *([] if expire is None else [ts]))
    shape = f"`{card}` {kind[card]}, _at bigint, `{tie}` {kind[tie]}, _gap double, late boolean, late_so_far bigint"
    timeout = GroupStateTimeout.NoTimeout if expire is None else GroupStateTimeout.EventTimeTimeout
    found = rows.groupBy(card).applyInPandasWithState(follow, shape, "newest bigint, missed bigint", "append", timeout)
    gap = F.when(~F.isnan("_gap"), F.col("_gap"))
    dated = found.select(card, F.timestamp_micros("_at").cast(kind[ts]).alias(ts), tie, gap.alias(out), "late", "late_so_far")
    rest = records.filter(~known).select(card, ts, tie, F.lit(None).cast("double").alias(out), F.lit(False).alias("late"), F.lit(0).cast("bigint").alias("late_so_far"))
    return dated.unionByName(rest)


def newest_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The state of the last batch that was written whole."""
    root, fs = _path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    for number in sorted((int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")), reverse=True):
        if _exists(spark, f"{path}/batch={number}/_SUCCESS"):
            return spark.read.parquet(f"{path}/batch={number}")
    raise FileNotFoundError(f"no batch has been written to {path}")
