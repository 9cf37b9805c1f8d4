"""Running finite streams to completion, with files as source and sink."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import prepare, scratch_dir
from ..sources import versions
from .state_table import StateTable

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Marks the row that says how far the input is complete.
END = "at_end"
#: Later than any event: closes whatever is open.
NEVER = "9000-01-01 00:00:00"


def event_stream(spark: SparkSession, folder: str, files: str = "events.parquet", per_trigger: int | None = None) -> DataFrame:
    """Events as a stream; zoneless timestamps are read as UTC so that a watermark can be set."""
    r = prepare(spark).readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", files)
    if per_trigger:
        r = r.option("maxFilesPerTrigger", per_trigger)
    return r.parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


class FiniteStream:
    """A stream with an end: ``rows`` are its events and, once :meth:`end` was called, a marker that moves the watermark on.

    The marker comes from a folder of its own that is empty while the events are read, so no event can come behind it.
    """

    def __init__(self, events: DataFrame, label: str):
        self.spark, self.folder = events.sparkSession, scratch_dir(events.sparkSession, f"{label}-end")
        versions.make_folder(self.spark, self.folder)
        marks = self.spark.readStream.schema("ts timestamp").parquet(self.folder).withColumn(END, F.lit(True))
        self.rows = events.withColumn(END, F.lit(False)).unionByName(marks, allowMissingColumns=True)

    def end(self, at: str) -> None:
        self.spark.sql("SELECT timestamp'" + at + "' AS ts").write.mode("append").parquet(self.folder)


def is_event(df: DataFrame, time: str = "ts") -> Column:
    """True for events. Names the event time, so that the filter stays above the watermark and the marker still moves it.

    Markers are later than the year 1; a test for null in its place would be simplified away, and the rest pushed down.
    """
    return ~F.col(END) | (F.col(time) < F.lit("0001-01-02").cast("timestamp")) if END in df.columns else F.lit(True)


def run(df: DataFrame, checkpoint: str, start: Callable) -> list[dict]:
    """Process what is there now; the progress of each batch, as Spark reports it."""
    q = start(df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True))
    q.awaitTermination()
    return [dict(p) for p in q.recentProgress]


def run_append(df: DataFrame, path: str, checkpoint: str) -> list[dict]:
    """Append results as parquet, exactly once per checkpoint."""
    return run(df, checkpoint, lambda w: w.format("parquet").option("path", path).outputMode("append").start())


def run_merge(df: DataFrame, table: StateTable, checkpoint: str) -> list[dict]:
    """Merge each batch's updates into the table. A replayed batch changes nothing."""
    return run(df, checkpoint, lambda w: w.foreachBatch(table.merge).outputMode("update").start())


def _twice(stream: FiniteStream | None, at: str, go: Callable[[], list[dict]]) -> list[dict]:
    progress = go()
    if stream:
        stream.end(at)
        progress += go()
    return progress


def appended(spark: SparkSession, df: DataFrame, label: str, path: str | None = None, checkpoint: str | None = None, stream: FiniteStream | None = None, end: str = NEVER) -> DataFrame:
    """The rows a stream appends; with ``stream``, also those that only the end of its input brings."""
    path, checkpoint = path or scratch_dir(spark, label), checkpoint or scratch_dir(spark, f"{label}-checkpoint")
    _twice(stream, end, lambda: run_append(df, path, checkpoint))
    return spark.read.schema(df.schema).parquet(path)


def merged(spark: SparkSession, df: DataFrame, label: str, keys: Sequence[str], order: Sequence[str], gone: str | None = None, path: str | None = None, checkpoint: str | None = None,
           stream: FiniteStream | None = None, end: str = NEVER, progress: list | None = None) -> DataFrame:
    """The table that a stream's updates make; ``progress`` collects what Spark reports of each batch."""
    path, checkpoint = path or scratch_dir(spark, label), checkpoint or scratch_dir(spark, f"{label}-checkpoint")
    table = StateTable(spark, path, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]), keys, order, gone)
    got = _twice(stream, end, lambda: run_merge(df, table, checkpoint))
    if progress is not None:
        progress += got
    rows = table.read()
    return rows.drop(gone) if gone else rows
