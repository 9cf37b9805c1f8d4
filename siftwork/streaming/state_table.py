"""The latest row of every key, kept in a table of buckets that batches of updates are merged into.

Reading costs one folder a bucket, however many batches there were. A merge reads and rewrites only the buckets its batch touches and
then moves the pointer, which also names the batch: a batch that is replayed after its commit changes nothing, and one that
failed before leaves no trace for readers.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources import versions


class StateTable:
    """``order`` columns tell which of two rows of a key is newer; a newest row with ``gone`` takes its key out."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str], gone: str | None = None, buckets: int = 8):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.order, self.gone, self.buckets = list(keys), list(order), gone, buckets

    def _state(self) -> dict:
        return versions.pointer(self.spark, self.root) or {"batch": -1, "buckets": {}, "before": {}}

    def _rows(self, buckets: dict[str, str]) -> DataFrame:
        paths = [f"{self.root}/{folder}/bucket={b}" for b, folder in sorted(buckets.items())]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        return self._rows(self._state()["buckets"])

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        state = self._state()
        if batch_id <= state["batch"]:
            return
        # Written once, so that a stateful batch is not computed for every read of it.
        arrived = f"{self.root}/arrived-{batch_id}"
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        batch.select(*self.schema.names).withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(arrived)
        touched = [str(b) for b in range(self.buckets) if versions.exists(self.spark, f"{arrived}/bucket={b}")]
        now = dict(state["buckets"])
        if touched:
            folder = f"merged-{batch_id}-{uuid.uuid4().hex[:8]}"
            old = self._rows({b: f for b, f in now.items() if b in touched})
            rows = old.unionByName(self._rows({b: f"arrived-{batch_id}" for b in touched}))
            newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*self.schema.names), F.struct(*self.order)).alias("r")).select("r.*")
            kept = newest.where(~F.col(self.gone)) if self.gone else newest
            kept.withColumn("bucket", bucket).repartition(len(touched), "bucket").write.partitionBy("bucket").parquet(f"{self.root}/{folder}")
            for b in touched:
                now.pop(b, None)
                if versions.exists(self.spark, f"{self.root}/{folder}/bucket={b}"):
                    now[b] = folder
        versions.move_pointer(self.spark, self.root, {"batch": batch_id, "buckets": now, "before": state["buckets"]})
        versions.remove(self.spark, arrived)
        # Readers may still hold the version before this one.
        used = {*now.values(), *state["buckets"].values()}
        for folder in {*state["before"].values()} - used:
            versions.remove(self.spark, f"{self.root}/{folder}")
