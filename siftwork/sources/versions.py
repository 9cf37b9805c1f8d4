"""Tables in versions: readers find the current one through a small pointer file that is replaced at once.

A new version is written beside the old one and checked before the pointer moves, so a table can be rewritten from itself, and a
write that fails leaves the old version as it was. One writer at a time; readers need no lock. The pointer is
replaced by a rename, which must be atomic on the file system used (HDFS, local disks).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

POINTER = "_current.json"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def make_folder(spark: SparkSession, path: str) -> str:
    _fs(spark, path).mkdirs(_path(spark, path))
    return path


def remove(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def pointer(spark: SparkSession, root: str) -> dict | None:
    """What the pointer of the table says, or None before its first version."""
    file = f"{root}/{POINTER}"
    if not exists(spark, file):
        return None
    stream = _fs(spark, file).open(_path(spark, file))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def move_pointer(spark: SparkSession, root: str, content: dict) -> None:
    fresh = f"{root}/_next-{uuid.uuid4().hex}.json"
    stream = _fs(spark, fresh).create(_path(spark, fresh), True)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    rename = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = fs.FileContext.getFileContext(_fs(spark, fresh).getUri(), spark._jsc.hadoopConfiguration())
    context.rename(_path(spark, fresh), _path(spark, f"{root}/{POINTER}"), options)


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = (), check: Callable[[DataFrame], None] | None = None, keep: int = 2) -> int:
    """Make ``df`` the table's next version and return its number; ``check`` may raise to refuse what was written.

    The last ``keep`` versions stay, so readers of the one before are undisturbed.
    """
    spark = df.sparkSession
    now = pointer(spark, root) or {"version": 0, "folders": []}
    version, folder = now["version"] + 1, f"{root}/version-{now['version'] + 1:06d}-{uuid.uuid4().hex[:8]}"
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
        written = spark.read.schema(df.schema).parquet(folder)
        if written.count() != seen.get["n"]:
            raise ValueError(f"{folder} does not hold all rows")
        if check:
            check(written)
    except Exception:
        remove(spark, folder)
        raise
    folders = [*now["folders"], folder]
    move_pointer(spark, root, {"version": version, "folders": folders[-keep:], "schema": df.schema.json()})
    for old in folders[:-keep]:
        remove(spark, old)
    return version


def current(spark: SparkSession, root: str, back: int = 0) -> DataFrame:
    """The current version of the table, or the one ``back`` versions before."""
    now = pointer(spark, root)
    if now is None or back >= len(now["folders"]):
        raise FileNotFoundError(f"no such version of {root}")
    reader = spark.read if back else spark.read.schema(StructType.fromJson(json.loads(now["schema"])))
    return reader.parquet(now["folders"][-1 - back])
