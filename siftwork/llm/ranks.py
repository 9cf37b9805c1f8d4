"""Places of rows in one order over a whole table, without passing the table through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """``df`` with ``name``, the row's place from 0 in this order, which must leave no ties.

    Rows are dealt by ranges of the order and written once; places are counted inside each part, behind the sizes of the parts
    before it, of which there are no more than partitions.
    """
    parts = staged(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranked")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("__part").agg(F.count("*").alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return parts.withColumn("__inside", inside).join(starts, "__part").withColumn(name, (F.col("__start") + F.col("__inside")).cast("long")).drop("__part", "__start", "__inside")
