"""Sharding: a two-pass shuffle. Rows are scattered over buckets of bounded size by seeded hashes, then every bucket is shuffled.

Only DataFrame functions. The law is ``key``: the id and the number of shards decide the shard, by the highest of one seeded
hash for each shard, so a further shard takes rows only into itself and no other row moves. Inside a shard, rows scatter
over as many buckets as the size of all rows asks for, by a hash of id, text and number of the copy, so that rows of one id
(or without one) spread too. A bucket is put in order and then shuffled by the Fisher-Yates shuffle of Spark's ``shuffle`` with a
seed; the shard is its buckets one after the other. How many rows a bucket holds is counted from the keys alone, beside the
exchange of the rows.

A null id is a key like any other; a null text has no bytes, so its size is 8. Rows equal in id and text are told apart by the
column named ``copy``; without one they share a bucket. ``digest`` needs no texts behind their size and checksums, so equal rows
become one row with their number, and the copies, numbered in blocks, are spread before they are dealt out. Columns of other names pass through
``shard``; those named like a result are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import only, staged, with_columns

SHARDS = 24
BUCKET_BYTES = 8 << 20
SEED = 20240611
#: Bytes that a row of the query form takes, and how many copies of a row one task deals out at a time.
DIGEST_BYTES, COPIES = 64, 10_000


def row_size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long") + 8


def shard_of(doc_id: str, shards: int) -> Column:
    """The shard with the highest hash; one more shard only adds a candidate."""
    drawn = [F.struct(F.xxhash64(F.lit(SEED), F.lit(k), F.col(f"`{doc_id}`"), F.lit(k)).alias("h"), F.lit(k).alias("k")) for k in range(shards)]
    return F.greatest(*drawn)["k"] if shards > 1 else F.lit(0)


def shard(docs: DataFrame, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED, doc_id: str = "doc_id", text: str = "text", copy: str | None = None,
          size: Column | None = None) -> DataFrame:
    """``docs`` with shard, slot and grown_shard (with one shard more). ``bucket_bytes`` bounds what one task shuffles in memory, on average, rows having ``size`` bytes."""
    total = docs.agg(F.sum(row_size(text) if size is None else size)).first()[0] or 0
    per_shard = max(1, -(-int(total) // (shards * bucket_bytes)))
    salt = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in (doc_id, text, copy) if c])
    bucket = shard_of(doc_id, shards) * per_shard + F.pmod(salt, F.lit(per_shard)).cast("int")
    placed = with_columns(docs, shard=shard_of(doc_id, shards), grown_shard=shard_of(doc_id, shards + 1))
    record = F.struct(F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`")).alias("__order"), *[F.col(f"`{c}`") for c in placed.columns])
    keyed = placed.withColumn("__bucket", bucket)
    buckets = keyed.repartition(shards * per_shard, "__bucket").groupBy("__bucket").agg(F.sort_array(F.collect_list(record)).alias("__rows"))
    # Shuffled in the order of buckets, so that a task run again draws the same numbers.
    mixed = buckets.sortWithinPartitions("__bucket").select("__bucket", F.shuffle("__rows", F.lit(seed)).alias("__rows"))
    before = Window.partitionBy((F.col("__bucket") / per_shard).cast("int")).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = docs.select(bucket.alias("__bucket")).groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    rows = mixed.join(offsets, "__bucket").select("__before", F.posexplode("__rows").alias("__pos", "__row"))
    return with_columns(rows.select("__row.*", "__before", "__pos").drop("__order"), slot=(F.col("__before") + F.col("__pos")).cast("long")).drop("__before", "__pos")


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """One folder for each shard; a reader orders a shard by slot."""
    shard(docs, **options).write.partitionBy("shard").parquet(path)


def digest(docs: DataFrame) -> DataFrame:
    """Query form: where every document goes, with the size and checksum of its text."""
    keys = only(docs, ["doc_id", "text"]).select(
        "doc_id", row_size().alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.xxhash64("text").alias("__text"))
    counted = keys.groupBy(*keys.columns).agg(F.count(F.lit(1)).alias("__n"))
    blocks = counted.withColumn("__block", F.explode(F.sequence(F.lit(0), F.expr(f"(__n - 1) div {COPIES}")))).repartition("doc_id", "__text", "__block")
    first = F.col("__block") * COPIES
    # Written once: the keys are read for their number, for the counts of buckets and as rows.
    rows = staged(blocks.select(*keys.columns, F.explode(F.sequence(first, F.least(first + COPIES, F.col("__n")) - 1)).alias("__copy")), "shard-keys")
    placed = shard(rows, text="__text", copy="__copy", size=F.lit(DIGEST_BYTES))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.col("grown_shard").cast("int").alias("grown_shard"))
