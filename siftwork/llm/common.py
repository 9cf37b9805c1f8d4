"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.session import scratch_dir

#: What separates words everywhere in this subpackage, as a Java and as a Python pattern: space and the controls from tab to carriage return.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage, survives the loss of executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(text: str | Column = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def digest(text: str | Column = "text") -> Column:
    """Sixteen bytes that stand for a text; equal texts, and null and empty, have the same."""
    return F.unhex(F.md5(whole(text)))


def id_remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % n


def sampled(df: DataFrame, n: int) -> DataFrame:
    """About ``n`` distinct rows: those that hash, all columns together, into the lowest ``n`` parts of as many as there are rows.

    The same rule holds at every size; nulls are values like others. Nothing is sorted. Equal rows share a place and count
    once, so a group of copies is one row of the sample.
    """
    total, parts = df.count(), 1 << 62
    if total > n:
        df = df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(parts)) < F.lit(parts // total * n))
    return df.dropDuplicates()


def with_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with these columns; one of the same name in any case is replaced."""
    taken = {c.lower() for c in columns}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken], *[v.alias(k) for k, v in columns.items()])


def only(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Just these columns, whatever else ``df`` has."""
    return df.select(*[F.col(f"`{c}`") for c in names])


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed vocabulary file of this name lies; read on the driver only."""
    import public_tokenizers

    return public_tokenizers.path(name)
