"""Where an entity's contact comes from, all steps of the chain in one pass over its items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed_values as V
from ..functions.links import resolve_contact
from .windows import newest_first


def contact_chain(items: DataFrame, contacts: Column, own_address: Column, page_size=V.WIDE_WINDOW, pages=V.DEEP_SCAN_PAGES,
                  min_items=V.REPEATED_CONTACT_MIN_ITEMS, order=None) -> DataFrame:
    """``entity_id, value, source`` for every entity: a contact repeated on the first page of its items, else the newest address of
    its own, else a contact repeated on the first further page where one is.

    Items are read once. Each gives itself and, where it has one, its address, as rows of two kinds; the window keeps the
    first rows of each kind before the shuffle, and two aggregates tell the winner of every step. Contacts
    count once an item; ties go to the first seen, then to the smaller value.
    """
    n_pages = pages + 1
    kinds = F.array(F.struct(F.array_distinct(contacts).alias("contacts"), F.lit(None).cast("string").alias("address")),
                    F.when(F.coalesce(own_address, F.lit("")) != "", F.struct(F.array().cast("array<string>").alias("contacts"), own_address.alias("address"))))
    rows = items.withColumn("_row", F.explode(F.array_compact(kinds))).withColumn("_mail", F.col("_row.address").isNotNull())
    w = Window.partitionBy("entity_id", "_mail").orderBy(*(order or newest_first()))
    near = rows.withColumn("_at", F.row_number().over(w)).where(F.col("_at") <= page_size * n_pages)
    hits = near.select("entity_id", "_at", "_mail", F.col("_row.address").alias("address"), F.explode_outer("_row.contacts").alias("contact"))
    upto = [F.count_if(~F.col("_mail") & (F.col("_at") <= page_size * (p + 1))).alias(f"n{p}") for p in range(n_pages)]
    counts = hits.groupBy("entity_id", "contact").agg(*upto, F.min("_at").alias("first"), F.min(F.when(F.col("_mail") & (F.col("_at") == 1), F.col("address"))).alias("address"))
    winner = lambda p: F.min(F.when(F.col("contact").isNotNull() & (F.col(f"n{p}") >= min_items), F.struct((-F.col(f"n{p}")).alias("neg"), "first", "contact")))
    steps = counts.groupBy("entity_id").agg(*[winner(p).alias(f"w{p}") for p in range(n_pages)], F.min("address").alias("address"))
    older = F.coalesce(*[F.col(f"w{p}.contact") for p in range(1, n_pages)], F.lit(""))
    picked = resolve_contact((F.col("w0.contact"), V.CONTACT_SOURCES[0]), (F.col("address"), V.CONTACT_SOURCES[1]), (older, V.CONTACT_SOURCES[2]))
    return steps.select("entity_id", picked.alias("r")).select("entity_id", "r.value", "r.source")
