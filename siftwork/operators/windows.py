"""Newest-N samples, re-upload removal, representative items and paged scans.

Every per-entity window is cut to a fixed N right on its row number, so Spark prunes
each map task to N rows per entity before the shuffle: an entity holding a third of
all rows sends N rows per task, not its history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed_values as V
from ..functions.text import normalize_title
from .folds import fold_in_order


def newest_first():
    return [F.desc("published_at"), F.asc("item_id")]


def newest_n(items: DataFrame, n: int, order=None, key: str = "entity_id") -> DataFrame:
    """The first ``n`` items per entity with their 1-based ``position``."""
    w = Window.partitionBy(key).orderBy(*(order or newest_first()))
    return items.withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)


def newest_n_where(items: DataFrame, pred: Column, n: int, order=None, key: str = "entity_id") -> DataFrame:
    """Filter first, then take the newest ``n``: the sample is never short because of unusable items."""
    return newest_n(items.where(pred), n, order, key)


def comparable_title(title, seconds) -> Column:
    """Normalised title of an item that can be compared, null when its title or length is unknown."""
    norm = normalize_title(title)
    return F.nullif(F.when(F.coalesce(F.col(seconds), F.lit(0)) != 0, norm), F.lit(""))


def fold_reuploads(sample: Column, tolerance: int = V.DUPLICATE_TOLERANCE_SECONDS) -> Column:
    """Keep the first of each re-upload in an ordered, bounded array of structs with ``norm`` and ``seconds``.

    An entry falls only to an entry already *kept*, so this is a fold, not a lag. A null ``norm``
    matches nothing.
    """

    def same(kept, x):
        close = F.abs(kept["seconds"] - x["seconds"]) <= tolerance
        return F.coalesce((kept["norm"] == x["norm"]) & close, F.lit(False))

    return F.aggregate(
        sample, F.slice(sample, 1, 0),
        lambda acc, x: F.when(F.exists(acc, lambda k: same(k, x)), acc).otherwise(F.concat(acc, F.array(x))),
    )


class _KeptLengths:
    """Lengths kept of one island. Two lengths in one cell are within the tolerance, so a cell holds one and only its neighbours matter."""

    def __init__(self, tolerance: int):
        self.tolerance = tolerance

    def __call__(self):
        cells, width, tolerance = {}, self.tolerance + 1, self.tolerance

        def step(seconds: int):
            cell = seconds // width
            for c in (cell - 1, cell, cell + 1):
                if abs(cells.get(c, seconds + width) - seconds) <= tolerance:
                    return None
            cells[cell] = seconds
            return ()

        return step


def drop_reuploads(items: DataFrame, tolerance: int = V.DUPLICATE_TOLERANCE_SECONDS, order_col: str = "item_id") -> DataFrame:
    """Items kept after re-upload removal over whole histories.

    Copies with the same title *and* length share the fate of the first of them, so each
    (entity, title, seconds) is first reduced to that one row by a partial aggregate. The lengths
    of a title that lie within the tolerance of a neighbour form islands; across a wider gap nothing can
    meet. A length alone on its island stays, and only the others are folded, an island at a time in one pass over sorted rows.
    """
    keyed = items.select("entity_id", "item_id", F.col(order_col).alias("ord"), comparable_title("title", "seconds").alias("norm"), F.col("seconds").cast("bigint").alias("seconds"))
    loose = keyed.where("norm is null").select("entity_id", "item_id")
    firsts = keyed.where("norm is not null").groupBy("entity_id", "norm", "seconds").agg(
        F.min("ord").alias("ord"), F.min_by("item_id", "ord").alias("item_id"))
    title = Window.partitionBy("entity_id", "norm").orderBy("seconds")
    far = F.coalesce(F.col("seconds") - F.lag("seconds").over(title) > tolerance, F.lit(True))
    alone = far & F.coalesce(F.lead("seconds").over(title) - F.col("seconds") > tolerance, F.lit(True))
    placed = firsts.withColumn("alone", alone).withColumn("far", far).withColumn("island", F.sum(F.col("far").cast("int")).over(title))
    kept = fold_in_order(placed.where("not alone"), ["entity_id", "norm", "island"], ["ord", "item_id"], ["seconds"], _KeptLengths(tolerance), ["entity_id", "item_id"], [])
    return kept.unionByName(placed.where("alone").select("entity_id", "item_id")).unionByName(loose)


def representative(sample: DataFrame) -> DataFrame:
    """Upper-median item by views of a bounded per-entity sample (needs an id and a length)."""
    usable = sample.where(F.col("item_id").isNotNull() & (F.coalesce(F.col("seconds"), F.lit(0)) != 0))
    by_entity = Window.partitionBy("entity_id")
    ranked = usable.withColumn("n", F.count(F.lit(1)).over(by_entity)).withColumn(
        "rn", F.row_number().over(by_entity.orderBy("views", "position")))
    return ranked.where(F.col("rn") == F.floor(F.col("n") / 2) + 1).select("entity_id", "item_id", "views", "seconds")


def deep_scan(items: DataFrame, contacts: Column, done: DataFrame | None = None, page_size=V.WIDE_WINDOW,
              pages=V.DEEP_SCAN_PAGES, min_items=V.REPEATED_CONTACT_MIN_ITEMS, order=None) -> DataFrame:
    """Contact repeated in enough items, extending the sample page by page until one is.

    The first page on which any contact has ``min_items`` distinct items decides; among those
    that qualify there the most frequent wins (then first seen, then value). Entities in
    ``done`` already have a contact and are skipped.
    """
    bounded = newest_n(items.withColumn("_c", F.array_distinct(contacts)), page_size * (pages + 1), order).select("entity_id", "position", "_c")
    if done is not None:  # an anti join would be moved below the window and shuffle every item
        bounded = bounded.join(done.select("entity_id", F.lit(True).alias("_done")), "entity_id", "left").where("_done is null")
    hits = bounded.select(
        "entity_id", "position", F.floor((F.col("position") - 1) / page_size).alias("page"), F.explode("_c").alias("contact"))
    nth = Window.partitionBy("entity_id", "contact").orderBy("position")
    reach = hits.withColumn("rn", F.row_number().over(nth)).where(F.col("rn") == min_items)
    first_page = reach.groupBy("entity_id").agg(F.min("page").alias("found_page"))
    upto = hits.join(first_page, "entity_id").where(F.col("page") <= F.col("found_page"))
    counts = upto.groupBy("entity_id", "found_page", "contact").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("first"))
    best = F.min(F.struct((-F.col("n")).alias("neg"), "first", "contact"))
    return counts.where(F.col("n") >= min_items).groupBy("entity_id", "found_page").agg(best.alias("b")).select(
        "entity_id", F.col("b.contact").alias("contact"), (-F.col("b.neg")).alias("n_items"), "found_page")


def paged_counts(position: Column, short: Column, page_size: int, pages: int) -> list[Column]:
    """Proven-long count of each page, as aggregates ``p0..pN`` and the last page that has items."""
    page = F.floor((position - 1) / page_size)
    return [F.count_if((page == p) & ~short).alias(f"p{p}") for p in range(pages + 1)] + [F.max(page).alias("last_page")]


def paged_total(target: int, pages: int) -> tuple[Column, Column]:
    """Count after the first page that reaches ``target`` (else the last page), and pages read."""
    running = [sum((F.col(f"p{i}") for i in range(1, p + 1)), F.col("p0")) for p in range(pages + 1)]
    total, read = running[-1], F.col("last_page")
    for p in reversed(range(pages)):
        total = F.when(running[p] >= target, running[p]).otherwise(total)
        read = F.when(running[p] >= target, F.least(F.lit(p), F.col("last_page"))).otherwise(read)
    return total, read + 1


def bounded_long_count(items: DataFrame, short: Column, target=V.MIN_LONG_COUNT, page_size=V.WIDE_WINDOW,
                       pages=V.LONG_SCAN_PAGES, order=None) -> DataFrame:
    """Proven-long count after the first page that reaches ``target``, else after the last page."""
    bounded = newest_n(items.withColumn("_s", short), page_size * (pages + 1), order)
    counts = bounded.groupBy("entity_id").agg(*paged_counts(F.col("position"), F.col("_s"), page_size, pages))
    total, read = paged_total(target, pages)
    return counts.select("entity_id", total.alias("long_count"), read.alias("pages_read"))
