"""Keyword discovery: recent hits, merged keywords, early stop and variant unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import rounded


def keyword_hits(items: DataFrame, keywords: list[str], text: str = "title") -> DataFrame:
    """One row per (item, keyword it contains) with the keyword's place in the list.

    The keyword list is tested inside the row; there is no join between items and terms.
    """
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    terms = F.array(*[F.struct(F.lit(i).alias("idx"), F.lit(k).alias("keyword")) for i, k in enumerate(keywords)])
    hit = F.filter(terms, lambda t: F.contains(low, F.lower(t["keyword"])))
    return items.withColumn("_k", F.explode(hit)).select(*items.columns, F.col("_k.idx").alias("idx"), F.col("_k.keyword").alias("keyword"))


def search_recent(items: DataFrame, keywords: list[str], as_of: str, days_back: int, max_results: int) -> DataFrame:
    """First-seen entities among the newest ``max_results`` matching items per keyword of the last days."""
    since = F.lit(as_of).cast("timestamp") - F.expr(f"interval {int(days_back)} days")
    recent = items.where((F.col("published_at") >= since) & (F.col("published_at") <= F.lit(as_of).cast("timestamp")))
    w = Window.partitionBy("keyword").orderBy(F.desc("published_at"), F.asc("item_id"))
    top = keyword_hits(recent, keywords).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= max_results)
    return top.groupBy("keyword", "idx", "entity_id").agg(F.min("rn").alias("rank"), F.min_by("title", "rn").alias("title"))


def merge_keywords(hits: DataFrame) -> DataFrame:
    """One row per entity: sorted distinct keywords and the title seen first (keyword order, then rank)."""
    return hits.groupBy("entity_id").agg(
        F.array_sort(F.collect_set("keyword")).alias("matched_keywords"),
        F.min_by("title", F.struct("idx", "rank")).alias("title"))


def _keyword_rows(df: DataFrame, keywords: list[str]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(i).alias("idx"), F.lit(k).alias("keyword")) for i, k in enumerate(keywords)])
    return df.sparkSession.range(1).select(F.explode(rows).alias("k")).select("k.*")


def _first_seen(hits: DataFrame) -> DataFrame:
    return hits.groupBy("entity_id").agg(F.min("idx").alias("idx")).groupBy("idx").agg(F.count(F.lit(1)).alias("fresh"))


def early_stop(hits: DataFrame, keywords: list[str], target: int, exclude: DataFrame | None = None) -> DataFrame:
    """Keywords in order until the distinct fresh ids reach ``target``; later ones are not searched.

    Ids reduce to their first keyword and keywords to one count, so the running sum sees one row per keyword.
    """
    fresh = hits if exclude is None else hits.join(exclude.select("entity_id"), "entity_id", "left_anti")
    per = _keyword_rows(hits, keywords).join(_first_seen(fresh), "idx", "left").withColumn("fresh", F.coalesce("fresh", F.lit(0)))
    w = Window.partitionBy(F.lit(1)).orderBy("idx")
    run = per.withColumn("banked", F.sum("fresh").over(w))
    return run.withColumn("searched", F.coalesce(F.col("banked") - F.col("fresh") < target, F.lit(True))).select("idx", "keyword", "fresh", "banked", "searched")


def query_union(hits: DataFrame, variants: list[str]) -> DataFrame:
    """Per variant: distinct ids fetched, ids no earlier variant had, running union and gain over the first."""
    fetched = hits.groupBy("idx", "entity_id").agg(F.lit(1).alias("x")).groupBy("idx").agg(F.count(F.lit(1)).alias("fetched"))
    per = (
        _keyword_rows(hits, variants).join(fetched, "idx", "left").join(_first_seen(hits), "idx", "left")
        .select("idx", "keyword", F.coalesce("fetched", F.lit(0)).alias("fetched"), F.coalesce("fresh", F.lit(0)).alias("new"))
    )
    w = Window.partitionBy(F.lit(1)).orderBy("idx")
    base = F.first("fetched").over(w)
    union = F.sum("new").over(w)
    return per.select(
        "idx", "keyword", "fetched", "new", union.alias("union"),
        rounded((F.try_divide(union.cast("double"), base) - 1) * 100, 2).alias("gain_pct"))
