"""Per-entity metrics over bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.shape import is_short, settled, upload_frequency, uploads_per_year, whole_days, instant
from ..functions.text import contains_any
from .windows import comparable_title, fold_reuploads, newest_n, paged_counts, paged_total


def _total(arr: Column, field: str) -> Column:
    return F.aggregate(arr, F.lit(0).cast("bigint"), lambda acc, x: acc + F.coalesce(x[field], F.lit(0)))


def _rate(engagements: Column, views: Column) -> Column:
    return F.when(views > 0, F.try_divide(engagements.cast("double"), views) * 100).otherwise(F.lit(0.0))


def _mode(tags: Column) -> Column:
    """The most frequent entry of a bounded array, ties to the first; a blank for an empty one."""
    seen = F.array_distinct(tags)
    counts = F.transform(seen, lambda x, i: F.struct((-F.size(F.filter(tags, lambda y: y == x))).alias("neg"), i.alias("at"), x.alias("tag")))
    return F.coalesce(F.array_min(counts)["tag"], F.lit(""))


def entity_metrics(items: DataFrame, as_of: str, wide=V.WIDE_WINDOW, narrow=V.METRIC_WINDOW, long_target=V.MIN_LONG_COUNT,
                   long_pages: int = 0, row_columns: dict[str, Column] | None = None, aggregates: list[Column] = (), modes: list[str] = ()) -> DataFrame:
    """All per-entity metrics in one shuffle: window to the newest items, then one aggregate.

    Views, engagement, minimum and sample come from the long, de-duplicated, reported and
    settled items (newest ``narrow`` of them), falling back to the newest ``narrow`` raw items
    when there are none. Dates always come from the newest ``narrow`` list positions. With
    ``long_pages`` the long count may read that many further pages of ``wide`` items.
    ``row_columns`` and ``aggregates`` let a caller take more from the same wide window. Each column named in ``modes``
    gives its most frequent non-blank value there (ties to the newest), or a blank, from that same aggregate.
    """
    row_columns = {**(row_columns or {}), **{f"tag_{c}": F.nullif(F.col(c), F.lit("")) for c in modes}}
    w = newest_n(
        items.select(
            "entity_id", "item_id", "published_at", "views", "engagements", "seconds",
            comparable_title("title", "seconds").alias("norm"), is_short("seconds", "w", "h").alias("short"),
            settled("published_at", as_of).alias("settled"), *[c.alias(n) for n, c in row_columns.items()],
        ), wide * (1 + long_pages))
    near, inside = F.col("position") <= narrow, F.col("position") <= wide
    entry = F.struct("position", "item_id", "norm", "seconds", "views", "engagements", "settled")
    agg = w.groupBy("entity_id").agg(
        F.sort_array(F.collect_list(F.when(inside & ~F.col("short"), entry))).alias("s"),  # at most ``wide`` entries
        F.count_if(near).alias("raw_n"),
        F.sum(F.when(near, F.coalesce("views", F.lit(0)))).alias("raw_views"),
        F.sum(F.when(near, F.col("engagements"))).alias("raw_eng"),
        F.count(F.when(near, F.col("published_at"))).alias("n_dates"),
        F.min(F.when(near, F.col("published_at"))).alias("first_date"),
        F.max(F.when(near, F.col("published_at"))).alias("last_date"),
        F.count_if(inside).alias("wide_n"),
        F.every(~inside | F.coalesce("short", F.lit(False))).alias("all_short"),
        *paged_counts(F.col("position"), F.col("short"), wide, long_pages),
        *[F.sort_array(F.collect_list(F.when(inside & F.col(f"tag_{c}").isNotNull(), F.struct("position", F.col(f"tag_{c}").alias("tag"))))).alias(f"tags_{c}") for c in modes],
        *aggregates,
    )
    kept = F.slice(F.filter(fold_reuploads(F.col("s")), lambda x: x["views"].isNotNull() & x["settled"]), 1, narrow)
    m = agg.withColumn("k", kept)
    views, eng = _total(F.col("k"), "views"), _total(F.col("k"), "engagements")
    n = F.size("k")
    has = n > 0
    extra = [c for c in agg.columns if c not in _OWN and not c.startswith(("p", "tags_"))] + [_mode(F.col(f"tags_{c}.tag")).alias(c) for c in modes]
    return m.select(
        "entity_id",
        F.when(has, F.try_divide(views.cast("double"), n)).otherwise(F.try_divide(F.col("raw_views").cast("double"), F.col("raw_n"))).alias("avg_views"),
        F.when(has, _rate(eng, views)).otherwise(_rate(F.col("raw_eng"), F.col("raw_views"))).alias("engagement_rate"),
        F.array_min(F.transform("k", lambda x: x["views"])).alias("min_views"),
        F.when(has, n.cast("bigint")).otherwise(F.col("raw_n")).alias("sample_size"),
        F.transform("k", lambda x: x["views"]).alias("settled_views"),
        F.transform("k", lambda x: F.struct(x["item_id"].alias("item_id"), x["views"].alias("views"), x["seconds"].alias("seconds"))).alias("settled_items"),
        "all_short", F.col("p0").alias("long_count"), paged_total(long_target, long_pages)[0].alias("long_total"), "wide_n", "n_dates",
        upload_frequency("n_dates", F.col("first_date"), F.col("last_date")).alias("per_month"),
        uploads_per_year("n_dates", F.col("first_date"), F.col("last_date")).alias("per_year"),
        whole_days("last_date", instant(as_of)).alias("days_since"),
        *extra,
    )


_OWN = {"entity_id", "s", "raw_n", "raw_views", "raw_eng", "n_dates", "first_date", "last_date", "wide_n", "all_short", "last_page"}


def cadence(items: DataFrame, as_of: str, narrow=V.METRIC_WINDOW) -> DataFrame:
    """Pace and recency over the newest ``narrow`` list positions."""
    d = newest_n(items.select("entity_id", "item_id", "published_at"), narrow).groupBy("entity_id").agg(
        F.count("published_at").alias("n"), F.min("published_at").alias("first"), F.max("published_at").alias("last"))
    return d.select(
        "entity_id", "n",
        upload_frequency("n", F.col("first"), F.col("last")).alias("per_month"),
        uploads_per_year("n", F.col("first"), F.col("last")).alias("per_year"),
        whole_days("last", instant(as_of)).alias("days_since"),
    )


def dominant(df: DataFrame, value: str, order: str, key: str = "entity_id") -> DataFrame:
    """Most frequent non-blank value per entity, ties to the first seen. Two partial aggregates, no window."""
    counts = df.where(F.coalesce(F.col(value), F.lit("")) != "").groupBy(key, value).agg(
        F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    best = F.min(F.struct((-F.col("n")).alias("neg"), "first", F.col(value).alias("value")))
    return counts.groupBy(key).agg(best.alias("b")).select(key, F.col("b.value").alias(value), (-F.col("b.neg")).alias("n"))


def repeated_contact(df: DataFrame, contacts: Column, order: str, min_items=V.REPEATED_CONTACT_MIN_ITEMS, key: str = "entity_id") -> DataFrame:
    """Most frequent contact that occurs in at least ``min_items`` distinct items (then first seen, then value)."""
    hits = df.select(key, F.col(order).alias("ord"), F.explode(F.array_distinct(contacts)).alias("contact"))
    counts = hits.groupBy(key, "contact").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first"))
    best = F.min(F.struct((-F.col("n")).alias("neg"), "first", "contact"))
    return counts.where(F.col("n") >= min_items).groupBy(key).agg(best.alias("b")).select(
        key, F.col("b.contact").alias("contact"), (-F.col("b.neg")).alias("n_items"))


def shape_summary(sample: DataFrame, short: Column, key: str = "entity_id") -> DataFrame:
    """All-short verdict (every item proven) and proven-long count of a sample."""
    s = sample.withColumn("_s", short)
    return s.groupBy(key).agg(
        F.every(F.coalesce("_s", F.lit(False))).alias("all_short"),
        F.count_if(~F.col("_s")).alias("n_long"),
        F.count(F.lit(1)).alias("n"),
    )


def clears_ratio(values: Column, floor=V.MIN_VIEWS_PER_ITEM, ratio=V.MIN_VIEWS_RATIO, min_n=V.MIN_RATIO_SAMPLE) -> Column:
    """At least ``ceil(ratio * n)`` values reach ``floor``; samples under ``min_n`` cannot fail."""
    n = F.size(values)
    hits = F.size(F.filter(values, lambda v: v >= floor))
    return (n < min_n) | (hits >= F.ceil(F.lit(float(ratio)) * n))


def off_target_marks(title: str, terms: dict[str, list[str]], on_terms: list[str]) -> dict[str, Column]:
    """Per-row hits: one regex per category and one for the on-target terms. Blank titles are not judged."""
    judged = F.length(F.trim(F.coalesce(F.col(title), F.lit("")))) > 0
    marks = {f"c_{c}": judged & contains_any(title, t) for c, t in terms.items()}
    return {"judged": judged, **marks, "on": judged & contains_any(title, on_terms)}


def off_target_aggregates(terms: dict[str, list[str]], inside: Column | None = None) -> list[Column]:
    """Judged titles, off/on hits and categories hit, over the rows marked ``inside``."""
    ok = F.lit(True) if inside is None else inside
    anyoff = F.lit(False)
    for c in terms:
        anyoff = anyoff | F.col(f"c_{c}")
    cats = F.array_compact(F.array(*[F.when(F.coalesce(F.max(ok & F.col(f"c_{c}")), F.lit(False)), F.lit(c)) for c in sorted(terms)]))
    return [F.count_if(ok & F.col("judged")).alias("n_titles"), F.count_if(ok & anyoff).alias("off_hits"),
            F.count_if(ok & F.col("on")).alias("on_hits"), cats.alias("categories")]


def off_target_shares(titles: DataFrame, terms: dict[str, list[str]], on_terms: list[str], key: str = "entity_id") -> DataFrame:
    """Judged titles, off/on hits and categories hit per entity."""
    marks = off_target_marks("title", terms, on_terms)
    return titles.select(key, *[c.alias(n) for n, c in marks.items()]).groupBy(key).agg(*off_target_aggregates(terms)).where("n_titles > 0")


def off_target_verdict(bio_signals: Column, restricted: bool = False, min_share=V.OFF_TARGET_MIN_SHARE) -> Column:
    """``struct(reason, detail)`` over the columns of :func:`off_target_shares`, null when on target."""
    off = F.try_divide(F.col("off_hits").cast("double"), F.col("n_titles"))
    on = F.try_divide(F.col("on_hits").cast("double"), F.col("n_titles"))

    def pct(x):
        return F.concat(F.round(x * 100, 0).cast("bigint").cast("string"), F.lit("%"))

    detail = F.concat(pct(off), F.lit(" of "), F.col("n_titles").cast("string"), F.lit(" recent titles are "),
                      F.array_join("categories", "/"), F.lit(" vs "), pct(on), F.lit(" on-niche"))
    shown = F.transform(F.slice(bio_signals, 1, 2), lambda s: F.when(
        F.contains(s, F.lit("'")), F.concat(F.lit('"'), s, F.lit('"'))).otherwise(F.concat(F.lit("'"), s, F.lit("'"))))
    persona = F.concat(detail, F.lit("; bio says ["), F.array_join(shown, ", "), F.lit("]"))

    def out(d):
        return F.struct(F.lit("off_target_niche").alias("reason"), d.alias("detail"))

    ahead = off > on
    v = F.when(ahead & (off >= min_share), out(detail))
    if not restricted:
        v = v.when(ahead & (F.size(bio_signals) > 0) & (F.col("off_hits") > 0), out(persona))
    return v
