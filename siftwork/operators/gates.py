"""Ordered reject rules. The first failing rule names the reason; unknown values pass unless stated."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions import fixed_values as V
from ..functions.text import as_col, is_english
from .metrics import clears_ratio


def hard_gate(subscribers="subscribers", avg_views="avg_views", all_short="all_short", language="language", item_count="item_count",
              settled_views="settled_views", per_year="per_year", days_since="days_since", *, min_avg_views=0.0,
              min_items=V.MIN_ITEM_COUNT, floor=V.MIN_VIEWS_PER_ITEM, ratio=V.MIN_VIEWS_RATIO, min_sample=V.MIN_RATIO_SAMPLE,
              min_per_year=V.MIN_UPLOADS_PER_YEAR, max_days=V.MAX_DAYS_SINCE_LAST, dead_subscribers=V.DEAD_MIN_SUBSCRIBERS,
              dead_views=V.DEAD_MIN_VIEWS) -> Column:
    """Reason text or null. Null views count as 0; a null item count, pace or recency passes."""
    views = F.coalesce(as_col(avg_views), F.lit(0.0))
    sv = as_col(settled_views)
    weak = (F.size(F.coalesce(sv, F.array().cast("array<bigint>"))) > 0) & ~clears_ratio(sv, floor, ratio, min_sample)
    return (
        F.when(as_col(all_short), F.lit("shorts_only"))
        .when(~is_english(language), F.lit("not_english"))
        .when(as_col(item_count) < min_items, F.lit("too_few_videos"))
        .when(views < min_avg_views, F.lit("below_view_minimum"))
        .when(weak, F.lit("video_below_view_minimum"))
        .when(as_col(per_year) < min_per_year, F.lit("upload_cadence_too_low"))
        .when(as_col(days_since) > max_days, F.lit("stale_channel"))
        .when((F.coalesce(as_col(subscribers), F.lit(0)) < dead_subscribers) & (views < dead_views), F.lit("dead_channel"))
    )


def longform_gate(n, minimum=V.MIN_LONG_COUNT) -> Column:
    """Too few proven long items is a failure even on partial data."""
    return F.when(as_col(n) < minimum, F.lit("too_few_longform_videos"))


def durable_reject(reason) -> Column:
    """Reasons about the entity, not about the run."""
    return ~F.coalesce(as_col(reason), F.lit("unknown")).isin(*V.TRANSIENT_REASONS)


def deletable(verdict, status, statuses=V.DELETABLE_STATUSES) -> Column:
    return ~as_col(verdict).isin("pass", "unreachable") & F.coalesce(as_col(status).isin(*statuses), F.lit(False))


def send_queue(df, *, qualified=V.QUALIFIED, approved="Approved"):
    """Rows a run may contact, oldest request first."""
    def some(c):
        return F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
    return df.where(
        (F.col("qualification") == qualified) & (F.col("status") == approved) & some("requested_at")
        & some("email") & ~some("ineligible_reason")
    ).orderBy(F.col("requested_at").cast("string"), "entity_id")
