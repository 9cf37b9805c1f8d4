"""Risk and overall scores."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed_values as V
from .text import as_col, rounded


def _clamp(x, lo, hi) -> Column:
    return F.least(F.lit(float(hi)), F.greatest(F.lit(float(lo)), x))


def fake_follower_risk(subscribers, views, engagement) -> Column:
    """0-100, higher is riskier: few views per follower, little engagement, and both at size."""
    s, v, e = (as_col(x).cast("double") for x in (subscribers, views, engagement))
    ratio = F.try_divide(v, s)
    low_views = F.when(ratio < V.RISK_VIEW_RATIO, 45 * _clamp(1 - ratio / V.RISK_VIEW_RATIO, 0, 1)).otherwise(0.0)
    low_eng = F.when(e < V.RISK_ENGAGEMENT, 35 * _clamp(1 - e / V.RISK_ENGAGEMENT, 0, 1)).otherwise(0.0)
    combo = F.when((s >= V.RISK_HIGH_SUBSCRIBERS) & (ratio < V.RISK_COMBO_RATIO), 20.0).otherwise(0.0)
    return F.when(s <= 0, F.lit(100.0)).otherwise(rounded(F.least(F.lit(100.0), low_views + low_eng + combo), 1))


def norm_log(value, ceiling) -> Column:
    v = as_col(value).cast("double")
    positive = F.greatest(v, F.lit(0.0))
    scaled = F.log10(positive + 1) / F.log10(F.lit(float(ceiling) + 1)) * 100
    return F.when(v <= 0, F.lit(0.0)).otherwise(rounded(_clamp(scaled, 0, 100), 1))


def norm_linear(value, ceiling) -> Column:
    if ceiling <= 0:
        return F.lit(0.0)
    return rounded(_clamp(as_col(value).cast("double") / F.lit(float(ceiling)) * 100, 0, 100), 1)


def norm_freq(per_month) -> Column:
    f = as_col(per_month).cast("double")
    return (
        F.when(f <= 0, F.lit(0.0))
        .when(f < V.FREQ_IDEAL_MIN, rounded(f / V.FREQ_IDEAL_MIN * 100, 1))
        .when(f <= V.FREQ_IDEAL_MAX, F.lit(100.0))
        .otherwise(rounded(F.greatest(F.lit(50.0), F.try_divide(F.lit(float(V.FREQ_IDEAL_MAX)), f) * 100), 1))
    )


def overall_score(subscribers, views, engagement, per_month, risk, niche_match=V.NICHE_MATCH_DEFAULT) -> Column:
    total = (
        0.20 * norm_log(subscribers, V.SUBSCRIBER_CEILING)
        + 0.20 * norm_log(views, V.VIEWS_CEILING)
        + 0.20 * norm_linear(engagement, V.ENGAGEMENT_CEILING)
        + 0.15 * norm_freq(per_month)
        + 0.15 * (100 - as_col(risk))
        + 0.10 * (niche_match if isinstance(niche_match, Column) else F.lit(float(niche_match)))
    )
    return F.round(_clamp(total, 0, 100), 1)
