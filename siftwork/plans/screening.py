"""The whole ordered screen, and the re-audit of rows already published."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as V, geo, links, scoring, shape, text
from ..operators import gates, matching, metrics, reports


@dataclass(frozen=True)
class Rules:
    """One niche's rules. Every list and threshold is a parameter; the defaults are the fixed values."""

    zone: list[str]
    topics: dict = field(default_factory=lambda: V.EXCLUDED_TOPIC_TERMS)
    broadcast_names: list = field(default_factory=lambda: V.BROADCAST_NAME_TERMS)
    broadcast_phrases: list = field(default_factory=lambda: V.BROADCAST_PHRASE_TERMS)
    script_ranges: list = field(default_factory=lambda: V.NON_LATIN_RANGES)
    off_terms: dict = field(default_factory=lambda: V.OFF_TARGET_TERMS)
    on_terms: list = field(default_factory=list)
    off_categories: list | None = None  # None: every category applies
    off_min_share: float = V.OFF_TARGET_MIN_SHARE
    bio_signals: list = field(default_factory=lambda: V.BIO_OFF_SIGNALS)
    gate: dict = field(default_factory=dict)
    min_long: int = V.MIN_LONG_COUNT
    long_pages: int = V.LONG_SCAN_PAGES
    min_age_months: float | None = None


def _entity_stage(rules: Rules) -> Column:
    """First failing rule that needs the entity row only: ``struct(reason, detail)`` or null."""

    def hit(cond, reason, detail):
        return F.when(cond, F.struct(F.lit(reason).alias("reason"), detail.alias("detail")))

    topic = text.excluded_topic(["title", "description"], rules.topics)
    tv = text.broadcaster("title", "description", rules.broadcast_names, rules.broadcast_phrases)
    n_script = text.script_chars("description", rules.script_ranges)
    return F.coalesce(
        text.let(topic, lambda t: hit(t.isNotNull(), "excluded_topic", t)),
        text.let(tv, lambda t: hit(t.isNotNull(), "broadcast_tv", t)),
        hit(text.non_latin("description", ranges=rules.script_ranges), "non_english_description",
            F.concat(n_script.cast("string"), F.lit(" non-Latin script chars in the bio"))),
        geo.location_gate("title", "description", "country", rules.zone),
    )


def _with_metrics(rows: DataFrame, items: DataFrame, as_of: str, rules: Rules, only_open: bool) -> DataFrame:
    """Join the metrics. With ``only_open``, items of entities already rejected are not windowed at all."""
    extra = {}
    if rules.on_terms:
        terms = rules.off_terms if rules.off_categories is None else {c: t for c, t in rules.off_terms.items() if c in rules.off_categories}
        extra = dict(row_columns=metrics.off_target_marks("title", terms, rules.on_terms),
                     aggregates=metrics.off_target_aggregates(terms, F.col("position") <= V.WIDE_WINDOW))
    if "language" in items.columns:
        rows, extra["modes"] = rows.drop("language"), ["language"]
    if only_open:
        items = items.join(rows.where("early is null").select("entity_id"), "entity_id", "left_semi")
    m = metrics.entity_metrics(items, as_of, long_target=rules.min_long, long_pages=rules.long_pages, **extra)
    return rows.join(m, "entity_id", "left")


def own_rules(entities: DataFrame, rules: Rules) -> DataFrame:
    """``entities`` with the outcome of the rules that need the row alone, and without the long text these read."""
    return entities.withColumn("own_rule", _entity_stage(rules)).withColumn("signals", text.persona_signals("description", rules.bio_signals)).drop("description")


def key_rules(judged: DataFrame, suppression: DataFrame | None = None, external: DataFrame | None = None, known: DataFrame | None = None,
              rescued: DataFrame | None = None) -> DataFrame:
    """``own_rules`` rows held against all lists at once; ``early`` is the first rule failed before any item is read."""
    if suppression is external is known is rescued is None:
        none = F.lit(None).cast("string")
        rows = judged.select("*", none.alias("key_hit"), none.alias("mail_hit"), none.alias("tracked_in"), F.lit(False).alias("is_known"), F.lit(False).alias("is_rescued"))
    else:
        rows = judged.join(matching.index_hits(judged, matching.tagged_index(suppression, external, known, rescued)), "entity_id", "left")
    return rows.withColumn("early", F.coalesce(
        _hit(F.col("key_hit").isNotNull(), "blocked", F.col("key_hit")),
        _hit(F.col("tracked_in").isNotNull(), "duplicate", F.col("tracked_in")),
        _hit(F.col("is_known"), "duplicate", F.lit("already tracked in this table")),
        F.col("own_rule")))


def stage_rows(entities: DataFrame, rules: Rules, path: str, **lists: DataFrame | None) -> DataFrame:
    """``key_rules`` of ``entities``, written in two steps under ``path`` and read back.

    The candidates are read once and their texts go no further than the first step: neither folder holds them.
    """
    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}")

    return kept(key_rules(kept(own_rules(entities, rules), "rules"), **lists), "keys")


def _hit(cond: Column, reason: str, detail: Column) -> Column:
    return F.when(cond, F.struct(F.lit(reason).alias("reason"), detail.alias("detail")))


def gate_detail(rules: Rules, item_count: str) -> Column:
    """What the hard gate saw: average views, how many settled items clear the floor, item count and language."""
    floor = rules.gate.get("floor", V.MIN_VIEWS_PER_ITEM)
    settled = F.coalesce(F.col("settled_views"), F.array().cast("array<bigint>"))
    return F.concat(
        F.lit("avg "), F.format_number(F.coalesce("avg_views", F.lit(0.0)), 0), F.lit(" views, "),
        F.size(F.filter(settled, lambda v: v >= floor)).cast("string"), F.lit("/"), F.size(settled).cast("string"), F.lit(f" long-form videos over {floor // 1000}k, "),
        F.coalesce(F.col(item_count).cast("string"), F.lit("None")), F.lit(" videos, lang "), F.coalesce(F.nullif("language", F.lit("")), F.lit("unset")))


def screen(entities: DataFrame, items: DataFrame, rules: Rules, as_of: str, suppression: DataFrame | None = None,
           external: DataFrame | None = None, known: DataFrame | None = None, rescued: DataFrame | None = None,
           stage: str | None = None) -> DataFrame:
    """Run every rule in contract order; the first failing one is the row's ``reason`` (null: passed).

    With a ``stage`` folder what is known before items are read comes from :func:`stage_rows`: the text rules run
    once, only the items of entities still open are windowed, and a lost executor does not send the job back to the texts.

    ``entities``: entity_id, title, handle, description, country, subscribers, published_at, email, links (null: unread),
    item_count (null: unknown; without the column, the items at hand count) and language. Where ``items`` have a language,
    the most frequent one of the newest items is the entity's instead. ``suppression`` rows fail closed. ``external`` is a
    multi-source index, ``known`` a set of ids, ``rescued`` the ids a verdict re-admits past the off-target rule. The
    result has all columns of ``entities`` but the description.
    """
    lists = dict(suppression=suppression, external=external, known=known, rescued=rescued)
    rows = stage_rows(entities, rules, stage, **lists) if stage else key_rules(own_rules(entities, rules), **lists)
    j = _with_metrics(rows, items, as_of, rules, only_open=bool(stage))
    none = F.lit("").alias("detail")
    item_count = "item_count" if "item_count" in entities.columns else "wide_n"
    gate = gates.hard_gate(item_count=item_count, **rules.gate)
    long = gates.longform_gate("long_total", rules.min_long)
    later = [_hit(F.col("wide_n").isNull(), "unreachable", none)]
    if rules.on_terms:
        off = metrics.off_target_verdict(F.col("signals"), rules.off_categories is not None, rules.off_min_share)
        later.append(F.when(~F.coalesce("is_rescued", F.lit(False)), off))
    later += [
        F.when(gate.isNotNull(), F.struct(gate.alias("reason"), gate_detail(rules, item_count).alias("detail"))),
        F.when(long.isNotNull(), F.struct(long.alias("reason"), F.concat(F.col("long_total").cast("string"), F.lit(" confirmed long-form videos")).alias("detail"))),
    ]
    # Rules after the daily budget check; see ``budgets.apply_headroom``.
    last = [
        _hit(links.no_presence("links").isNotNull(), "no_social_presence", none),
        _hit(F.col("mail_hit").isNotNull(), "blocked", F.col("mail_hit")),
    ]
    scored = j.withColumn("gated", F.coalesce("early", *later)).withColumn("verdict", F.coalesce("gated", *last)).withColumn("risk", scoring.fake_follower_risk("subscribers", "avg_views", "engagement_rate"))
    passed = F.col("verdict").isNull()
    kind = shape.qualify(shape.age_months("published_at", as_of), rules.min_age_months)
    own = [c for c in entities.columns if c not in ("description", "language")]
    return scored.select(
        *own, "language", F.col("verdict.reason").alias("reason"), F.col("verdict.detail").alias("detail"),
        "avg_views", "engagement_rate", "per_month", "per_year", "days_since", "long_total", "settled_items",
        F.when(passed, F.col("risk")).alias("risk"),
        F.when(passed, scoring.overall_score("subscribers", "avg_views", "engagement_rate", "per_month", "risk")).alias("score"),
        F.when(passed, kind).alias("qualification"), F.when(F.col("gated").isNull(), kind).alias("bucket"),
    )


def audit(tracked: DataFrame, items: DataFrame, rules: Rules, as_of: str, stage: str | None = None) -> DataFrame:
    """Re-screen published rows by the gates alone: verdict, detail and whether the row may be deleted."""
    only_gates = Rules(**{**rules.__dict__, "on_terms": []})
    s = screen(tracked, items, only_gates, as_of, stage=stage)
    late = F.col("reason").isin("no_social_presence", "blocked")
    verdict = F.when(F.col("reason").isNull() | late, F.lit("pass")).otherwise(F.col("reason"))
    r = s.withColumn("verdict", verdict)
    return r.select("entity_id", "title", "status", "verdict", F.when(F.col("verdict") != "pass", F.col("detail")).otherwise("").alias("detail"),
                    gates.deletable("verdict", "status").alias("deletable"))


def audit_counts(audited: DataFrame) -> DataFrame:
    """Rows per verdict, how many may be deleted and how many fail but are locked by their status."""
    failing = ~F.col("verdict").isin("pass", "unreachable")
    return audited.groupBy("verdict").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("deletable").alias("deletable"), F.count_if(failing & ~F.col("deletable")).alias("locked"))


def drop_report(screened: DataFrame) -> DataFrame:
    return reports.drop_counts(screened.where("reason is not null"))
