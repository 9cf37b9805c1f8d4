"""Registered queries: the whole screen and the re-audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import budgets
from ..session import scratch_dir
from ..sources import bindings as B, sinks, tables
from . import screening
from .joins_catalog import with_email
from .metrics_catalog import AS_OF, REUPLOADS
from .registry import query
from .rows_catalog import ACCENTS, LOCATION_SQL, TV_NAMES, SCORE_SQL, _RISK, _non_latin_sql
from .sql_bindings import days, fold, fold_name, lit, strip, with_, word

TOPICS = {"alpha": ["hetion", "inble"], "beta": ["ingre"]}
OFF = {"rush": ["urgent"], "vague": ["not spec"]}
ON = ["high", "medium"]
SIGNALS = ["ention", "étion"]
RULES = screening.Rules(
    zone=B.ZONE, topics=TOPICS, broadcast_names=TV_NAMES + ["bbc"], broadcast_phrases=["estion"], script_ranges=ACCENTS, off_terms=OFF, on_terms=ON,
    off_min_share=0.45, bio_signals=SIGNALS, gate=dict(min_avg_views=200_000.0, min_items=5, floor=150_000, ratio=0.5, min_per_year=1.2, max_days=900), min_long=4, long_pages=1, min_age_months=75.0)


#: The language tag of an item by its key; some are blank or unknown, and many entities tie.
TAGS = ["en", "en-GB", "en", "de", "", None, "en", "fr"]


def tagged_items(s, d):
    return B.items(s, d).withColumn("language", F.element_at(F.array(*[F.lit(t) for t in TAGS]), (F.col("item_id") % len(TAGS) + 1).cast("int")))


def candidates(s, d):
    """Entities with a bio, a contact address, read or unread links, a first date and a declared item count, which some do not tell."""
    bio = B.documents(s, d).select(F.col("item_id").alias("entity_id"), F.col("placed_text").alias("description"))
    first = B.plain_items(s, d).groupBy("entity_id").agg(F.min("published_at").alias("published_at"), F.count(F.lit(1)).alias("item_count"))
    e = with_email(s, d).withColumn("title", F.col("full_title"))
    links = F.when(F.col("balance") < 200, F.array().cast("array<string>")).when(F.col("balance") < 5000, F.array("handle"))
    return (
        e.withColumn("links", links).select("entity_id", "title", "handle", "country", "subscribers", "niche", "email", "links", "balance")
        .join(bio, "entity_id", "left").join(first, "entity_id", "left").withColumn("item_count", F.when(F.col("entity_id") % 10 != 0, F.col("item_count"))).withColumn("status", F.when(F.col("balance") < 6000, "New").otherwise("Approved"))
    )


def screened(s, d):
    c = candidates(s, d)
    return screening.screen(
        c, tagged_items(s, d), RULES, B.ITEMS_AS_OF, B.suppression_rows(s, d),
        tables.multi_source_index(B.external_tables(s, d)[2:] + B.external_tables(s, d)[1:2]).where("not (kind = 'handle' and key < 'customer_000000700')"),
        B.entities(s, d).where("balance < -500").select("entity_id"), B.entities(s, d).where("niche = 'MACHINERY'").select("entity_id"), scratch_dir(s, "screen-stage"))


_HAS = lambda terms: "(" + " OR ".join(f"contains(lower(title), {lit(t)})" for t in terms) + ")"
_OFFANY = " OR ".join(_HAS(t) for t in OFF.values())
_CATS = "array_to_string(list_filter([" + ", ".join(f"CASE WHEN bool_or({_HAS(OFF[c])}) THEN {lit(c)} END" for c in sorted(OFF)) + "], lambda x: x IS NOT NULL), '/')"
_SIG = "list_filter([" + ", ".join(lit(x) for x in SIGNALS) + "], lambda s: contains(lower(coalesce(description, '')), s))[1:2]"
_TOPIC = "CASE " + " ".join(f"WHEN regexp_matches(title || ' ' || coalesce(description, ''), {word(t)}) THEN {lit(c)}" for c, t in TOPICS.items()) + " END"
_TV = f"CASE WHEN regexp_matches(title, {word(TV_NAMES + ["bbc"])}) THEN 'broadcast_tv_name' WHEN regexp_matches(title || ' ' || coalesce(description, ''), {word(['estion'])}) THEN 'broadcast_tv_phrase' END"
_NSCR = r"length(regexp_replace(coalesce(description, ''), '[^\x{00C0}-\x{00FF}]', '', 'g'))"
_GATE = """CASE WHEN all_short THEN 'shorts_only' WHEN NOT coalesce(lang LIKE 'en%', FALSE) THEN 'not_english' WHEN item_count < 5 THEN 'too_few_videos' WHEN avg_views < 200000 THEN 'below_view_minimum'
  WHEN settled_n >= 5 AND hits < ceil(0.5 * settled_n) THEN 'video_below_view_minimum' WHEN per_year < 1.2 THEN 'upload_cadence_too_low' WHEN days_since > 900 THEN 'stale_channel' WHEN subscribers < 100 AND avg_views < 100 THEN 'dead_channel' END"""
_SAW = """'avg ' || format('{:,}', CAST(round_even(coalesce(avg_views, 0), 0) AS BIGINT)) || ' views, ' || hits || '/' || settled_n || ' long-form videos over 150k, ' || coalesce(CAST(item_count AS VARCHAR), 'None') || ' videos, lang ' || coalesce(lang, 'unset')"""
_BASE = f"""{REUPLOADS.replace('count_if(views >= 200000) AS hits', 'count_if(views >= 150000) AS hits')}, {LOCATION_SQL},
  cand AS (SELECT ent.entity_id, full_title AS title, handle, country, subscribers, niche, balance, placed_text AS description, CASE WHEN balance < 200 THEN TRUE ELSE FALSE END AS no_links, CASE WHEN balance < 6000 THEN 'New' ELSE 'Approved' END AS status,
    (SELECT min(o_orderdate) FROM orders WHERE o_custkey = ent.entity_id) AS d_first, CASE WHEN ent.entity_id % 10 <> 0 THEN cnt END AS item_count
    FROM ent LEFT JOIN doc ON doc.item_id = ent.entity_id LEFT JOIN (SELECT o_custkey, count(*) AS cnt FROM orders GROUP BY 1) ON o_custkey = ent.entity_id),
  tags AS (SELECT entity_id, lang FROM (SELECT entity_id, lang, row_number() OVER (PARTITION BY entity_id ORDER BY count(*) DESC, min(position)) AS rn
    FROM (SELECT entity_id, position, list_extract([{", ".join("NULL" if t is None else lit(t) for t in TAGS)}], item_id % {len(TAGS)} + 1) AS lang FROM pos WHERE position <= 50) WHERE lang <> '' GROUP BY 1, 2) WHERE rn = 1),
  lngc AS (SELECT entity_id, CASE WHEN p0 >= 4 THEN p0 ELSE p0 + p1 END AS long_total FROM (SELECT entity_id, count_if(position <= 50 AND short = FALSE) AS p0, count_if(position > 50 AND short = FALSE) AS p1 FROM (SELECT entity_id, position, CASE WHEN w > 0 AND h > 0 AND CAST(w AS DOUBLE) / h <= 0.95 THEN TRUE ELSE seconds <= 180 END AS short FROM pos WHERE position <= 100) GROUP BY 1)),
  base AS (SELECT cand.*, lang, met.* EXCLUDE (entity_id), long_total, loc.reason AS loc_reason, loc.detail AS loc_detail, {_TOPIC} AS topic, {_TV} AS tv, {_non_latin_sql("coalesce(description, '')")} AS foreign_bio, {_NSCR} AS n_script, {_GATE} AS gate, {_SAW} AS saw
    FROM cand LEFT JOIN met USING (entity_id) LEFT JOIN tags USING (entity_id) LEFT JOIN lngc USING (entity_id) LEFT JOIN loc USING (entity_id))"""
_SCREEN = _BASE + f""",
  k1 AS (SELECT entity_id, arg_min(detail, rank) AS key_hit FROM (SELECT entity_id, 'handle' AS kind, 0 AS rank, handle AS key, 'handle @' || handle AS detail FROM cand UNION ALL SELECT entity_id, 'name', 2, {fold(strip('title'))}, 'name ''' || title || '''' FROM cand) JOIN supkey USING (kind, key) GROUP BY 1),
  k2 AS (SELECT entity_id, 'email ' || key AS mail_hit FROM (SELECT entity_id, 'supplier.' || lpad(CAST(entity_id AS VARCHAR), 9, '0') || '@mail.example.com' AS key FROM cand WHERE niche <> 'FURNITURE') JOIN supkey USING (key) WHERE kind = 'email'),
  ext2 AS (SELECT kind, key, arg_min(source, rk) AS source FROM (SELECT 'name' AS kind, 'customer#' || lpad(CAST(n_nationkey AS VARCHAR), 9, '0') AS key, 'Outreach West' AS source, 0 AS rk FROM nation
    UNION ALL SELECT 'handle', 'customer_' || lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 'Leads South', 1 FROM customer WHERE c_acctbal > 8000 AND 'customer_' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') >= 'customer_000000700'
    UNION ALL SELECT 'name', lower(c_name), 'Leads South', 1 FROM customer WHERE c_acctbal > 8000) GROUP BY 1, 2),
  k3 AS (SELECT entity_id, arg_min(source, rank) AS tracked_in FROM (SELECT entity_id, 'handle' AS kind, 0 AS rank, handle AS key FROM cand UNION ALL SELECT entity_id, 'name', 2, {fold_name('title')} FROM cand) JOIN ext2 USING (kind, key) GROUP BY 1),
  ofs AS (SELECT entity_id, count(*) AS nt, count_if({_OFFANY}) AS off, count_if({_HAS(ON)}) AS on_, {_CATS} AS cats FROM pos WHERE position <= 50 AND trim(title) <> '' GROUP BY 1),
  scr AS (SELECT base.*, key_hit, mail_hit, tracked_in, nt, off, on_, cats, {_SIG} AS sig, CAST(CAST(round(CAST(off AS DOUBLE) / nt * 100, 0) AS BIGINT) AS VARCHAR) || '% of ' || nt || ' recent titles are ' || cats || ' vs ' || CAST(CAST(round(CAST(on_ AS DOUBLE) / nt * 100, 0) AS BIGINT) AS VARCHAR) || '% on-niche' AS dt
    FROM base LEFT JOIN k1 USING (entity_id) LEFT JOIN k2 USING (entity_id) LEFT JOIN k3 USING (entity_id) LEFT JOIN ofs USING (entity_id)),
  done AS (SELECT *, CASE WHEN key_hit IS NOT NULL THEN 'blocked' WHEN tracked_in IS NOT NULL THEN 'duplicate' WHEN balance < -500 THEN 'duplicate' WHEN topic IS NOT NULL THEN 'excluded_topic' WHEN tv IS NOT NULL THEN 'broadcast_tv'
    WHEN foreign_bio THEN 'non_english_description' WHEN loc_reason IS NOT NULL THEN loc_reason WHEN wide_n IS NULL THEN 'unreachable' WHEN niche <> 'MACHINERY' AND off > on_ AND (CAST(off AS DOUBLE) / nt >= 0.45 OR len(sig) > 0) THEN 'off_target_niche'
    WHEN gate IS NOT NULL THEN gate WHEN long_total < 4 THEN 'too_few_longform_videos' WHEN no_links THEN 'no_social_presence' WHEN mail_hit IS NOT NULL THEN 'blocked' END AS reason,
   CASE WHEN key_hit IS NOT NULL THEN key_hit WHEN tracked_in IS NOT NULL THEN tracked_in WHEN balance < -500 THEN 'already tracked in this table' WHEN topic IS NOT NULL THEN topic WHEN tv IS NOT NULL THEN tv
    WHEN foreign_bio THEN n_script || ' non-Latin script chars in the bio' WHEN loc_reason IS NOT NULL THEN loc_detail WHEN wide_n IS NULL THEN '' WHEN niche <> 'MACHINERY' AND off > on_ AND CAST(off AS DOUBLE) / nt >= 0.45 THEN dt
    WHEN niche <> 'MACHINERY' AND off > on_ AND len(sig) > 0 THEN dt || '; bio says [' || array_to_string(list_transform(sig, lambda s: '''' || s || ''''), ', ') || ']'
    WHEN gate IS NOT NULL THEN saw WHEN long_total < 4 THEN long_total || ' confirmed long-form videos' WHEN no_links THEN '' WHEN mail_hit IS NOT NULL THEN mail_hit END AS detail FROM scr),
  ranked AS (SELECT *, avg_views / subscribers AS r, engagement_rate AS e, avg_views AS v, per_month AS f FROM done)"""


@query("P18_screen", with_("ent itm pos doc sup supkey", _SCREEN + f""" SELECT entity_id, reason, detail, CASE WHEN reason IS NULL THEN CASE WHEN {days('d_first', AS_OF)} / 30.44 < 75 THEN 'New Channel' ELSE 'Qualified' END END AS qualification,
  CASE WHEN reason IS NULL THEN CAST({_RISK} AS DOUBLE) END AS risk, CASE WHEN reason IS NULL THEN {SCORE_SQL} END AS score FROM ranked""", recursive=True))
def _(s, d):
    return screened(s, d).select("entity_id", "reason", "detail", "qualification", "risk", "score")


_ROOM = {("AUTOMOBILE", "Qualified"): 2, ("AUTOMOBILE", "New Channel"): 1, ("FURNITURE", "Qualified"): 3, ("FURNITURE", "New Channel"): 0, ("MACHINERY", "Qualified"): 1}


@query("P18_screen_with_budget", with_("ent itm pos doc sup supkey", _SCREEN + f""", room(niche, bucket, headroom) AS (VALUES {", ".join(f"({lit(n)}, {lit(b)}, {h})" for (n, b), h in _ROOM.items())}),
  g AS (SELECT *, CASE WHEN reason IS NULL OR reason = 'no_social_presence' OR detail LIKE 'email %' THEN CASE WHEN {days('d_first', AS_OF)} / 30.44 < 75 THEN 'New Channel' ELSE 'Qualified' END END AS bucket FROM done),
  b AS (SELECT g.*, headroom, coalesce(sum(CAST(reason IS NULL AS INT)) OVER (PARTITION BY niche, bucket ORDER BY entity_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g LEFT JOIN room USING (niche, bucket))
  SELECT entity_id, bucket, CASE WHEN bucket IS NOT NULL AND before >= headroom THEN 'no_headroom_for_bucket' ELSE reason END AS reason FROM b""", recursive=True))
def _(s, d):
    sc = screened(s, d)
    rows = F.array(*[F.struct(F.lit(n).alias("niche"), F.lit(b).alias("bucket"), F.lit(h).alias("headroom")) for (n, b), h in _ROOM.items()])
    room = s.range(1).select(F.explode(rows).alias("r")).select("r.*")
    return budgets.apply_headroom(sc, room, ["entity_id"]).select("entity_id", "bucket", "reason")


@query("P18_published", with_("ent itm pos doc sup supkey", _SCREEN + f""" SELECT entity_id, title, subscribers, round(avg_views, 1) AS avg_views, round(engagement_rate, 2) AS engagement_rate,
  CAST(CAST(round_even(per_month, 0) AS BIGINT) AS VARCHAR) || ' videos/month' AS upload_frequency, coalesce(lang, 'Unknown') AS language, CASE WHEN niche = 'FURNITURE' THEN ' ' ELSE ' Supplier.' || lpad(CAST(entity_id AS VARCHAR), 9, '0') || '@mail.example.com' END AS email,
  CAST({_RISK} AS DOUBLE) AS risk, {SCORE_SQL} AS score, CASE WHEN {days('d_first', AS_OF)} / 30.44 < 75 THEN 'New Channel' ELSE 'Qualified' END AS qualification, 'New' AS status, 'discovery ()' AS source, '' AS notes, niche, '2001-08-01' AS date_added, handle
  FROM ranked WHERE reason IS NULL""", recursive=True))
def _(s, d):
    return sinks.published_rows(screened(s, d).where("reason is null"), ["handle"], day="2001-08-01")


@query("P18_screen_report", with_("ent itm pos doc sup supkey", _SCREEN + " SELECT reason, count(*) AS n FROM done WHERE reason IS NOT NULL GROUP BY 1", recursive=True))
def _(s, d):
    return screening.drop_report(screened(s, d))


_AUDIT = _BASE + """, aud AS (SELECT entity_id, status, CASE WHEN topic IS NOT NULL THEN 'excluded_topic' WHEN tv IS NOT NULL THEN 'broadcast_tv' WHEN foreign_bio THEN 'non_english_description' WHEN loc_reason IS NOT NULL THEN loc_reason
  WHEN wide_n IS NULL THEN 'unreachable' WHEN gate IS NOT NULL THEN gate WHEN long_total < 4 THEN 'too_few_longform_videos' ELSE 'pass' END AS verdict,
  CASE WHEN topic IS NOT NULL THEN topic WHEN tv IS NOT NULL THEN tv WHEN foreign_bio THEN n_script || ' non-Latin script chars in the bio' WHEN loc_reason IS NOT NULL THEN loc_detail
  WHEN wide_n IS NULL THEN '' WHEN gate IS NOT NULL THEN saw WHEN long_total < 4 THEN long_total || ' confirmed long-form videos' ELSE '' END AS detail FROM base)"""


@query("A21_audit", with_("ent itm pos doc", _AUDIT + " SELECT entity_id, status, verdict, detail, verdict NOT IN ('pass', 'unreachable') AND status = 'New' AS deletable FROM aud", recursive=True))
def _(s, d):
    return screening.audit(candidates(s, d), tagged_items(s, d), RULES, B.ITEMS_AS_OF, scratch_dir(s, "audit-stage")).select("entity_id", "status", "verdict", "detail", "deletable")


@query("A21_audit_counts", with_("ent itm pos doc", _AUDIT + " SELECT verdict, count(*) AS n, CAST(count_if(verdict NOT IN ('pass', 'unreachable') AND status = 'New') AS BIGINT) AS deletable, CAST(count_if(verdict NOT IN ('pass', 'unreachable') AND status <> 'New') AS BIGINT) AS locked FROM aud GROUP BY 1", recursive=True))
def _(s, d):
    return screening.audit_counts(screening.audit(candidates(s, d), tagged_items(s, d), RULES, B.ITEMS_AS_OF, scratch_dir(s, "audit-stage")))
