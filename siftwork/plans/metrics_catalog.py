"""Registered queries: per-entity metrics, windows and ranked samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as V, links, shape, text
from ..operators import budgets, discovery, gates, matching, metrics, reports, windows
from ..sources import bindings as B
from .registry import query
from .sql_bindings import SHORT, days, emails, lit, lst, norm_title, with_

AS_OF = lit(B.ITEMS_AS_OF)
DOC_ORDER = ["item_id"]
WORD_CONTACT = r"\b(th[a-z]{6,9})\b"
KEYWORDS = ["urgent", "high", "medium p", "low f", "specified o"]
RULES = dict(min_avg_views=235_000.0, min_items=7, floor=200_000, ratio=0.5, min_per_year=1.35, max_days=700)

# ---- oracle pieces --------------------------------------------------------------------------

_SHORT = SHORT.format(180)
REUPLOADS = f""", lng AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY position) AS rn FROM
    (SELECT *, {norm_title('title')} AS norm, {_SHORT} AS short FROM pos WHERE position <= 50) WHERE short = FALSE),
  fold AS (SELECT entity_id, rn, item_id, TRUE AS kept, CASE WHEN norm <> '' AND coalesce(seconds, 0) <> 0 THEN [{{'n': norm, 's': seconds}}] ELSE [] END AS seen FROM lng WHERE rn = 1
    UNION ALL
    SELECT entity_id, rn, item_id, NOT dup, CASE WHEN dup OR norm = '' OR coalesce(seconds, 0) = 0 THEN seen ELSE list_append(seen, {{'n': norm, 's': seconds}}) END FROM
      (SELECT l.entity_id, l.rn, l.item_id, l.norm, l.seconds, f.seen, l.norm <> '' AND coalesce(l.seconds, 0) <> 0 AND len(list_filter(f.seen, lambda k: k.n = l.norm AND abs(k.s - l.seconds) <= 10)) > 0 AS dup
       FROM fold f JOIN lng l ON l.entity_id = f.entity_id AND l.rn = f.rn + 1)),
  smp AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY position) AS k FROM lng JOIN (SELECT entity_id, item_id FROM fold WHERE kept) USING (entity_id, item_id)
    WHERE views IS NOT NULL AND {days('published_at', AS_OF)} >= 14),
  agg AS (SELECT entity_id, CAST(sum(views) AS DOUBLE) / count(*) AS v, CASE WHEN sum(views) > 0 THEN CAST(sum(engagements) AS DOUBLE) / sum(views) * 100 ELSE 0.0 END AS e, min(views) AS lo, count(*) AS n,
    count_if(views >= 200000) AS hits FROM smp WHERE k <= 10 GROUP BY 1),
  raw AS (SELECT entity_id, CAST(sum(coalesce(views, 0)) AS DOUBLE) / count(*) AS v, CASE WHEN sum(coalesce(views, 0)) > 0 THEN CAST(sum(engagements) AS DOUBLE) / sum(coalesce(views, 0)) * 100 ELSE 0.0 END AS e, count(*) AS n,
    count(published_at) AS nd, min(published_at) AS d0, max(published_at) AS d1 FROM pos WHERE position <= 10 GROUP BY 1),
  shp AS (SELECT entity_id, count(*) AS wide_n, bool_and(coalesce({_SHORT}, FALSE)) AS all_short, count_if({_SHORT} = FALSE) AS long_count FROM pos WHERE position <= 50 GROUP BY 1),
  met AS (SELECT raw.entity_id, coalesce(agg.v, raw.v) AS avg_views, CASE WHEN agg.n IS NOT NULL THEN agg.e ELSE raw.e END AS engagement_rate, agg.lo AS min_views, coalesce(agg.n, raw.n) AS sample_size, coalesce(agg.n, 0) AS settled_n, coalesce(agg.hits, 0) AS hits,
    CASE WHEN nd < 2 THEN 0.0 WHEN {days('d0', 'd1')} <= 0 THEN CAST(nd AS DOUBLE) ELSE round(CAST(nd AS DOUBLE) / {days('d0', 'd1')} * 30, 2) END AS per_month,
    CASE WHEN nd >= 2 AND {days('d0', 'd1')} > 0 THEN round(CAST(nd AS DOUBLE) / {days('d0', 'd1')} * 30, 2) * 12 END AS per_year, {days('d1', AS_OF)} AS days_since, all_short, long_count, wide_n
    FROM raw JOIN shp USING (entity_id) LEFT JOIN agg USING (entity_id))"""
GATE = """CASE WHEN all_short THEN 'shorts_only' WHEN NOT coalesce(lang LIKE 'en%', FALSE) THEN 'not_english' WHEN wide_n < 7 THEN 'too_few_videos' WHEN avg_views < 235000 THEN 'below_view_minimum'
  WHEN settled_n >= 5 AND hits < ceil(0.5 * settled_n) THEN 'video_below_view_minimum' WHEN per_year < 1.35 THEN 'upload_cadence_too_low' WHEN days_since > 700 THEN 'stale_channel'
  WHEN subscribers < 100 AND avg_views < 100 THEN 'dead_channel' END"""
GATED = ", gated AS (SELECT e.entity_id, e.niche, e.title, e.subscribers, m.*, " + GATE + " AS reason FROM ent e JOIN (SELECT * RENAME (entity_id AS mid) FROM met) m ON m.mid = e.entity_id LEFT JOIN (SELECT doc_id, lang FROM documents) ON doc_id = e.entity_id)"


def metric_rows(s, d):
    return metrics.entity_metrics(B.items(s, d), B.ITEMS_AS_OF)


def gated_rows(s, d):
    """Entities with metrics, bio language and the hard-gate reason."""
    lang = B.documents(s, d).select(F.col("item_id").alias("entity_id"), F.col("lang").alias("language"))
    e = B.entities(s, d).join(metric_rows(s, d), "entity_id").join(lang, "entity_id", "left")
    return e.withColumn("reason", gates.hard_gate(item_count="wide_n", **RULES))


# ---- A1-A10 ---------------------------------------------------------------------------------

@query("A1_performance", with_("itm pos", REUPLOADS + " SELECT entity_id, round(avg_views, 4) AS avg_views, round(engagement_rate, 6) AS engagement_rate, min_views, sample_size FROM met", recursive=True))
def _(s, d):
    return metric_rows(s, d).select("entity_id", text.rounded("avg_views", 4).alias("avg_views"), text.rounded("engagement_rate", 6).alias("engagement_rate"), "min_views", "sample_size")


@query("A2_dominant", with_("doc", """ SELECT entity_id, lang, n FROM (SELECT entity_id, lang, count(*) AS n, row_number() OVER (PARTITION BY entity_id ORDER BY count(*) DESC, min(item_id)) AS rn
  FROM (SELECT entity_id || '-' || seconds // 500 AS entity_id, item_id, CASE WHEN title LIKE 'Th%' THEN '' ELSE lang END AS lang FROM doc) WHERE lang <> '' GROUP BY 1, 2) WHERE rn = 1"""))
def _(s, d):
    docs = B.documents(s, d)
    tag = F.when(F.col("title").startswith("Th"), "").otherwise(F.col("lang"))
    tagged = docs.select(F.concat_ws("-", "entity_id", F.floor(F.col("seconds") / 500).cast("string")).alias("entity_id"), "item_id", tag.alias("lang"))
    return metrics.dominant(tagged, "lang", "item_id")


_CONTACTS = rf"list_distinct(regexp_extract_all(description, '\b(th[a-z]{{6,9}})\b', 1))"


def _contact_rows(s, d):
    """Documents with their distinct contacts: found before any window, so that no text is shuffled."""
    return B.documents(s, d).select("entity_id", "item_id", F.array_distinct(F.regexp_extract_all("description", F.lit(WORD_CONTACT), 1)).alias("contacts"))


@query("A3_repeated_contact", with_("doc", f""" SELECT entity_id, contact, n AS n_items FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY n DESC, first, contact) AS rn FROM (
  SELECT entity_id, contact, count(*) AS n, min(item_id) AS first FROM (SELECT entity_id, item_id, unnest({_CONTACTS}) AS contact FROM doc WHERE position <= 50) GROUP BY 1, 2 HAVING count(*) >= 8)) WHERE rn = 1"""))
def _(s, d):
    return metrics.repeated_contact(windows.newest_n(_contact_rows(s, d), 50, DOC_ORDER), F.col("contacts"), "item_id", 8)


@query("A3_repeated_email", with_("doc", f""" SELECT entity_id, contact, n AS n_items FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY n DESC, first, contact) AS rn FROM (
  SELECT entity_id, contact, count(*) AS n, min(item_id) AS first FROM (SELECT entity_id, item_id, unnest(list_distinct({emails('description')})) AS contact FROM doc) GROUP BY 1, 2)) WHERE rn = 1"""))
def _(s, d):
    return metrics.repeated_contact(B.documents(s, d), links.emails("description"), "item_id", 1)


_SHAPE = with_("doc", f""" SELECT entity_id, bool_and(coalesce(s, FALSE)) AS all_short, count_if(s = FALSE)::BIGINT AS n_long, count(*) AS n FROM (
  SELECT entity_id || '-' || lang AS entity_id, {SHORT.format(5000)} AS s FROM doc) GROUP BY 1""")


def _shape(s, d):
    docs = B.documents(s, d).select(F.concat_ws("-", "entity_id", "lang").alias("entity_id"), shape.is_short("seconds", "w", "h", 5000).alias("s"))
    return metrics.shape_summary(docs, F.col("s"))


@query("A4_all_short", f"SELECT entity_id, all_short FROM ({_SHAPE})")
def _(s, d):
    return _shape(s, d).select("entity_id", "all_short")


@query("A5_count_long", f"SELECT entity_id, n_long, n FROM ({_SHAPE})")
def _(s, d):
    return _shape(s, d).select("entity_id", "n_long", "n")


def _cadence_sql(cols):
    return f"""SELECT entity_id, {cols} FROM (SELECT o_custkey AS entity_id, count(*) AS nd, min(o_orderdate) AS d0, max(o_orderdate) AS d1 FROM (
      SELECT o_custkey, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 10 GROUP BY 1)"""


@query("A6_upload_frequency", _cadence_sql(f"CASE WHEN nd < 2 THEN 0.0::DOUBLE WHEN {days('d0', 'd1')} <= 0 THEN CAST(nd AS DOUBLE) ELSE round(CAST(nd AS DOUBLE) / {days('d0', 'd1')} * 30, 2) END AS per_month"))
def _(s, d):
    return metrics.cadence(B.plain_items(s, d), B.ITEMS_AS_OF).select("entity_id", "per_month")


@query("A7_uploads_per_year", _cadence_sql(f"round(CASE WHEN nd >= 2 AND {days('d0', 'd1')} > 0 THEN round(CAST(nd AS DOUBLE) / {days('d0', 'd1')} * 30, 2) * 12 END, 4) AS per_year"))
def _(s, d):
    return metrics.cadence(B.plain_items(s, d), B.ITEMS_AS_OF).select("entity_id", text.rounded("per_year", 4).alias("per_year"))


@query("A8_days_since_last", _cadence_sql(f"{days('d1', AS_OF)} AS days_since"))
def _(s, d):
    return metrics.cadence(B.plain_items(s, d), B.ITEMS_AS_OF).select("entity_id", "days_since")


@query("A9_clears_ratio", with_("itm pos", REUPLOADS + " SELECT entity_id, settled_n < 5 OR hits >= ceil(0.5 * settled_n) AS clears FROM met", recursive=True))
def _(s, d):
    return metric_rows(s, d).select("entity_id", metrics.clears_ratio(F.col("settled_views"), 200_000, 0.5).alias("clears"))


OFF_TERMS = {"gadgets": ["thnt", "eron"], "games": ["anea", "von "], "recap": ["les ", "ê"]}
ON_TERMS = ["was", "attion", "der "]


def _has(terms):
    return "(" + " OR ".join(f"contains(lower(title), {lit(t)})" for t in terms) + ")"


_OFF_CATS = "array_to_string(list_filter([" + ", ".join(f"CASE WHEN bool_or({_has(OFF_TERMS[c])}) THEN {lit(c)} END" for c in sorted(OFF_TERMS)) + "], lambda x: x IS NOT NULL), '/')"
OFF_SQL = f"""shr AS (SELECT entity_id, count(*) AS nt, count_if({' OR '.join(_has(t) for t in OFF_TERMS.values())}) AS off, count_if({_has(ON_TERMS)}) AS on_, {_OFF_CATS} AS cats,
  array_to_string(list_filter({lst(['thon', 'étion', 'nding'])}, lambda s: contains(any_value(bio), s))[1:2], ', ') AS sig FROM (
   SELECT entity_id || '-' || lang AS entity_id, title, lower(lang || ' thonx') AS bio, row_number() OVER (PARTITION BY entity_id || '-' || lang ORDER BY item_id) AS p FROM doc) WHERE p <= 50 AND trim(title) <> '' GROUP BY 1)"""


@query("A10_off_target", with_("doc", ", " + OFF_SQL + """ SELECT entity_id, CASE WHEN off > on_ AND CAST(off AS DOUBLE) / nt >= 0.30 THEN 'off_target_niche' WHEN off > on_ AND sig <> '' THEN 'off_target_niche' END AS reason,
  CASE WHEN off > on_ AND CAST(off AS DOUBLE) / nt >= 0.30 THEN dt WHEN off > on_ AND sig <> '' THEN dt || '; bio says [''' || sig || ''']' END AS detail FROM (
  SELECT *, CAST(CAST(round(CAST(off AS DOUBLE) / nt * 100, 0) AS BIGINT) AS VARCHAR) || '% of ' || nt || ' recent titles are ' || cats || ' vs ' || CAST(CAST(round(CAST(on_ AS DOUBLE) / nt * 100, 0) AS BIGINT) AS VARCHAR) || '% on-niche' AS dt FROM shr)"""))
def _(s, d):
    docs = B.documents(s, d).select(F.concat_ws("-", "entity_id", "lang").alias("entity_id"), "item_id", "title")
    shares = metrics.off_target_shares(windows.newest_n(docs, 50, DOC_ORDER), OFF_TERMS, ON_TERMS)
    signals = text.persona_signals(F.concat(F.col("entity_id"), F.lit(" thonx")), ["thon", "étion", "nding"])
    v = shares.select("entity_id", metrics.off_target_verdict(signals, min_share=0.30).alias("v"))
    return v.select("entity_id", "v.reason", "v.detail")


# ---- gates over metrics ---------------------------------------------------------------------

@query("P5_hard_gate", with_("ent itm pos", REUPLOADS + GATED + " SELECT entity_id, reason FROM gated", recursive=True))
def _(s, d):
    return gated_rows(s, d).select("entity_id", "reason")


@query("A13_drop_counts", with_("ent itm pos", REUPLOADS + GATED + " SELECT coalesce(reason, 'unknown') AS reason, count(*) AS n FROM gated GROUP BY 1", recursive=True))
def _(s, d):
    return reports.drop_counts(gated_rows(s, d))


# ---- windows --------------------------------------------------------------------------------

@query("W1_newest_n", "SELECT entity_id, item_id, CAST(rn AS INTEGER) AS position FROM (SELECT o_custkey AS entity_id, o_orderkey AS item_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 10")
def _(s, d):
    return windows.newest_n(B.plain_items(s, d).select("entity_id", "item_id", "published_at"), 10).drop("published_at")


@query("W1_newest_n_wide", with_("doc", " SELECT entity_id, item_id, CAST(position AS INTEGER) AS position FROM doc WHERE position <= 50"))
def _(s, d):
    return windows.newest_n(B.documents(s, d).select("entity_id", "item_id"), 50, DOC_ORDER)


@query("W2_newest_n_where", with_("itm", f""" SELECT entity_id, item_id, views FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY published_at DESC, item_id) AS rn FROM itm
  WHERE ({_SHORT}) = FALSE AND views IS NOT NULL AND {days('published_at', AS_OF)} >= 14) WHERE rn <= 10"""))
def _(s, d):
    pred = ~shape.is_short("seconds", "w", "h") & F.col("views").isNotNull() & shape.settled("published_at", B.ITEMS_AS_OF)
    return windows.newest_n_where(B.items(s, d), pred, 10).select("entity_id", "item_id", "views")


@query("W3_drop_reuploads", with_("itm", f""", k AS (SELECT *, {norm_title('title')} AS norm, coalesce(seconds, 0) <> 0 AS cmp FROM itm), l AS (SELECT *, row_number() OVER (PARTITION BY entity_id, norm ORDER BY item_id) AS rn FROM k WHERE cmp AND norm <> ''),
  fold AS (SELECT entity_id, norm, rn, item_id, TRUE AS kept, [seconds] AS seen FROM l WHERE rn = 1 UNION ALL
   SELECT entity_id, norm, rn, item_id, NOT dup, CASE WHEN dup THEN seen ELSE list_append(seen, seconds) END FROM (SELECT l.entity_id, l.norm, l.rn, l.item_id, l.seconds, f.seen, len(list_filter(f.seen, lambda x: abs(x - l.seconds) <= 60)) > 0 AS dup
    FROM fold f JOIN l ON l.entity_id = f.entity_id AND l.norm = f.norm AND l.rn = f.rn + 1))
  SELECT entity_id, item_id FROM fold WHERE kept UNION ALL SELECT entity_id, item_id FROM k WHERE NOT cmp OR norm = ''""", recursive=True))
def _(s, d):
    return windows.drop_reuploads(B.items(s, d), 60)


@query("W3_drop_reuploads_text", with_("doc", f""", k AS (SELECT *, {norm_title('title')} AS norm, coalesce(seconds, 0) <> 0 AS cmp FROM doc), l AS (SELECT *, row_number() OVER (PARTITION BY entity_id, norm ORDER BY item_id) AS rn FROM k WHERE cmp AND norm <> ''),
  fold AS (SELECT entity_id, norm, rn, item_id, TRUE AS kept, [seconds] AS seen FROM l WHERE rn = 1 UNION ALL
   SELECT entity_id, norm, rn, item_id, NOT dup, CASE WHEN dup THEN seen ELSE list_append(seen, seconds) END FROM (SELECT l.entity_id, l.norm, l.rn, l.item_id, l.seconds, f.seen, len(list_filter(f.seen, lambda x: abs(x - l.seconds) <= 10)) > 0 AS dup
    FROM fold f JOIN l ON l.entity_id = f.entity_id AND l.norm = f.norm AND l.rn = f.rn + 1))
  SELECT entity_id, item_id FROM fold WHERE kept UNION ALL SELECT entity_id, item_id FROM k WHERE NOT cmp OR norm = ''""", recursive=True))
def _(s, d):
    return windows.drop_reuploads(B.documents(s, d))


@query("W8_representative", with_("itm", f""" SELECT entity_id, item_id, views, seconds FROM (SELECT *, count(*) OVER (PARTITION BY entity_id) AS n, row_number() OVER (PARTITION BY entity_id ORDER BY views, rn) AS r FROM (
  SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY published_at DESC, item_id) AS rn FROM itm WHERE ({_SHORT}) = FALSE AND views IS NOT NULL AND {days('published_at', AS_OF)} >= 14) WHERE rn <= 10 AND coalesce(seconds, 0) <> 0) WHERE r = n // 2 + 1"""))
def _(s, d):
    pred = ~shape.is_short("seconds", "w", "h") & F.col("views").isNotNull() & shape.settled("published_at", B.ITEMS_AS_OF)
    return windows.representative(windows.newest_n_where(B.items(s, d), pred, 10))


def _deep_sql(contacts, size, pages, least, more=""):
    return with_("doc", f""", h AS (SELECT entity_id, position, (position - 1) // {size} AS page, unnest(list_distinct({contacts})) AS contact FROM doc WHERE position <= {size * (pages + 1)}{more}),
      r AS (SELECT *, row_number() OVER (PARTITION BY entity_id, contact ORDER BY position) AS rn FROM h), p AS (SELECT entity_id, min(page) AS found_page FROM r WHERE rn = {least} GROUP BY 1),
      c AS (SELECT entity_id, found_page, contact, count(*) AS n, min(position) AS first FROM h JOIN p USING (entity_id) WHERE page <= found_page GROUP BY 1, 2, 3 HAVING count(*) >= {least})
      SELECT entity_id, contact, n AS n_items, found_page FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY n DESC, first, contact) AS rn FROM c) WHERE rn = 1""")


@query("W10_deep_scan", _deep_sql(_CONTACTS, 10, 4, 8, " AND entity_id NOT IN (SELECT entity_id FROM (SELECT entity_id, unnest(" + _CONTACTS + ") AS c FROM doc WHERE position <= 10) GROUP BY entity_id, c HAVING count(*) >= 6)"))
def _(s, d):
    docs = _contact_rows(s, d)
    first = metrics.repeated_contact(windows.newest_n(docs, 10, DOC_ORDER), F.col("contacts"), "item_id", 6)
    return windows.deep_scan(docs, F.col("contacts"), first, page_size=10, pages=4, min_items=8, order=DOC_ORDER)


@query("W11_bounded_long_count", with_("doc", f""", g AS (SELECT entity_id, (position - 1) // 10 AS page, count_if({SHORT.format(1500)} = FALSE) AS n FROM doc WHERE position <= 40 GROUP BY 1, 2),
  c AS (SELECT entity_id, page, CAST(sum(n) OVER (PARTITION BY entity_id ORDER BY page) AS BIGINT) AS total FROM g)
  SELECT entity_id, arg_min(total, CASE WHEN total >= 9 THEN page ELSE 100 - page END) AS long_count, coalesce(min(page) FILTER (total >= 9), max(page)) + 1 AS pages_read FROM c GROUP BY 1"""))
def _(s, d):
    docs = B.documents(s, d).select("entity_id", "item_id", "seconds", "w", "h")
    return windows.bounded_long_count(docs, shape.is_short("seconds", "w", "h", 1500), target=9, page_size=10, pages=3, order=DOC_ORDER)


# ---- discovery ------------------------------------------------------------------------------

_HITS = f"""hits AS (SELECT idx, keyword, entity_id, min(rn) AS rank, arg_min(title, rn) AS title FROM (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY published_at DESC, item_id) AS rn FROM (
  SELECT o_custkey AS entity_id, o_orderkey AS item_id, o_orderdate AS published_at, o_orderpriority || ' ' || o_orderstatus AS title, k.idx, k.keyword FROM orders
  JOIN (SELECT unnest(range({len(KEYWORDS)})) AS idx, unnest({lst(KEYWORDS)}) AS keyword) k ON contains(lower(o_orderpriority || ' ' || o_orderstatus), k.keyword)
  WHERE o_orderdate >= TIMESTAMP '{B.ITEMS_AS_OF}' - INTERVAL 365 DAY AND o_orderdate <= TIMESTAMP '{B.ITEMS_AS_OF}')) WHERE rn <= 120 GROUP BY 1, 2, 3)"""


def _hits(s, d):
    return discovery.search_recent(B.plain_items(s, d).select("entity_id", "item_id", "published_at", "title"), KEYWORDS, B.ITEMS_AS_OF, 365, 120)


@query("S7_search_recent", f"WITH {_HITS} SELECT keyword, entity_id, CAST(rank AS INTEGER) AS rank, title FROM hits")
def _(s, d):
    return _hits(s, d).select("keyword", "entity_id", "rank", "title")


@query("A20_merge_keywords", f"WITH {_HITS} SELECT entity_id, string_agg(keyword, '|' ORDER BY keyword) AS keywords, arg_min(title, idx * 100000 + rank) AS title FROM hits GROUP BY 1")
def _(s, d):
    return discovery.merge_keywords(_hits(s, d)).select("entity_id", F.array_join("matched_keywords", "|").alias("keywords"), "title")


@query("W6_early_stop", f"""WITH {_HITS}, f AS (SELECT entity_id, min(idx) AS idx FROM hits WHERE entity_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 2000) GROUP BY 1),
  p AS (SELECT k.idx, k.keyword, count(f.entity_id) AS fresh FROM (SELECT unnest(range({len(KEYWORDS)})) AS idx, unnest({lst(KEYWORDS)}) AS keyword) k LEFT JOIN f USING (idx) GROUP BY 1, 2),
  r AS (SELECT *, CAST(sum(fresh) OVER (ORDER BY idx) AS BIGINT) AS banked FROM p) SELECT keyword, fresh, banked, banked - fresh < 200 AS searched FROM r""")
def _(s, d):
    seen = B.entities(s, d).where("balance < 2000").select("entity_id")
    return discovery.early_stop(_hits(s, d), KEYWORDS, 200, seen).drop("idx")


@query("A23_query_union", f"""WITH {_HITS}, f AS (SELECT entity_id, min(idx) AS idx FROM hits GROUP BY 1), p AS (SELECT k.idx, k.keyword, (SELECT count(DISTINCT entity_id) FROM hits h WHERE h.idx = k.idx) AS fetched, (SELECT count(*) FROM f WHERE f.idx = k.idx) AS new
  FROM (SELECT unnest(range({len(KEYWORDS)})) AS idx, unnest({lst(KEYWORDS)}) AS keyword) k)
  SELECT keyword, fetched, new, u AS "union", round((CAST(u AS DOUBLE) / first_value(fetched) OVER (ORDER BY idx) - 1) * 100, 2) AS gain_pct FROM (SELECT *, CAST(sum(new) OVER (ORDER BY idx) AS BIGINT) AS u FROM p)""")
def _(s, d):
    return discovery.query_union(_hits(s, d), KEYWORDS).drop("idx")


# ---- sources that need metrics --------------------------------------------------------------

@query("J6_items_by_order", with_("itm", """ SELECT o.entity_id, o.item_id, CAST(o.position AS INTEGER) AS position, i.engagements, i.seconds FROM (SELECT o_custkey AS entity_id, o_orderkey AS item_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS position FROM orders) o
  JOIN itm i USING (item_id) WHERE o.position <= 50 AND i.seconds IS NOT NULL"""))
def _(s, d):
    order = windows.newest_n(B.plain_items(s, d).select("entity_id", "item_id", "published_at"), 50).select("entity_id", "item_id", "position")
    facts = B.table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("item_id")).agg(
        F.sum("l_quantity").cast("bigint").alias("engagements"), (F.sum("l_quantity") * 10).cast("bigint").alias("seconds"))
    return matching.items_by_order(order, facts)


@query("W13_run_budget", f"""SELECT address, entity_id, requested_at FROM (SELECT 'c' || (o_custkey % 200) || '@mail.example' AS address, o_orderkey AS entity_id, strftime(o_orderdate, '%Y-%m-%d') AS requested_at,
  row_number() OVER (PARTITION BY o_custkey % 200 ORDER BY strftime(o_orderdate, '%Y-%m-%d'), o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'F') WHERE rn = 1 ORDER BY requested_at, entity_id LIMIT {V.SEND_DAILY_CAP}""")
def _(s, d):
    q = B.table(s, d, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("entity_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("requested_at"),
        F.concat(F.lit(" C"), F.col("o_custkey") % 200, F.lit("@Mail.example")).alias("email"))
    return budgets.run_budget(q, text.fold_case(text.strip("email")), ["requested_at", "entity_id"], V.SEND_DAILY_CAP).select("address", "entity_id", "requested_at")

