"""Registered queries: scalar functions and row predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as V, geo, links, scoring, shape, text, verdicts
from ..operators import gates, windows
from ..sources import bindings as B, tables
from .registry import query
from .sql_bindings import SHORT, days, emails, fold_name, half_up, ins, lit, local_day, lst, mapping, norm_handle, norm_title, strip, with_, word

TOPICS = {"alpha": ["anble", "thst ed", "inble"], "beta": ["ention", "ingre"], "gamma": ["étion", "ersch", "ément"]}
TV_NAMES = ["anea", "thnt", "von"]
TV_PHRASES = ["of the", "estion", "der die"]
BIO_SIGNALS = ["ating ", "étion", "nding", "thintion"]
ACCENTS = [(0x00C0, 0x00FF)]
MAIL_DOMAINS = ["mail2.example.com", "mail5.example.com"]
PAGE_HOSTS = ["blog.tionsh.example.net", "thther.example.org", "m.ththth.example.net", "cheap-pills.example.com"]
ALL_COUNTRIES = {**V.INSIDE_COUNTRY_NAMES, **V.OUTSIDE_COUNTRY_NAMES}


FOLD_COUNTRY_SQL = f"trim(regexp_replace(replace(lower({strip('country')}), ',', ' '), '\\s+', ' ', 'g'))"


def _doc(s, d):
    return B.documents(s, d)


# ---- text -----------------------------------------------------------------------------------

@query("F1_normalize_handle", f"SELECT doc_id, {norm_handle('text')} AS handle FROM documents")
def _(s, d):
    return _doc(s, d).select(F.col("item_id").alias("doc_id"), text.normalize_handle("description").alias("handle"))


@query("F2_handle_key", with_("ent", f""" SELECT entity_id, CASE WHEN {norm_handle('raw')} <> '' THEN {norm_handle('raw')}
  ELSE lower(regexp_replace({strip('raw')}, '^@+', '')) END AS key FROM (SELECT entity_id,
  CASE niche WHEN 'BUILDING' THEN 'https://video.example/@' || title || '/videos' WHEN 'MACHINERY' THEN ' @' || handle WHEN 'FURNITURE' THEN title || ' ' ELSE '@@' END AS raw FROM ent)"""))
def _(s, d):
    raw = (F.when(F.col("niche") == "BUILDING", F.concat(F.lit("https://video.example/@"), "title", F.lit("/videos")))
           .when(F.col("niche") == "MACHINERY", F.concat(F.lit(" @"), "handle")).when(F.col("niche") == "FURNITURE", F.concat("title", F.lit(" "))).otherwise("@@"))
    return B.entities(s, d).select("entity_id", text.handle_key(raw).alias("key"))


@query("F3_normalize_title", with_("doc", f" SELECT item_id, {norm_title('title')} AS norm FROM doc"))
def _(s, d):
    return _doc(s, d).select("item_id", text.normalize_title("title").alias("norm"))


@query("F4_fold_name", with_("ent", f" SELECT entity_id, {fold_name('full_title')} AS name FROM ent"))
def _(s, d):
    return B.entities(s, d).select("entity_id", text.fold_name("full_title").alias("name"))


@query("F5_fold_country", with_("ent", f" SELECT DISTINCT country, {FOLD_COUNTRY_SQL} AS name FROM ent"))
def _(s, d):
    return B.entities(s, d).select("country", text.fold_country("country").alias("name")).distinct()


@query("F9_as_int", "SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN CAST(json_extract_string(props, '$.k') AS BIGINT) ELSE 0 END AS k FROM events")
def _(s, d):
    raw = F.when(F.col("event_type") == "click", F.get_json_object("props", "$.k")).when(
        F.col("event_type") == "view", F.concat(F.lit(" +"), F.get_json_object("props", "$.k"))).when(
        F.col("event_type") == "error", F.concat(F.get_json_object("props", "$.k"), F.lit(".5"))).when(F.col("event_type") == "signup", "abc")
    return B.events(s, d).select("event_id", text.as_int(raw).alias("k"))


@query("F19_csv_safe", rf"""SELECT doc_id, CASE WHEN left(raw, 1) IN ('=', '+', '-', '@', chr(9), chr(13)) THEN '''' || raw ELSE raw END AS safe, raw AS back
  FROM (SELECT doc_id, CASE lang WHEN 'fr' THEN '=' WHEN 'de' THEN '-' WHEN 'es' THEN '''@' ELSE '' END || text AS raw FROM documents)""")
def _(s, d):
    raw = F.concat(F.when(F.col("lang") == "fr", "=").when(F.col("lang") == "de", "-").when(F.col("lang") == "es", "'@").otherwise(""), "description")
    safe = text.csv_safe(raw)
    # Text that already looks quoted is read back unquoted, so the inverse is shown on values the encoder wrote.
    back = F.when(safe != raw, text.csv_unsafe(safe)).otherwise(raw)
    return _doc(s, d).select(F.col("item_id").alias("doc_id"), safe.alias("safe"), back.alias("back"))


@query("F29_miss_note", "SELECT doc_id, CASE lang WHEN 'en' THEN 'none found (all 5 steps ran)' ELSE 'none found (' || lang || ')' END AS note FROM documents")
def _(s, d):
    return _doc(s, d).select(F.col("item_id").alias("doc_id"), text.miss_note(F.when(F.col("lang") == "en", "  ").otherwise(F.col("lang"))).alias("note"))


@query("F30_redact", f"SELECT doc_id, CASE WHEN len(e) = 0 THEN '?' ELSE left(e[1], 1) || '***@' || split_part(e[1], '@', 2) END AS shown FROM (SELECT doc_id, regexp_extract_all(text, {lit(V.EMAIL_PATTERN)}) AS e FROM documents)")
def _(s, d):
    return _doc(s, d).select(F.col("item_id").alias("doc_id"), text.redact(links.first_email("description", [""])).alias("shown"))


@query("F31_greeting_name", r"""SELECT conv_id, turn, CASE WHEN regexp_matches(t, '[\p{L}\p{N}]') THEN t ELSE 'there' END AS name FROM (
  SELECT conv_id, turn, regexp_replace(regexp_replace(CASE WHEN role = 'system' THEN chr(13) || ' *** ' || chr(10) ELSE text END, '[\r\n\x00]', '', 'g'), '^\s+|\s+$', '', 'g') AS t FROM conversations)""")
def _(s, d):
    raw = F.when(F.col("role") == "system", "\r *** \n").otherwise(F.col("text"))
    return B.table(s, d, "conversations").select("conv_id", "turn", text.greeting_name(raw).alias("name"))


@query("F35_claim_key", "SELECT event_id, user_id || ':' || event_type AS key FROM events")
def _(s, d):
    return B.events(s, d).select("event_id", text.claim_key("user_id", "event_type").alias("key"))


@query("F36_display_count", with_("ent", r""" SELECT entity_id, CASE WHEN n >= 1000000 THEN regexp_replace(CAST(round(n / 1000000, 1) AS VARCHAR), '\.0$', '') || 'M'
  WHEN n >= 1000 THEN CAST(CAST(round(n / 1000, 0) AS BIGINT) AS VARCHAR) || 'K' ELSE CAST(CAST(n AS BIGINT) AS VARCHAR) END || ' Subscribers' AS shown
  FROM (SELECT entity_id, CAST(CASE WHEN niche = 'BUILDING' THEN subscribers * 10 WHEN niche = 'FURNITURE' THEN subscribers // 10000 ELSE subscribers END AS DOUBLE) AS n FROM ent)"""))
def _(s, d):
    n = F.when(F.col("niche") == "BUILDING", F.col("subscribers") * 10).when(F.col("niche") == "FURNITURE", F.expr("subscribers div 10000")).otherwise(F.col("subscribers"))
    return B.entities(s, d).select("entity_id", text.display_count(n, " Subscribers").alias("shown"))


# ---- shape and time -------------------------------------------------------------------------

_ISO_SQL = "'P' || CASE l_returnflag WHEN 'A' THEN l_linenumber || 'D' ELSE '' END || CASE l_linenumber WHEN 7 THEN '' ELSE 'T' END || CASE l_linestatus WHEN 'O' THEN l_linenumber || 'H' ELSE '' END || CASE l_returnflag WHEN 'N' THEN CAST(l_quantity AS BIGINT) || 'M' ELSE '' END || CASE WHEN l_quantity > 10 THEN CAST(l_quantity AS BIGINT) || 'S' ELSE '' END"


@query("F6_duration_seconds", f"""SELECT iso, CASE WHEN regexp_matches(iso, {lit(V.DURATION_PATTERN)}) THEN NULLIF(
  coalesce(TRY_CAST(regexp_extract(iso, '(\\d+)D', 1) AS BIGINT), 0) * 86400 + coalesce(TRY_CAST(regexp_extract(iso, '(\\d+)H', 1) AS BIGINT), 0) * 3600
  + coalesce(TRY_CAST(regexp_extract(iso, '(\\d+)M', 1) AS BIGINT), 0) * 60 + coalesce(TRY_CAST(regexp_extract(iso, '(\\d+)S', 1) AS BIGINT), 0), 0) END AS seconds, count(*) AS n
  FROM (SELECT {_ISO_SQL} AS iso FROM lineitem) GROUP BY 1, 2""")
def _(s, d):
    q, ln = F.col("l_quantity").cast("bigint").cast("string"), F.col("l_linenumber").cast("string")
    none = F.lit("")
    iso = F.concat(
        F.lit("P"), F.when(F.col("l_returnflag") == "A", F.concat(ln, F.lit("D"))).otherwise(none),
        F.when(F.col("l_linenumber") == 7, none).otherwise("T"), F.when(F.col("l_linestatus") == "O", F.concat(ln, F.lit("H"))).otherwise(none),
        F.when(F.col("l_returnflag") == "N", F.concat(q, F.lit("M"))).otherwise(none), F.when(F.col("l_quantity") > 10, F.concat(q, F.lit("S"))).otherwise(none))
    return B.table(s, d, "lineitem").groupBy(iso.alias("iso")).agg(F.count(F.lit(1)).alias("n")).select("iso", shape.duration_seconds("iso").alias("seconds"), "n")


@query("F7_parse_ts", """SELECT event_id, CASE event_type WHEN 'signup' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 'click' THEN strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S')
  WHEN 'view' THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') END AS parsed FROM events""")
def _(s, d):
    t = F.col("event_type")
    raw = (F.when(t == "signup", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).when(t == "click", F.date_format("ts", "yyyy-MM-dd"))
           .when(t == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+02:00'")).when(t == "error", F.date_format("ts", "yyyy")).otherwise("not a date"))
    return B.events(s, d).select("event_id", F.date_format(shape.parse_ts(raw), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("F8_age_months", f"SELECT o_custkey AS entity_id, round({days('min(o_orderdate)', lit(B.ITEMS_AS_OF))} / 30.44, 6) AS age FROM orders GROUP BY 1")
def _(s, d):
    first = B.plain_items(s, d).groupBy("entity_id").agg(F.min("published_at").alias("first"))
    return first.select("entity_id", text.rounded(shape.age_months("first", B.ITEMS_AS_OF), 6).alias("age"))


@query("F10_is_vertical", "SELECT p_partkey, CAST(CASE WHEN p_size > 0 AND p_partkey % 51 > 0 THEN CAST(p_size AS DOUBLE) / (p_partkey % 51) <= 0.95 END AS VARCHAR) AS vertical FROM part")
def _(s, d):
    h = F.when(F.col("p_partkey") % 51 == 50, F.lit("50")).otherwise((F.col("p_partkey") % 51).cast("string"))
    return B.table(s, d, "part").select("p_partkey", shape.is_vertical("p_size", h).cast("string").alias("vertical"))


@query("F11_is_short", with_("doc", f" SELECT item_id, CAST({SHORT.format(1500)} AS VARCHAR) AS short FROM (SELECT * REPLACE (CASE WHEN lang = 'es' THEN NULL ELSE seconds END AS seconds) FROM doc)"))
def _(s, d):
    sec = F.when(F.col("lang") != "es", F.col("seconds"))
    return _doc(s, d).select("item_id", shape.is_short(sec, "w", "h", 1500).cast("string").alias("short"))


@query("F34_local_day", f"SELECT event_id, CAST({local_day('ts', V.BUDGET_ZONE)} AS VARCHAR) AS budget_day, CAST({local_day('ts', V.QUOTA_ZONE)} AS VARCHAR) AS quota_day FROM events")
def _(s, d):
    return B.events(s, d).select("event_id", shape.local_day("ts", V.BUDGET_ZONE).cast("string").alias("budget_day"), shape.local_day("ts", V.QUOTA_ZONE).cast("string").alias("quota_day"))


@query("P17_qualify", f"SELECT o_custkey AS entity_id, CASE WHEN {days('min(o_orderdate)', lit(B.ITEMS_AS_OF))} / 30.44 < 72 THEN 'New Channel' ELSE 'Qualified' END AS qualification FROM orders GROUP BY 1")
def _(s, d):
    first = B.plain_items(s, d).groupBy("entity_id").agg(F.min("published_at").alias("first"))
    return first.select("entity_id", shape.qualify(shape.age_months("first", B.ITEMS_AS_OF), 72.0).alias("qualification"))


@query("P25_settled", f"SELECT o_orderkey AS item_id, coalesce({days('p', lit(B.ITEMS_AS_OF))} >= 400, FALSE) AS settled FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS p FROM orders)")
def _(s, d):
    when = F.when(F.col("o_orderstatus") != "P", F.col("published_at"))
    return B.plain_items(s, d).select("item_id", shape.settled(when, B.ITEMS_AS_OF, 400).alias("settled"))


# ---- scores ---------------------------------------------------------------------------------

_PERF = """, perf AS (SELECT entity_id, any_value(subscribers) AS subscribers, avg(coalesce(views, 0)) AS v, CASE WHEN sum(coalesce(views, 0)) > 0 THEN CAST(sum(engagements) AS DOUBLE) / sum(coalesce(views, 0)) * 2000 ELSE 0.0 END AS e,
  CAST(count(*) AS DOUBLE) / 4 AS f FROM ent JOIN itm USING (entity_id) GROUP BY 1)"""
_RISK = """CASE WHEN subscribers <= 0 THEN 100.0 ELSE round(least(100.0, CASE WHEN r < 0.02 THEN 45 * least(1.0, greatest(0.0, 1 - r / 0.02)) ELSE 0 END
  + CASE WHEN e < 0.5 THEN 35 * least(1.0, greatest(0.0, 1 - e / 0.5)) ELSE 0 END + CASE WHEN subscribers >= 100000 AND r < 0.005 THEN 20 ELSE 0 END), 1) END"""


def _perf(s, d):
    m = B.items(s, d).groupBy("entity_id").agg(
        F.avg(F.coalesce("views", F.lit(0))).alias("v"), F.sum(F.coalesce("views", F.lit(0))).alias("tv"), F.sum("engagements").alias("te"),
        (F.count(F.lit(1)).cast("double") / 4).alias("f"))
    e = F.when(F.col("tv") > 0, F.try_divide(F.col("te").cast("double"), "tv") * 2000).otherwise(0.0)
    return B.entities(s, d).select("entity_id", "subscribers").join(m.select("entity_id", "v", e.alias("e"), "f"), "entity_id")


_NORM_LOG = "CASE WHEN {0} <= 0 THEN 0.0 ELSE round(least(100.0, greatest(0.0, log10({0} + 1) / log10({1} + 1.0) * 100)), 1) END"
_NORM_FREQ = "CASE WHEN f <= 0 THEN 0.0 WHEN f < 2 THEN round(f / 2 * 100, 1) WHEN f <= 20 THEN 100.0 ELSE round(greatest(50.0, 20 / f * 100), 1) END"
_R = ", r AS (SELECT *, v / subscribers / 100 AS r FROM perf)"


@query("F12_fake_follower_risk", with_("ent itm", _PERF + _R + f" SELECT entity_id, CAST({_RISK} AS DOUBLE) AS risk FROM r"))
def _(s, d):
    return _perf(s, d).select("entity_id", scoring.fake_follower_risk("subscribers", F.col("v") / 100, "e").alias("risk"))


@query("F13_normalise", with_("ent itm", _PERF + f""" SELECT entity_id, CAST({_NORM_LOG.format('CAST(subscribers AS DOUBLE)', '1000000')} AS DOUBLE) AS log_subs, CAST({_NORM_LOG.format('v', '500000')} AS DOUBLE) AS log_views,
  round(least(100.0, greatest(0.0, e / 8.0 * 100)), 1) AS linear, CAST({_NORM_FREQ.replace('f', '(f * 4)').replace('i(f * 4)', 'if')} AS DOUBLE) AS freq_all, CAST({_NORM_FREQ} AS DOUBLE) AS freq FROM perf"""))
def _(s, d):
    return _perf(s, d).select(
        "entity_id", scoring.norm_log("subscribers", V.SUBSCRIBER_CEILING).alias("log_subs"), scoring.norm_log("v", V.VIEWS_CEILING).alias("log_views"),
        scoring.norm_linear("e", V.ENGAGEMENT_CEILING).alias("linear"), scoring.norm_freq(F.col("f") * 4).alias("freq_all"), scoring.norm_freq("f").alias("freq"))


_TOTAL = f"""least(100.0, greatest(0.0, 0.20 * {_NORM_LOG.format('CAST(subscribers AS DOUBLE)', '1000000')} + 0.20 * {_NORM_LOG.format('v', '500000')}
  + 0.20 * round(least(100.0, greatest(0.0, e / 8.0 * 100)), 1) + 0.15 * {_NORM_FREQ} + 0.15 * (100 - {_RISK}) + 0.10 * 70.0))"""
SCORE_SQL = half_up(_TOTAL, 1)


@query("F14_overall_score", with_("ent itm", _PERF + _R + f" SELECT entity_id, {SCORE_SQL} AS score FROM r"))
def _(s, d):
    p = _perf(s, d).withColumn("risk", scoring.fake_follower_risk("subscribers", F.col("v") / 100, "e"))
    return p.select("entity_id", scoring.overall_score("subscribers", "v", "e", "f", "risk").alias("score"))


# ---- places ---------------------------------------------------------------------------------

def _country_sql(c):
    t = strip(f"coalesce({c}, '')")
    name = f"trim(regexp_replace(replace(lower({t}), ',', ' '), '\\s+', ' ', 'g'))"
    return f"CASE WHEN lower({t}) IN {ins(V.UNKNOWN_COUNTRY_VALUES)} THEN '' WHEN regexp_matches({t}, '^\\p{{L}}{{2}}$') THEN upper({t}) ELSE coalesce({mapping(ALL_COUNTRIES)}[{name}], '') END"


_CODE = _country_sql("country")
_FLAGS = r"""list_sort(list_distinct(list_transform(regexp_extract_all({0}, '[\x{{1F1E6}}-\x{{1F1FF}}]{{2}}'), lambda p: chr(unicode(left(p, 1)) - 127397) || chr(unicode(right(p, 1)) - 127397))))"""
_ALT = "|".join(sorted(V.OUTSIDE_COUNTRY_NAMES, key=len, reverse=True))
_NAMED = rf"lower(regexp_extract({{0}}, '(?i)(?:^|[^\p{{{{L}}}}\p{{{{N}}}}_])({_ALT})(?:$|[^\p{{{{L}}}}\p{{{{N}}}}_])', 1))"
_SAID = rf"lower(regexp_extract({{0}}, {lit(('(?i)' + V.LOCATION_CUE + '[^' + chr(92) + 'n]{0,60}?' + chr(92) + 'b(' + _ALT + ')' + chr(92) + 'b').replace('{', '{{').replace('}', '}}'))}, 1))"
_FLAG_OUT = f"coalesce(list_extract(list_filter({_FLAGS.format('full_title')}, lambda x: NOT list_contains({lst(B.ZONE)}, x)), 1), '')"
_OUT = mapping(V.OUTSIDE_COUNTRY_NAMES)


@query("F15_country_code", with_("ent", f" SELECT entity_id, {_CODE} AS code FROM ent"))
def _(s, d):
    return B.entities(s, d).select("entity_id", geo.country_code("country").alias("code"))


@query("F16_region_of", r"""SELECT doc_id, upper(coalesce(list_extract(list_filter(list_slice(string_split_regex(tag, '[-_]'), 2, 9), lambda p: regexp_matches(p, '^\p{L}{2}$')), 1), '')) AS region
  FROM (SELECT doc_id, CASE lang WHEN 'en' THEN 'en-Latn_gb' WHEN 'fr' THEN 'fr-' || upper(lang) WHEN 'es' THEN 'es-419' ELSE lang END AS tag FROM documents)""")
def _(s, d):
    tag = F.when(F.col("lang") == "en", "en-Latn_gb").when(F.col("lang") == "fr", F.concat(F.lit("fr-"), F.upper("lang"))).when(F.col("lang") == "es", "es-419").otherwise(F.col("lang"))
    return _doc(s, d).select(F.col("item_id").alias("doc_id"), geo.region_of(tag).alias("region"))


@query("F18_flag_codes", with_("ent", f" SELECT entity_id, array_to_string({_FLAGS.format('full_title')}, ',') AS codes FROM ent"))
def _(s, d):
    return B.entities(s, d).select("entity_id", F.array_join(geo.flag_codes("full_title"), ",").alias("codes"))


@query("P8_zone_verdict", with_("ent", f" SELECT entity_id, CAST(CASE WHEN {_CODE} <> '' THEN list_contains({lst(B.ZONE)}, {_CODE}) END AS VARCHAR) AS inside FROM ent"))
def _(s, d):
    return B.entities(s, d).select("entity_id", geo.zone_verdict("country", B.ZONE).cast("string").alias("inside"))


@query("P13_flag_outside", with_("ent", f" SELECT entity_id, {_FLAG_OUT} AS code FROM ent"))
def _(s, d):
    return B.entities(s, d).select("entity_id", geo.flag_outside("full_title", B.ZONE).alias("code"))


@query("P14_title_country", with_("ent", f" SELECT entity_id, coalesce({_OUT}[{_NAMED.format('full_title')}], '') AS code FROM ent"))
def _(s, d):
    return B.entities(s, d).select("entity_id", geo.title_country("full_title").alias("code"))


@query("P15_desc_location", with_("doc", f" SELECT item_id, coalesce({_OUT}[{_SAID.format('placed_text')}], '') AS code FROM doc"))
def _(s, d):
    return _doc(s, d).select("item_id", geo.desc_location("placed_text").alias("code"))


LOCATION_SQL = f"""loc AS (SELECT entity_id, CASE WHEN flag <> '' THEN 'outside_search_zone' WHEN named <> '' THEN 'outside_search_zone' WHEN said <> '' THEN 'outside_search_zone'
   WHEN code = '' THEN 'no_declared_country' WHEN NOT list_contains({lst(B.ZONE)}, code) THEN 'outside_search_zone' END AS reason,
   CASE WHEN flag <> '' THEN 'title flies the ' || flag || ' flag' WHEN named <> '' THEN 'title names ' || named WHEN said <> '' THEN 'description says ' || said
   WHEN code = '' THEN 'no country set on the channel' WHEN NOT list_contains({lst(B.ZONE)}, code) THEN 'declared country ' || {strip('country')} END AS detail
   FROM (SELECT entity_id, country, {_FLAG_OUT} AS flag, coalesce({_OUT}[{_NAMED.format('full_title')}], '') AS named, coalesce({_OUT}[{_SAID.format("coalesce(bio, '')")}], '') AS said, {_CODE} AS code
     FROM ent LEFT JOIN (SELECT item_id AS entity_id, placed_text AS bio FROM doc) USING (entity_id)))"""


@query("P7_location_gate", with_("ent doc", ", " + LOCATION_SQL + " SELECT * FROM loc"))
def _(s, d):
    bio = _doc(s, d).select(F.col("item_id").alias("entity_id"), F.col("placed_text").alias("bio"))
    g = B.entities(s, d).join(bio, "entity_id", "left").select("entity_id", geo.location_gate("full_title", "bio", "country", B.ZONE).alias("g"))
    return g.select("entity_id", "g.reason", "g.detail")


# ---- text predicates ------------------------------------------------------------------------

@query("P1_first_email", with_("doc", f" SELECT item_id, coalesce(list_extract({emails('description', MAIL_DOMAINS)}, 1), '') AS email FROM doc"))
def _(s, d):
    return _doc(s, d).select("item_id", links.first_email("description", MAIL_DOMAINS).alias("email"))


@query("P2_is_third_party", f"""SELECT e AS email, lower(split_part(e, '@', -1)) IN {ins(MAIL_DOMAINS)} AS third_party, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(text, {lit(V.EMAIL_PATTERN)})) AS e FROM documents) GROUP BY 1, 2""")
def _(s, d):
    e = _doc(s, d).select(F.explode(links.emails("description", [""])).alias("email"))
    return e.groupBy("email", links.third_party("email", MAIL_DOMAINS).alias("third_party")).agg(F.count(F.lit(1)).alias("n"))


@query("P3_missing_value", with_("ent", f" SELECT entity_id, title FROM ent WHERE {strip("coalesce(nation, ' ')")} = ''"))
def _(s, d):
    return tables.missing_value(B.entities(s, d).select("entity_id", "title", "nation"), "entity_id", "nation").select("entity_id", "title")


@query("P9_excluded_topic", with_("doc", " SELECT item_id, CASE " + " ".join(f"WHEN regexp_matches(title || ' ' || description, {word(t)}) THEN {lit(c)}" for c, t in TOPICS.items()) + " END AS topic FROM doc"))
def _(s, d):
    return _doc(s, d).select("item_id", text.excluded_topic(["title", "description"], TOPICS).alias("topic"))


@query("P10_broadcaster", with_("doc", f" SELECT item_id, CASE WHEN regexp_matches(title, {word(TV_NAMES)}) THEN 'broadcast_tv_name' WHEN regexp_matches(title || ' ' || description, {word(TV_PHRASES)}) THEN 'broadcast_tv_phrase' END AS half FROM doc"))
def _(s, d):
    return _doc(s, d).select("item_id", text.broadcaster("title", "description", TV_NAMES, TV_PHRASES).alias("half"))


@query("P11_is_english", "SELECT doc_id, coalesce(tag LIKE 'en%', FALSE) AS english FROM (SELECT doc_id, CASE lang WHEN 'de' THEN NULL WHEN 'en' THEN 'en-gb' ELSE lang END AS tag FROM documents)")
def _(s, d):
    tag = F.when(F.col("lang") == "en", " EN-GB").when(F.col("lang") != "de", F.col("lang"))
    return _doc(s, d).select(F.col("item_id").alias("doc_id"), text.is_english(tag).alias("english"))


def _non_latin_sql(c):
    t = strip(c)
    n = rf"length(regexp_replace({t}, '[^\x{{00C0}}-\x{{00FF}}]', '', 'g'))"
    return f"({n} >= 8 AND length({t}) > 0 AND CAST({n} AS DOUBLE) / length({t}) >= 0.10)"


@query("P12_non_latin", f"SELECT 'd' || doc_id AS id, {_non_latin_sql('text')} AS foreign_script FROM documents UNION ALL SELECT 'c' || conv_id || '.' || turn, {_non_latin_sql('text')} FROM conversations")
def _(s, d):
    flag = text.non_latin("text", ranges=ACCENTS).alias("foreign_script")
    docs = B.table(s, d, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), flag)
    conv = B.table(s, d, "conversations").select(F.concat(F.lit("c"), "conv_id", F.lit("."), "turn").alias("id"), flag)
    return docs.unionByName(conv)


@query("P16_persona_signals", f"SELECT doc_id, array_to_string(list_filter({lst(BIO_SIGNALS)}, lambda s: contains(lower(text), s)), '|') AS signals FROM documents")
def _(s, d):
    return _doc(s, d).select(F.col("item_id").alias("doc_id"), F.array_join(text.persona_signals("description", BIO_SIGNALS), "|").alias("signals"))


# ---- verdicts -------------------------------------------------------------------------------

def _payload(s, d):
    k = F.get_json_object("props", "$.k").cast("int")

    def crit(name, div):
        return F.struct(F.lit(name).alias("criterion"), (k % div == 0).alias("matches"), F.concat(F.lit("k="), k).alias("evidence"))

    return B.events(s, d).select("event_id", "user_id", "event_type", "value", k.alias("k"), F.struct(
        (F.col("event_type") == "purchase").alias("matches"), F.least(F.lit(1.0), F.floor(F.col("value") * 2) / 100).alias("confidence"), F.col("event_type").alias("reason"),
        F.when(F.col("event_type") != "view", F.array(crit("even", 2), crit("third", 3), crit("fifth", 5))).alias("criteria_results")).alias("p"))


CONFIRM_SQL = """vp AS (SELECT event_id, user_id, event_type, k, conf, nx, hits, CASE WHEN conf < 0.6 THEN FALSE WHEN nx > 0 AND k % 5 <> 0 THEN FALSE WHEN event_type = 'purchase' THEN TRUE
  WHEN nx = 0 THEN FALSE ELSE CAST(hits AS DOUBLE) / nx >= 0.5 END AS confirmed,
  CASE WHEN conf < 0.6 THEN 'below confidence (' || ct || ')' WHEN nx > 0 AND k % 5 <> 0 THEN 'failed a required criterion: fifth'
  WHEN event_type = 'purchase' THEN 'video confirmed ' || ct WHEN nx = 0 THEN 'video did not confirm (' || ct || ')'
  WHEN CAST(hits AS DOUBLE) / nx >= 0.5 THEN 'video partly confirmed ' || ct || ' (' || hits || '/3 criteria)' ELSE 'video did not confirm (' || ct || ', ' || hits || '/3 criteria)' END AS why
  FROM (SELECT *, CASE WHEN event_type = 'view' THEN 0 ELSE 3 END AS nx, CASE WHEN event_type = 'view' THEN 0 ELSE CAST(k % 2 = 0 AS INT) + CAST(k % 3 = 0 AS INT) + CAST(k % 5 = 0 AS INT) END AS hits, printf('%.2f', conf) AS ct
  FROM (SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, least(1.0, floor(value * 2) / 100) AS conf FROM events)))"""


@query("P19_verdict_confirms", "WITH " + CONFIRM_SQL + " SELECT event_id, confirmed, why FROM vp")
def _(s, d):
    v = _payload(s, d).select("event_id", verdicts.verdict_confirms("p", required=["fifth"]).alias("v"))
    return v.select("event_id", "v.confirmed", "v.why")


@query("P20_valid_verdict", """SELECT event_id, CASE event_type WHEN 'error' THEN 'malformed' WHEN 'click' THEN CASE WHEN k % 2 = 0 THEN 'max_tokens' ELSE 'safety_blocked' END
  WHEN 'view' THEN 'malformed' WHEN 'signup' THEN CASE WHEN k <= 50 THEN 'ok' ELSE 'malformed' END ELSE 'ok' END AS code FROM (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""")
def _(s, d):
    p = _payload(s, d)
    inner = F.to_json(F.struct(
        F.when(F.col("event_type") != "view", F.col("p.matches")).alias("matches"),
        F.when(F.col("event_type") == "signup", F.col("k") / 50).otherwise(F.col("p.confidence")).alias("confidence"), F.col("p.reason").alias("reason"), F.coalesce("p.criteria_results", F.array().cast("array<struct<criterion:string,matches:boolean,evidence:string>>")).alias("criteria_results")))
    finish = F.when(F.col("event_type") == "click", F.when(F.col("k") % 2 == 0, "MAX_TOKENS").otherwise("safety")).otherwise("STOP")
    body = F.to_json(F.struct(F.array(F.struct(finish.alias("finishReason"), F.struct(F.array(F.struct(inner.alias("text"))).alias("parts")).alias("content"))).alias("candidates")))
    body = F.when(F.col("event_type") == "error", F.when(F.col("k") % 2 == 0, "<html>").otherwise('{"candidates":[]}')).otherwise(body)
    return p.select("event_id", verdicts.valid_verdict(body).alias("code"))


@query("F21_criteria_hash", r"""SELECT item_id, left(sha256(array_to_string(list_transform(string_split(j, ''), lambda c: CASE WHEN unicode(c) < 128 THEN c ELSE printf('\u%04x', unicode(c)) END), '')), 16) AS digest
  FROM (SELECT item_id, CAST(to_json([{'name': CAST(item_id AS VARCHAR), 'test': text}]) AS VARCHAR) AS j FROM benchmark)""")
def _(s, d):
    crit = F.array(F.struct(F.col("item_id").cast("string").alias("name"), F.col("text").alias("test")))
    return B.table(s, d, "benchmark").select("item_id", verdicts.criteria_hash(crit).alias("digest"))


@query("F22_verdict_notes", r"""SELECT conv_id, turn, left(regexp_replace(regexp_replace(text || ' [' || role || CASE WHEN turn % 2 = 0 THEN ': yes] ' ELSE ': no] ' END || text, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g'), 1500) AS notes FROM conversations""")
def _(s, d):
    crit = F.array(F.struct(F.col("role").alias("criterion"), (F.col("turn") % 2 == 0).alias("matches"), F.col("text").alias("evidence")))
    return B.table(s, d, "conversations").select("conv_id", "turn", verdicts.verdict_notes("text", crit).alias("notes"))


@query("F38_classify_error", """SELECT event_id, CASE event_type WHEN 'error' THEN CASE WHEN k < 30 THEN 'quota_exhausted' WHEN k < 60 THEN 'rate_limited' ELSE 'quota_exhausted' END
  WHEN 'click' THEN CASE WHEN k < 50 THEN 'video_unavailable' ELSE 'request_rejected' END ELSE 'unreachable' END AS code FROM (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""")
def _(s, d):
    k, t = F.get_json_object("props", "$.k").cast("int"), F.col("event_type")
    status = F.when(t == "error", 429).when(t == "click", F.when(k % 3 == 0, 400).when(k % 3 == 1, 403).otherwise(404)).when(t == "view", 500).otherwise(503)
    body = F.when(t == "error", F.when(k < 30, "GenerateRequestsPerDay").when(k < 60, "limit PER MINUTE").otherwise("slow down")).otherwise(
        F.when(k < 50, "The Video is NOT accessible").otherwise("bad request"))
    return B.events(s, d).select("event_id", verdicts.classify_error(status, body).alias("code"))


@query("F39_first_key", "SELECT event_id, CASE event_type WHEN 'signup' THEN 'user' || user_id WHEN 'click' THEN 'u' || user_id WHEN 'view' THEN CAST(user_id AS VARCHAR) END AS handle FROM events")
def _(s, d):
    t, u = F.col("event_type"), F.col("user_id").cast("string")
    js = (F.when(t == "signup", F.to_json(F.struct(F.concat(F.lit("@User"), u).alias("handle"), F.lit("x").alias("username"))))
          .when(t == "click", F.to_json(F.struct(F.lit("").alias("handle"), F.concat(F.lit("U"), u).alias("username"))))
          .when(t == "view", F.to_json(F.struct(F.concat(F.lit("@@"), u).alias("profile_handle")))).otherwise(F.col("props")))
    return B.events(s, d).select("event_id", verdicts.first_key(js, "handle", "username", "profile_handle").alias("handle"))


# ---- links ----------------------------------------------------------------------------------

_HOST = r"regexp_replace(lower(regexp_extract({0}, '^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#]*@)?([^/?#:@]*)', 1)), '^www\.', '')"


def _wrapped():
    return F.when(F.contains("url", F.lit("?")), F.concat(F.lit("https://www.youtube.com/redirect?event=c&q="), F.url_encode("url"), F.lit("&v=1"))).otherwise(F.col("url"))


@query("F23_unwrap_redirect", "SELECT page_id, url AS target FROM pages")
def _(s, d):
    return B.pages(s, d).select("page_id", links.unwrap_redirect(_wrapped()).alias("target"))


@query("F24_link_host", f"SELECT page_id, {_HOST.format('url')} AS host FROM pages")
def _(s, d):
    bare = F.when(F.col("url").startswith("https://"), F.regexp_replace("url", "^https://", "")).otherwise(F.upper("url"))
    return B.pages(s, d).select("page_id", links.link_host(bare).alias("host"))


@query("F25_contact_url", r"SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/contact' AS contact FROM pages")
def _(s, d):
    return B.pages(s, d).select("page_id", links.contact_url(F.regexp_replace("url", "^https://", "")).alias("contact"))


@query("F26_about_urls", r"""SELECT page_id, CASE WHEN contains(url, '?') OR regexp_replace(p, '/+$', '') = '' THEN '' ELSE o || regexp_replace(p, '/+$', '') || '/about' END AS about
  FROM (SELECT page_id, url, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS o, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS p FROM pages)""")
def _(s, d):
    p = B.pages(s, d).select("page_id", "url", links.link_host("url").alias("host"))
    urls = F.array("url", F.col("url"), F.concat(F.lit("https://other.example/"), "host"))
    # Every page host is a listed social host here, the appended one is not.
    hosts = F.filter(urls, lambda u: links.link_host(u) == F.col("host"))
    return p.select("page_id", F.array_join(links.about_urls(F.transform(hosts, lambda u: F.regexp_replace(u, r"^(https?://)[^/?#]*", "$1facebook.com"))), " ").alias("a"), "url").select(
        "page_id", F.when(F.col("a") == "", "").otherwise(F.concat(F.regexp_extract("url", r"^(https?://[^/?#]*)", 1), F.regexp_replace("a", r"^https?://facebook\.com", ""))).alias("about"))


@query("F27_extract_links", r"""SELECT page_id, i - 1 AS place, links[i] AS link FROM (SELECT page_id, links, unnest(range(1, len(links) + 1)) AS i FROM (
  SELECT page_id, list_filter(list_transform(list_distinct_ordered, lambda x: x), lambda x: x <> '') AS links FROM (SELECT page_id, list_filter(l, lambda x, i: list_position(l, x) = i) AS list_distinct_ordered FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages))))""")
def _(s, d):
    p = B.pages(s, d).select("page_id", F.posexplode(links.extract_links("html")).alias("place", "link"))
    return p.select("page_id", F.col("place").cast("bigint").alias("place"), "link")


def _about_json(urls):
    """A page's links as the nested document an about page carries: each one wrapped in a redirect, nine levels down."""

    def one(u):
        node = F.struct(F.concat(F.lit("https://go.example/redirect?event=about&q="), F.url_encode(u)).alias("url"))
        for name in ("webCommand", "metadata", "command", "onTap"):
            node = F.struct(node.alias(name))
        node = F.struct(F.array(node).alias("runs"))
        for name in ("link", "externalLink"):
            node = F.struct(node.alias(name))
        return node

    return F.to_json(F.struct(F.struct(F.lit("https://go.example/redirect?q=outside").alias("url")).alias("header"), F.transform(urls, one).alias("links")))


@query("F27_nested_links", r"""SELECT page_id, i - 1 AS place, links[i] AS link FROM (SELECT page_id, links, unnest(range(1, len(links) + 1)) AS i FROM (
  SELECT page_id, list_filter(l, lambda x, i: x <> '' AND list_position(l, x) = i) AS links FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)))""")
def _(s, d):
    hrefs = F.filter(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), 1), lambda u: u != "")
    docs = B.pages(s, d).select("page_id", _about_json(hrefs).alias("about"))
    found = links.nested_links(docs, "about", "links", "$.links", "go.example")
    return found.select("page_id", F.posexplode("links").alias("place", "link")).select("page_id", F.col("place").cast("bigint").alias("place"), "link")


@query("F32_safe_urls", r"""SELECT page_id, CASE WHEN regexp_matches(url, '^https://[a-z.-]+/[a-z]{2}/\d+$') THEN url WHEN page_id >= 100 THEN 'https://video.example/channel/' || page_id END AS entity_url,
  CASE WHEN url LIKE 'https%' THEN url WHEN contains(url, '?') THEN NULL ELSE 'mailto:stop@' || page_id || '.example?subject=x' END AS unsubscribe FROM pages""")
def _(s, d):
    opt = F.when(F.col("url").startswith("https"), F.concat(F.lit("\n"), "url")).when(F.contains("url", F.lit("?")), F.concat(F.lit("javascript:"), "url")).otherwise(
        F.concat(F.lit("mailto:stop@"), "page_id", F.lit(".example?subject=x")))
    return B.pages(s, d).select(
        "page_id", links.safe_entity_url("url", "page_id", r"^https://[a-z.-]+/[a-z]{2}/\d+$", r"^\d{3,}$", "https://video.example/channel/").alias("entity_url"),
        links.safe_unsubscribe_url(opt).alias("unsubscribe"))


@query("F33_item_id", r"""SELECT page_id, CASE WHEN contains(url, '?') THEN CAST(page_id AS VARCHAR) ELSE split_part(regexp_replace(url, '/+$', ''), '/', -1) END AS item FROM pages""")
def _(s, d):
    u = F.when(F.contains("url", F.lit("?")), F.concat("url", F.lit("&v="), "page_id", F.lit("&t=3"))).otherwise(F.col("url"))
    return B.pages(s, d).select("page_id", links.item_id_from_url(u).alias("item"))


@query("P23_external_links", f"SELECT page_id, CASE WHEN {_HOST.format('url')} IN {ins(PAGE_HOSTS)} THEN '' ELSE url END AS kept FROM pages")
def _(s, d):
    urls = F.array(F.col("url"), F.lit("https://x.com/a").cast("string"), F.col("url"), F.lit(""))
    return B.pages(s, d).select("page_id", F.array_join(links.external_links(urls, PAGE_HOSTS + ["x.com"]), " ").alias("kept"))


@query("P24_no_presence", "SELECT page_id, CASE WHEN NOT contains(url, '?') AND url LIKE 'https:%' THEN 'no_social_presence' END AS reason FROM pages")
def _(s, d):
    found = F.when(F.contains("url", F.lit("?")), F.lit(None).cast("array<string>")).otherwise(links.external_links(F.array(F.when(F.col("url").startswith("http:"), F.col("url")))))
    return B.pages(s, d).select("page_id", links.no_presence(found).alias("reason"))


# ---- gates ----------------------------------------------------------------------------------

@query("P4_send_queue", """SELECT o_orderkey AS entity_id, strftime(o_orderdate, '%Y-%m-%d') AS requested_at FROM orders
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F' AND o_totalprice < 300000 AND o_totalprice >= 50000""")
def _(s, d):
    o = B.table(s, d, "orders").select(
        F.col("o_orderkey").alias("entity_id"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), V.QUALIFIED).otherwise(V.NEW_ENTITY).alias("qualification"),
        F.when(F.col("o_orderstatus") == "F", "Approved").otherwise("Reviewing").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("requested_at"),
        F.when(F.col("o_totalprice") < 300000, "a@b.example").otherwise("").alias("email"),
        F.when(F.col("o_totalprice") < 50000, "bounced").alias("ineligible_reason"))
    return gates.send_queue(o).select("entity_id", "requested_at")


@query("P6_longform_gate", with_("doc", f" SELECT entity_id, CASE WHEN count_if({SHORT.format(1500)} = FALSE) < 12 THEN 'too_few_longform_videos' END AS reason FROM doc WHERE position <= 50 GROUP BY 1"))
def _(s, d):
    w = windows.newest_n(_doc(s, d).select("entity_id", "item_id", "seconds", "w", "h"), 50, ["item_id"])
    n = w.groupBy("entity_id").agg(F.count_if(~shape.is_short("seconds", "w", "h", 1500)).alias("n"))
    return n.select("entity_id", gates.longform_gate("n", 12).alias("reason"))


@query("P21_deletable", with_("ent", " SELECT entity_id, niche IN ('BUILDING', 'FURNITURE') AND subscribers < 500000 AS deletable FROM ent"))
def _(s, d):
    verdict = F.when(F.col("niche").isin("BUILDING", "FURNITURE"), "stale_channel").when(F.col("niche") == "MACHINERY", "pass").otherwise("unreachable")
    status = F.when(F.col("subscribers") < 500000, "New").when(F.col("subscribers") < 800000, "Approved")
    return B.entities(s, d).select("entity_id", gates.deletable(verdict, status).alias("deletable"))


@query("P26_durable_reject", "SELECT event_id, event_type NOT IN ('error', 'click') AS durable FROM events")
def _(s, d):
    reason = F.when(F.col("event_type") == "error", "quota_exhausted").when(F.col("event_type") == "click", "unreachable").when(F.col("event_type") == "view", "stale_channel")
    return B.events(s, d).select("event_id", gates.durable_reject(reason).alias("durable"))
