"""Registered queries: sources, sinks, matching joins, set operations and budgets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as V, links, text
from ..operators import budgets, matching
from ..session import scratch_dir
from ..sources import bindings as B, sinks, tables
from .metrics_catalog import GATED, REUPLOADS, gated_rows
from .registry import query
from .sql_bindings import emails, fold, with_


# ---- sources --------------------------------------------------------------------------------

@query("S1_scan", with_("ent", " SELECT entity_id, title, niche FROM ent"))
def _(s, d):
    return tables.scan(B.entities(s, d), "entity_id", ["title", "niche"])


@query("S2_known_ids", "SELECT DISTINCT id FROM (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer UNION ALL SELECT CAST(o_custkey AS VARCHAR) FROM orders UNION ALL SELECT n_name FROM nation WHERE n_nationkey <> 0)")
def _(s, d):
    n = B.table(s, d, "nation").select(F.when(F.col("n_nationkey") == 0, F.lit(" ")).otherwise(F.col("n_name")).alias("id"))
    return tables.known_ids([B.entities(s, d).withColumnRenamed("entity_id", "id"), B.plain_items(s, d).withColumnRenamed("entity_id", "id"), n], "id")


@query("S3_tracked_handles", with_("ent", " SELECT DISTINCT handle FROM ent WHERE niche <> 'BUILDING'"))
def _(s, d):
    raw = F.when(F.col("niche") == "BUILDING", " @ ").otherwise(F.concat(F.lit(" @"), F.upper("handle")))
    e = B.entities(s, d).select(F.col("entity_id"), raw.alias("handle"))
    without = B.entities(s, d).select("entity_id")
    return tables.tracked_handles(e).unionByName(tables.tracked_handles(without))


@query("S4_flatten_creators", "SELECT event_type || '_' || user_id AS handle, event_type AS title, CAST(arg_min(event_id, event_id) AS VARCHAR) AS user_id, 'vendor' AS matched FROM events WHERE event_type <> 'error' GROUP BY 1, 2")
def _(s, d):
    acc = F.array(
        F.struct(F.lit("0").alias("user_id"), F.struct(F.lit("no handle").alias("username"), F.lit("x").alias("full_name")).alias("profile")),
        F.struct(F.col("event_id").cast("string").alias("user_id"), F.struct(
            F.when(F.col("event_type") != "error", F.concat(F.lit("https://v.example/@"), F.initcap("event_type"), F.lit("_"), "user_id")).alias("username"), F.col("event_type").alias("full_name")).alias("profile")))
    e = B.events(s, d).select("event_id", F.to_json(F.struct(acc.alias("accounts"))).alias("body"))
    return tables.flatten_creators(e, "body", ["event_id"], "vendor").withColumn("matched", F.array_join("matched", ","))


@query("S5_response_totals", """SELECT event_id, CASE event_type WHEN 'signup' THEN k WHEN 'click' THEN 2 WHEN 'view' THEN 2 ELSE 0 END::BIGINT AS total, CASE event_type WHEN 'signup' THEN value WHEN 'view' THEN value ELSE 0.0 END AS cost,
  CASE event_type WHEN 'signup' THEN CAST(k AS DOUBLE) END AS balance FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""")
def _(s, d):
    t, k, v = F.col("event_type"), F.get_json_object("props", "$.k"), F.col("value").cast("string")
    body = (F.when(t == "signup", F.concat(F.lit('{"total":'), k, F.lit(',"credits_cost":'), v, F.lit(',"credits_left":'), k, F.lit("}")))
            .when(t == "click", F.concat(F.lit('{"accounts":[{},{}],"total":"'), k, F.lit('","credits_cost":true}')))
            .when(t == "view", F.concat(F.lit('{"accounts":[1,2],"credits_cost":'), v, F.lit(',"credits_left":"x"}')))
            .when(t == "error", F.lit("<html>busy</html>")).otherwise(F.lit('{"accounts":{},"credits_cost":null}')))
    return B.events(s, d).select("event_id", body.alias("body")).select("event_id", *tables.response_totals("body"))


@query("S6_normalise_entity", with_("ent", f""" SELECT CAST(entity_id AS VARCHAR) AS entity_id, title, coalesce(nation, 'Unknown') AS country, '' AS published_at, CASE WHEN niche = 'BUILDING' THEN 0 ELSE subscribers END AS subscribers,
  CASE WHEN niche = 'FURNITURE' THEN 0 ELSE nation_key END::BIGINT AS item_count, 0::BIGINT AS view_count, coalesce(text, '') AS description, coalesce(list_extract({emails("coalesce(text, '')")}, 1), '') AS contact, CASE WHEN niche = 'MACHINERY' THEN '' ELSE handle END AS handle
  FROM ent LEFT JOIN documents ON doc_id = entity_id"""))
def _(s, d):
    bio = B.table(s, d, "documents").select(F.col("doc_id").alias("entity_id"), "text")
    e = B.entities(s, d).join(bio, "entity_id", "left")
    raw = F.struct(
        F.col("entity_id").cast("string").alias("id"),
        F.struct(F.col("title").alias("title"), F.col("nation").alias("country"), F.lit(None).cast("string").alias("publishedAt"), F.col("text").alias("description"),
                 F.when(F.col("niche") == "MACHINERY", F.col("handle")).otherwise(F.concat(F.lit("@"), "handle")).alias("customUrl")).alias("snippet"),
        F.struct(F.when(F.col("niche") != "BUILDING", F.col("subscribers").cast("string")).alias("subscriberCount"),
                 F.when(F.col("niche") == "FURNITURE", "many").otherwise(F.col("nation_key").cast("string")).alias("videoCount"), F.lit("1.5").alias("viewCount")).alias("statistics"))
    return tables.normalise_entity(e.select(raw.alias("raw")))


@query("S15_multi_source_index", with_("ext", " SELECT kind, key, source, CAST(source_rank AS INTEGER) AS source_rank FROM ext"))
def _(s, d):
    return tables.multi_source_index(B.external_tables(s, d))


# ---- sinks ----------------------------------------------------------------------------------

@query("S8_upsert", with_("ent", """ SELECT coalesce(o.entity_id, n.entity_id) AS entity_id, CASE WHEN n.entity_id IS NOT NULL THEN n.full_title ELSE o.title END AS title,
  CASE WHEN o.entity_id IS NOT NULL THEN o.niche ELSE 'New' END AS status, CASE WHEN o.entity_id IS NOT NULL THEN 'kept ' || o.handle ELSE '' END AS notes, CASE WHEN n.entity_id IS NOT NULL THEN n.subscribers + 1 ELSE o.subscribers END AS subscribers
  FROM (SELECT * FROM ent WHERE balance < 6000) o FULL JOIN (SELECT * FROM ent WHERE balance > 3000) n ON o.entity_id = n.entity_id"""))
def _(s, d):
    e = B.entities(s, d)
    old = e.where("balance < 6000").select("entity_id", "title", F.col("niche").alias("status"), F.concat(F.lit("kept "), "handle").alias("notes"), "subscribers")
    new = e.where("balance > 3000").select("entity_id", F.col("full_title").alias("title"), F.lit("New").alias("status"), F.lit("").alias("notes"), (F.col("subscribers") + 1).alias("subscribers"))
    return sinks.upsert(old, new, "entity_id")


@query("S9_guarded_delete", with_("ent", """, t(run, lo) AS (VALUES ('few', -950.0), ('many', 5000.0)), g AS (SELECT run, lo, count(*) FILTER (balance < lo) AS k, count(*) AS n FROM ent, t GROUP BY 1, 2)
  SELECT run, count(*) AS left_rows, sum(entity_id)::BIGINT AS checksum FROM ent, g WHERE NOT (k <= 25 AND k <= n * 0.5 AND balance < lo) GROUP BY 1"""))
def _(s, d):
    e = B.entities(s, d).select("entity_id", "balance")
    runs = [sinks.guarded_delete(e, "entity_id", e.where(F.col("balance") < lo)).withColumn("run", F.lit(run)) for run, lo in (("few", -950.0), ("many", 5000.0))]
    return reduce(DataFrame.unionByName, runs).groupBy("run").agg(F.count(F.lit(1)).alias("left_rows"), F.sum("entity_id").alias("checksum"))


_RUNS = "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run, 'k' || json_extract_string(props, '$.k') AS reason, count(*) AS n FROM events GROUP BY 1, 2"


def _run_reasons(s, d):
    return B.events(s, d).groupBy(F.to_date("ts").cast("string").alias("run"), F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("S10_append_run_record", f"SELECT run, reason, n, greatest(0, total - 20) AS truncated FROM (SELECT *, count(*) OVER (PARTITION BY run) AS total, row_number() OVER (PARTITION BY run ORDER BY n DESC, reason) AS rn FROM ({_RUNS})) WHERE rn <= 20")
def _(s, d):
    path = scratch_dir(s, "run-records")
    top = sinks.top_reasons(_run_reasons(s, d), ["run"], "reason", "n")
    lines = top.groupBy("run", "truncated").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("reason", "n")))).alias("drop_reasons"))
    sinks.append_run_records(lines, path)
    back = s.read.schema("run string, truncated bigint, drop_reasons map<string, bigint>").json(path)
    return back.select("run", "truncated", F.explode("drop_reasons").alias("reason", "n"))


@query("S12_enum_guard", "SELECT c_mktsegment AS value, count(*) AS n FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'FURNITURE', 'MACHINERY') GROUP BY 1")
def _(s, d):
    e = B.entities(s, d)
    known = sinks.enum_guard(e.where(F.col("niche").isin("BUILDING", "FURNITURE", "MACHINERY")), "niche", ["BUILDING", "FURNITURE", "MACHINERY"])
    bad = sinks.unknown_options(e, "niche", ["BUILDING", "FURNITURE", "MACHINERY"])
    return bad.unionByName(sinks.unknown_options(known.select("niche"), "niche", ["BUILDING", "FURNITURE", "MACHINERY"]))


@query("S13_published_row", with_("ent itm pos", REUPLOADS + GATED + """ SELECT entity_id, CASE WHEN niche = 'BUILDING' THEN '''=' || title ELSE title END AS title, subscribers, round(avg_views, 1) AS avg_views, round(engagement_rate, 2) AS engagement_rate,
  CAST(CAST(round_even(per_month, 0) AS BIGINT) AS VARCHAR) || ' videos/month' AS upload_frequency, coalesce(lang, 'Unknown') AS language, '' AS email, 'Qualified' AS qualification, 'New' AS status, 'discovery (a, b)' AS source, '' AS notes, niche, '2001-08-01' AS date_added, 'x_' || entity_id AS handle
  FROM gated LEFT JOIN (SELECT doc_id, lang FROM documents) ON doc_id = entity_id WHERE reason IS NULL""", recursive=True))
def _(s, d):
    e = gated_rows(s, d).where("reason is null").withColumn("title", F.when(F.col("niche") == "BUILDING", F.concat(F.lit("="), "title")).otherwise(F.col("title")))
    e = e.select("*", F.array(F.lit("a"), F.lit("b")).alias("matched_keywords"), F.lit("").alias("email"), F.lit(0.0).alias("risk"), F.lit(0.0).alias("score"), F.lit("Qualified").alias("qualification"))
    e = e.withColumn("handle", F.concat(F.lit("x_"), F.col("entity_id")))
    return sinks.published_rows(e, ["handle"], day="2001-08-01").drop("risk", "score")


@query("S14_sparse_patch", f"""SELECT doc_id, CASE WHEN lang = 'de' THEN 'typed@hand.example' WHEN e <> '' THEN e ELSE NULL END AS email, CASE WHEN e <> '' THEN 'About description' ELSE 'none found (all 5 steps ran)' END AS email_source
  FROM (SELECT doc_id, lang, CASE WHEN lang = 'de' THEN '' ELSE coalesce(list_extract({emails('text')}, 1), '') END AS e FROM documents)""")
def _(s, d):
    docs = B.table(s, d, "documents")
    e = F.when(F.col("lang") == "de", "").otherwise(links.first_email("text"))
    found = docs.select("doc_id", e.alias("email")).withColumn("source", F.when(F.col("email") != "", V.CONTACT_SOURCES[1]))
    patch = sinks.sparse_patch(found, "doc_id", "email", "source")
    old = docs.select("doc_id", F.when(F.col("lang") == "de", "typed@hand.example").alias("email"), F.lit("").alias("email_source"))
    return sinks.upsert(old, patch, "doc_id", protected=(), sparse=True)


# ---- suppression and matching ---------------------------------------------------------------

_EKEY = f"""ekey AS (SELECT entity_id, 'handle' AS kind, 0 AS rank, handle AS key, 'handle @' || handle AS detail FROM ent
  UNION ALL SELECT entity_id, 'email', 1, 'supplier.' || lpad(CAST(entity_id AS VARCHAR), 9, '0') || '@mail.example.com', 'email supplier.' || lpad(CAST(entity_id AS VARCHAR), 9, '0') || '@mail.example.com' FROM ent WHERE niche <> 'FURNITURE'
  UNION ALL SELECT entity_id, 'name', 2, {fold('title')}, 'name ''' || title || '''' FROM ent)"""
HITS_SQL = "hit AS (SELECT entity_id, arg_min(detail, rank) AS hit FROM ekey JOIN supkey USING (kind, key) GROUP BY 1)"


def with_email(s, d):
    """Entities with a derived contact address (blank for one niche)."""
    mail = F.concat(F.lit(" Supplier."), F.lpad(F.col("entity_id").cast("string"), 9, "0"), F.lit("@mail.example.com"))
    return B.entities(s, d).withColumn("email", F.when(F.col("niche") != "FURNITURE", mail).otherwise(F.lit(" ")))


def hits(s, d):
    return matching.suppression_hits(with_email(s, d), B.suppression_rows(s, d), handle="handle", email="email", name="title")


@query("J1_suppression_hits", with_("ent sup supkey", f", {_EKEY}, {HITS_SQL} SELECT * FROM hit"))
def _(s, d):
    return hits(s, d)


@query("J1_suppress", with_("ent sup supkey", f", {_EKEY}, {HITS_SQL} SELECT entity_id, title FROM ent WHERE entity_id NOT IN (SELECT entity_id FROM hit)"))
def _(s, d):
    return matching.suppress(with_email(s, d), B.suppression_rows(s, d), handle="handle", email="email", name="title").select("entity_id", "title")


@query("J2_suppression_index", with_("sup supkey", " SELECT kind, key FROM supkey"))
def _(s, d):
    return matching.suppression_index(B.suppression_rows(s, d))


@query("J3_match_external", with_("ent ext", f""" SELECT entity_id, arg_min(source, rank * 10 + source_rank) AS source FROM (SELECT entity_id, 'handle' AS kind, 0 AS rank, handle AS key FROM ent
  UNION ALL SELECT entity_id, 'name', 2, {fold('title')} FROM ent) JOIN ext USING (kind, key) GROUP BY 1"""))
def _(s, d):
    return matching.match_external(B.entities(s, d), tables.multi_source_index(B.external_tables(s, d)))


@query("J4_drop_known", with_("ent", " SELECT entity_id FROM ent WHERE entity_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-05-01')"))
def _(s, d):
    known = B.plain_items(s, d).where("published_at >= timestamp '2001-05-01'").select("entity_id").distinct()
    return matching.drop_known(B.entities(s, d).select("entity_id"), known)


def _keep_sets(s, d):
    e = B.entities(s, d)
    return [
        matching.suppression_keys(B.suppression_rows(s, d)).where("kind = 'handle'").select("key"),
        e.where("balance > 9000").select("handle"),
        e.where("niche = 'BUILDING' and balance < 0").select("handle"),
        e.where("nation_key = 3").select("handle"),
    ]


_KEEP = """keep AS (SELECT DISTINCT handle FROM (SELECT key AS handle FROM supkey WHERE kind = 'handle' UNION ALL SELECT handle FROM ent WHERE balance > 9000
  UNION ALL SELECT handle FROM ent WHERE niche = 'BUILDING' AND balance < 0 UNION ALL SELECT handle FROM ent WHERE nation_key = 3))"""


@query("J5_exclude_set", with_("ent sup supkey ext", f""", {_KEEP} SELECT handle, 'must_keep' AS origin FROM keep UNION ALL SELECT key, 'external' FROM (
  SELECT key, row_number() OVER (ORDER BY CASE WHEN contains(lower(source), 'south') THEN 0 ELSE 1 END, key) AS rn FROM ext WHERE kind = 'handle' AND key NOT IN (SELECT handle FROM keep)) WHERE rn <= greatest(0, 400 - (SELECT count(*) FROM keep))"""))
def _(s, d):
    ext = tables.multi_source_index(B.external_tables(s, d)).where("kind = 'handle'")
    return matching.exclude_set(_keep_sets(s, d), ext, "South", cap=400)


@query("J7_backfill", with_("ent", """ SELECT e.entity_id, CASE WHEN nation IS NULL THEN r_name ELSE nation END AS nation, CASE WHEN nation IS NOT NULL THEN 'kept' WHEN r_name IS NOT NULL THEN 'written' ELSE 'unresolved' END AS outcome
  FROM ent e LEFT JOIN (SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON r_regionkey = n_regionkey WHERE c_acctbal > 4000) ON c_custkey = entity_id"""))
def _(s, d):
    n = B.table(s, d, "nation").join(B.table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("nation_key"), F.col("r_name").alias("nation"))
    lookup = B.entities(s, d).where("balance > 4000").select("entity_id", "nation_key").join(n, "nation_key").select("entity_id", "nation")
    return tables.backfill(B.entities(s, d).select("entity_id", "nation"), lookup, "entity_id", "nation")


@query("J8_audit_suppression", with_("ent sup supkey", f", {_EKEY}, {HITS_SQL} SELECT entity_id, title, CASE WHEN hit IS NULL THEN niche ELSE 'Blocklisted' END AS status, hit FROM ent LEFT JOIN hit USING (entity_id)"))
def _(s, d):
    tracked = with_email(s, d).select("entity_id", "title", F.col("niche").alias("status"), "handle", "email")
    h = matching.suppression_hits(tracked, B.suppression_rows(s, d), handle="handle", email="email", name="title")
    marked = sinks.upsert(tracked.select("entity_id", "title", "status"), h.select("entity_id", F.lit("Blocklisted").alias("status")), "entity_id", protected=(), sparse=True)
    return marked.join(h, "entity_id", "left")


@query("J9_find_duplicates", with_("ent ext", " SELECT entity_id, source FROM ent JOIN ext ON key = handle AND kind = 'handle'"))
def _(s, d):
    return matching.find_duplicates(B.entities(s, d).select("entity_id", "handle"), tables.multi_source_index(B.external_tables(s, d))).select("entity_id", "source")


@query("J10_allowlist", with_("ent", """, a AS (SELECT s_name AS title FROM supplier UNION SELECT title FROM ent WHERE nation_key < 5) SELECT title, CASE WHEN title IN (SELECT title FROM ent WHERE balance < 500) THEN 'approved' ELSE 'unmatched' END AS outcome FROM a"""))
def _(s, d):
    e = B.entities(s, d)
    names = B.table(s, d, "supplier").select(F.col("s_name").alias("title")).unionByName(e.where("nation_key < 5").select("title"))
    return matching.allowlist(e.where("balance < 500"), names)


@query("J11_label_join", "SELECT doc_id, n_chars AS score, CASE quality WHEN 1 THEN 'Approved' ELSE 'Rejected' END AS status FROM documents JOIN labels USING (doc_id) WHERE toxic = 0")
def _(s, d):
    v = B.table(s, d, "documents").select("doc_id", F.col("n_chars").alias("score"))
    lab = B.labels(s, d).select("doc_id", F.when(F.col("toxic") != 0, "Contacted").when(F.col("quality") == 1, "Approved").otherwise("Rejected").alias("status"))
    return matching.label_join(v, lab, "doc_id", "status", ["Approved", "Rejected"])


_CKEY = "CASE WHEN event_type IN ('view', 'click') THEN 'video' ELSE 'text' END AS tier, CAST(user_id AS VARCHAR) AS subject, CAST(json_extract_string(props, '$.k') AS BIGINT) // 10 AS start_s, left(sha256(event_type), 16) AS digest, 'm' || event_id % 2 AS model, CAST(json_extract_string(props, '$.k') AS BIGINT) // 10 + 1 + event_id % 3 AS end_s"


@query("J12_verdict_lookup", f"""WITH r AS (SELECT event_id, {_CKEY}, 'v1' AS version FROM events WHERE ts >= TIMESTAMP '2024-01-15'), c AS (SELECT {_CKEY}, 'v1' AS version, max(value) AS verdict FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1, 2, 3, 4, 5, 6, 7)
  SELECT event_id, verdict, verdict IS NOT NULL AS hit FROM r LEFT JOIN c USING (tier, model, subject, start_s, end_s, digest, version)""")
def _(s, d):
    start = F.floor(F.get_json_object("props", "$.k").cast("bigint") / 10)
    e = B.events(s, d).select(
        "event_id", "ts", "value", F.concat(F.lit("m"), F.col("event_id") % 2).alias("model"), (start + 1 + F.col("event_id") % 3).alias("end_s"), F.when(F.col("event_type").isin("view", "click"), "video").otherwise("text").alias("tier"), F.col("user_id").cast("string").alias("subject"),
        start.alias("start_s"), F.substring(F.sha2("event_type", 256), 1, 16).alias("digest"), F.lit("v1").alias("version"))
    keys = ["tier", "model", "subject", "start_s", "end_s", "digest", "version"]
    cache = e.where("ts < timestamp '2024-01-15'").groupBy(*keys).agg(F.max("value").alias("verdict"))
    return matching.verdict_lookup(e.where("ts >= timestamp '2024-01-15'").select("event_id", *keys), cache, keys).select("event_id", "verdict", "hit")


# ---- set operations -------------------------------------------------------------------------

@query("U1_union_known", "SELECT DISTINCT id FROM (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01')")
def _(s, d):
    a = B.entities(s, d).where("balance > 5000").select("entity_id")
    return tables.known_ids([a, B.plain_items(s, d).where("published_at >= timestamp '2001-06-01'").select("entity_id")], "entity_id")


@query("U2_must_keep", with_("ent sup supkey", f", {_KEEP} SELECT handle FROM keep"))
def _(s, d):
    return reduce(DataFrame.unionByName, [k.toDF("handle") for k in _keep_sets(s, d)]).distinct()


@query("U3_difference", with_("ent sup supkey", f", {_KEEP} SELECT handle FROM ent EXCEPT SELECT handle FROM keep"))
def _(s, d):
    keep = reduce(DataFrame.unionByName, [k.toDF("handle") for k in _keep_sets(s, d)])
    return B.entities(s, d).select("handle").join(keep, "handle", "left_anti").distinct()


@query("U5_restricted_categories", "SELECT lang AS niche, source AS category, count(*) AS n FROM documents WHERE lang = 'en' OR (lang, source) IN (('fr', 'src1'), ('fr', 'src2'), ('de', 'src3')) GROUP BY 1, 2")
def _(s, d):
    got = B.table(s, d, "documents").groupBy(F.col("lang").alias("niche"), F.col("source").alias("category")).agg(F.count(F.lit(1)).alias("n"))
    allowed = {"fr": ["src1", "src2"], "de": ["src3"], "es": []}  # a niche without a list keeps every category
    keep = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*[F.lit(v) for v in x]).cast("array<string>") for kv in allowed.items() for x in kv])
    mine = F.try_element_at(keep, F.col("niche"))
    return got.where(mine.isNull() | F.array_contains(mine, F.col("category")))


# ---- budgets --------------------------------------------------------------------------------

_QUAL = "CASE WHEN subscribers < 200000 THEN 'New Channel' ELSE 'Qualified' END"
_CAPS = "caps(niche, qualification, cap) AS (VALUES ('BUILDING', 'Qualified', 30), ('BUILDING', 'New Channel', 5), ('FURNITURE', 'Qualified', 12), ('FURNITURE', 'New Channel', 0), ('MACHINERY', 'Qualified', 3))"
_CAP_ROWS = [("BUILDING", "Qualified", 30), ("BUILDING", "New Channel", 5), ("FURNITURE", "Qualified", 12), ("FURNITURE", "New Channel", 0), ("MACHINERY", "Qualified", 3)]


def _candidates(s, d):
    return B.entities(s, d).select("entity_id", "niche", F.when(F.col("subscribers") < 200000, V.NEW_ENTITY).otherwise(V.QUALIFIED).alias("qualification"))


def _caps(df):
    rows = F.array(*[F.struct(F.lit(n).alias("niche"), F.lit(q).alias("qualification"), F.lit(c).alias("cap")) for n, q, c in _CAP_ROWS])
    return df.sparkSession.range(1).select(F.explode(rows).alias("r")).select("r.*")


_USED = f"used AS (SELECT niche, {_QUAL} AS qualification, count(*) AS used FROM ent WHERE balance > 9900 GROUP BY 1, 2), room AS (SELECT niche, qualification, greatest(0, cap - coalesce(used, 0)) AS headroom FROM caps LEFT JOIN used USING (niche, qualification))"


def _room(s, d):
    used = B.entities(s, d).where("balance > 9900").select("niche", F.when(F.col("subscribers") < 200000, V.NEW_ENTITY).otherwise(V.QUALIFIED).alias("qualification")).groupBy("niche", "qualification").agg(F.count(F.lit(1)).alias("used"))
    return budgets.headroom(_caps(B.entities(s, d)), used, ["niche", "qualification"])


@query("A12_headroom", with_("ent", f", {_CAPS}, {_USED} SELECT niche, qualification, CAST(headroom AS BIGINT) AS headroom FROM room"))
def _(s, d):
    return _room(s, d)


@query("W4_fill_budgets", with_("ent", f""", {_CAPS}, {_USED} SELECT entity_id, niche, qualification, CAST(slot AS INTEGER) AS slot FROM (SELECT entity_id, niche, {_QUAL} AS qualification, row_number() OVER (PARTITION BY niche, {_QUAL} ORDER BY entity_id) AS slot FROM ent)
  JOIN room USING (niche, qualification) WHERE slot <= headroom"""))
def _(s, d):
    return budgets.fill_budgets(_candidates(s, d), _room(s, d), ["entity_id"]).select("entity_id", "niche", "qualification", "slot")


def _scan_sql(q, f, patience):
    """Step-by-step statement of the same loop as a recursive query."""
    return f"""WITH RECURSIVE e AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events),
  st AS (SELECT DISTINCT user_id, 0::BIGINT AS rn, 0 AS q, 0 AS f, 0 AS w, 0::BIGINT AS scanned, 'run' AS st FROM e
   UNION ALL SELECT user_id, rn, CASE WHEN go AND event_type = 'purchase' AND q < {q} THEN q + 1 ELSE q END, CASE WHEN go AND event_type = 'signup' AND f < {f} THEN f + 1 ELSE f END,
     CASE WHEN NOT go THEN w WHEN event_type = 'signup' THEN 0 WHEN q >= {q} THEN w + 1 ELSE w END, CASE WHEN go THEN scanned + 1 ELSE scanned END, CASE WHEN go THEN 'run' ELSE why END FROM (
      SELECT s.user_id, e.rn, s.q, s.f, s.w, s.scanned, e.event_type, s.st = 'run' AND NOT (s.q >= {q} AND s.f >= {f}) AND NOT (s.q >= {q} AND s.w >= {patience}) AS go,
       CASE WHEN s.st <> 'run' THEN s.st WHEN s.q >= {q} AND s.f >= {f} THEN 'both_full' ELSE 'patience' END AS why FROM st s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1))
  SELECT user_id, arg_max(scanned, rn) AS scanned, CAST(arg_max(q, rn) AS BIGINT) AS taken_qualified, CAST(arg_max(f, rn) AS BIGINT) AS taken_flagged FROM st GROUP BY 1"""


def _scan(s, d, q, f, patience):
    kind = F.when(F.col("event_type") == "purchase", "qualified").when(F.col("event_type") == "signup", "flagged")
    return budgets.scan_end(B.events(s, d), "user_id", ["ts", "event_id"], kind, q, f, patience).drop("ended_by")


@query("W5_stop_after_fruitless", _scan_sql(4, 9, 10))
def _(s, d):
    return _scan(s, d, 4, 9, 10)


@query("W5_stop_small_budgets", _scan_sql(1, 2, 5))
def _(s, d):
    return _scan(s, d, 1, 2, 5)


_CLAIM_NICHES = ["MACHINERY", "BUILDING", "AUTOMOBILE"]
_CANDS = "cand AS (SELECT entity_id, niche, subscribers FROM ent UNION ALL SELECT entity_id, 'BUILDING', subscribers FROM ent WHERE niche = 'MACHINERY' UNION ALL SELECT entity_id, 'AUTOMOBILE', subscribers FROM ent WHERE niche = 'BUILDING')"


@query("W7_first_niche_claims", with_("ent", f""", {_CANDS}, a AS (SELECT entity_id, niche FROM cand WHERE niche = 'MACHINERY' ORDER BY subscribers DESC, entity_id LIMIT 40),
  b AS (SELECT entity_id, niche FROM cand WHERE niche = 'BUILDING' AND entity_id NOT IN (SELECT entity_id FROM a) ORDER BY subscribers DESC, entity_id LIMIT 40),
  c AS (SELECT entity_id, niche FROM cand WHERE niche = 'AUTOMOBILE' AND entity_id NOT IN (SELECT entity_id FROM a) AND entity_id NOT IN (SELECT entity_id FROM b) ORDER BY subscribers DESC, entity_id LIMIT 40)
  SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c"""))
def _(s, d):
    e = B.entities(s, d).select("entity_id", "niche", "subscribers")
    cand = e.unionByName(e.where("niche = 'MACHINERY'").withColumn("niche", F.lit("BUILDING"))).unionByName(e.where("niche = 'BUILDING'").withColumn("niche", F.lit("AUTOMOBILE")))
    return budgets.first_niche_claims(cand, _CLAIM_NICHES, 40, [F.desc("subscribers"), F.asc("entity_id")]).select("entity_id", "niche")


@query("W9_rank_external", with_("ext", " SELECT key, source, CASE WHEN contains(lower(source), 'south') THEN 0 ELSE 1 END AS priority FROM ext WHERE kind = 'handle'"))
def _(s, d):
    return matching.rank_external(tables.multi_source_index(B.external_tables(s, d)).where("kind = 'handle'"), "South")


@query("W12_claim_tiebreak", "SELECT event_id, CASE WHEN event_id = min(event_id) OVER (PARTITION BY user_id, event_type) THEN 'granted' ELSE 'lost_verify' END AS outcome FROM events")
def _(s, d):
    e = B.events(s, d).select("event_id", text.claim_key("user_id", "event_type").alias("key"))
    return budgets.claim_tiebreak(e, "key", "event_id").select("event_id", "outcome")


@query("W14_top_bottom", "WITH j AS (SELECT doc_id, n_chars AS score, quality FROM documents JOIN labels USING (doc_id)) SELECT * FROM (SELECT *, 'top' AS side FROM j ORDER BY score DESC, doc_id LIMIT 8) UNION ALL SELECT * FROM (SELECT *, 'bottom' AS side FROM j ORDER BY score, doc_id LIMIT 8)")
def _(s, d):
    j = B.table(s, d, "documents").select("doc_id", F.col("n_chars").alias("score")).join(B.labels(s, d).select("doc_id", "quality"), "doc_id")
    return budgets.top_bottom(j, "score", "doc_id")
