"""The stand-in tables of ``sources.bindings`` restated for the oracle engine, and small SQL snippets."""

from __future__ import annotations

from ..functions import fixed_values as V
from ..sources import bindings as B


def lit(x) -> str:
    return "'" + str(x).replace("'", "''") + "'"


def lst(xs) -> str:
    return "[" + ", ".join(lit(x) for x in xs) + "]"


def ins(xs) -> str:
    return "(" + ", ".join(lit(x) for x in xs) + ")"


def mapping(d) -> str:
    return "MAP {" + ", ".join(f"{lit(k)}: {lit(v)}" for k, v in d.items()) + "}"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def fold(x: str) -> str:
    return f"replace(lower({x}), 'ß', 'ss')"


def norm_handle(x: str) -> str:
    return f"lower(regexp_extract(coalesce({x}, ''), {lit(V.HANDLE_PATTERN)}, 1))"


def norm_title(x: str) -> str:
    cut = f"regexp_replace({strip(x)}, {lit(V.TITLE_SUFFIX_PATTERN)}, '')"
    return f"trim(regexp_replace(regexp_replace({fold(cut)}, '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"


def fold_name(x: str) -> str:
    return fold(f"regexp_replace({strip(f'coalesce({x}, chr(32))')}, '\\s+', ' ', 'g')")


def word(terms) -> str:
    """Word match with the boundary spelled out (letters, digits, underscore count as word)."""
    import re

    alt = "|".join(re.escape(t) for t in terms)
    return lit(rf"(?i)(^|[^\p{{L}}\p{{N}}_])(?:{alt})($|[^\p{{L}}\p{{N}}_])")


def days(a: str, b: str) -> str:
    return f"CAST(floor((epoch_us(CAST({b} AS TIMESTAMP)) - epoch_us(CAST({a} AS TIMESTAMP))) / 86400000000.0) AS BIGINT)"


def local_day(ts: str, tz: str) -> str:
    return f"CAST(timezone({lit(tz)}, timezone('UTC', {ts})) AS DATE)"


def half_up(x: str, places: int) -> str:
    """Half-up rounding of the number as written; the oracle's own ``round`` scales the double first and can miss a tie."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), {places}) AS DOUBLE)"


SHORT = "CASE WHEN w > 0 AND h > 0 AND CAST(w AS DOUBLE) / h <= 0.95 THEN TRUE ELSE seconds <= {0} END"


def emails(col: str, domains=V.THIRD_PARTY_DOMAINS) -> str:
    return f"list_filter(regexp_extract_all({col}, {lit(V.EMAIL_PATTERN)}), lambda e: NOT (lower(split_part(e, '@', -1)) IN {ins(domains)}))"



CTES = {
    "ent": f"""ent AS (SELECT c_custkey AS entity_id, c_name AS title, lower(replace(c_name, '#', '_')) AS handle,
      NULLIF(n_name, 'NATION_0') AS nation, list_extract({lst(B.COUNTRY_BY_NATION)}, c_nationkey + 1) AS country,
      c_name || list_extract({lst(B.TITLE_END_BY_NATION)}, c_nationkey + 1) AS full_title,
      CAST(floor(abs(c_acctbal) * 100) AS BIGINT) AS subscribers, c_mktsegment AS niche, c_nationkey AS nation_key, c_acctbal AS balance
      FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "itm": """itm AS (SELECT o_custkey AS entity_id, o_orderkey AS item_id, o_orderdate AS published_at,
      o_orderpriority || ' ' || o_orderstatus AS title,
      CASE WHEN o_orderkey % 17 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS views,
      CAST(coalesce(q, 0) AS BIGINT) AS engagements, CAST(q * 10 AS BIGINT) AS seconds,
      CASE o_orderkey % 4 WHEN 0 THEN 1280 WHEN 1 THEN 720 WHEN 2 THEN 720 END AS w,
      CASE o_orderkey % 4 WHEN 0 THEN 720 WHEN 1 THEN 1280 WHEN 2 THEN 720 END AS h
      FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)""",
    "pos": """pos AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY published_at DESC, item_id) AS position FROM itm)""",
    "doc": f"""doc AS (SELECT source AS entity_id, doc_id AS item_id, regexp_extract(text, '^[^\\n]*') AS title, text AS description, lang,
      n_chars AS seconds, CASE doc_id % 4 WHEN 0 THEN 1280 WHEN 1 THEN 720 WHEN 2 THEN 720 END AS w,
      CASE doc_id % 4 WHEN 0 THEN 720 WHEN 1 THEN 1280 WHEN 2 THEN 720 END AS h,
      text || list_extract({lst(B.TEXT_END_BY_DIGIT)}, doc_id % 10 + 1) AS placed_text,
      row_number() OVER (PARTITION BY source ORDER BY doc_id) AS position FROM documents)""",
    "clm": f"""clm AS (SELECT event_id AS record_id, user_id AS entity_id, ts, {mapping(B.CLAIM_STATE_BY_EVENT)}[event_type] AS state FROM events)""",
    "sup": """sup AS (SELECT s_suppkey AS row_id,
      CASE s_suppkey % 3 WHEN 0 THEN ' customer#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') WHEN 1 THEN s_name ELSE '' END AS name,
      CASE WHEN s_suppkey % 4 = 0 THEN 'https://video.example/@Customer_' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || '/about' ELSE '' END AS url,
      CASE WHEN s_suppkey % 5 = 0 THEN 'Supplier.' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || '@Mail.example.com ' ELSE '' END AS email
      FROM supplier)""",
    "supkey": f"""supkey AS (SELECT DISTINCT kind, key FROM (
      SELECT 'handle' AS kind, {norm_handle('url')} AS key FROM sup
      UNION ALL SELECT 'email', lower({strip('email')}) FROM sup
      UNION ALL SELECT 'name', {fold(strip('name'))} FROM sup) WHERE key <> '')""",
    "ext": f"""ext AS (SELECT kind, key, arg_min(source, source_rank) AS source, min(source_rank) AS source_rank FROM (
      SELECT 'handle' AS kind, 'customer_' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS key, 'Leads North' AS source, 0 AS source_rank FROM supplier
      UNION ALL SELECT 'name', {fold('s_name')}, 'Leads North', 0 FROM supplier
      UNION ALL SELECT 'handle', 'customer_' || lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 'Leads South', 1 FROM customer WHERE c_acctbal > 8000
      UNION ALL SELECT 'name', {fold('c_name')}, 'Leads South', 1 FROM customer WHERE c_acctbal > 8000
      UNION ALL SELECT 'name', 'customer#' || lpad(CAST(n_nationkey AS VARCHAR), 9, '0'), 'Outreach West', 2 FROM nation) GROUP BY 1, 2)""",
}


def with_(names: str, body: str, recursive: bool = False) -> str:
    """``names`` is a space-separated list of CTEs; ``body`` may start with further CTEs after a comma."""
    head = ",\n".join(CTES[n] for n in names.split())
    return f"WITH {'RECURSIVE ' if recursive else ''}{head}{body}"
