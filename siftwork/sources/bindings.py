"""Stand-in tables: the given parquet tables read as entities, items, texts and ledgers.

Each function returns a lazy DataFrame; column pruning and filters reach the parquet scan.
Driver timestamps carry no zone and are read as UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import prepare

# What each nation stands for as a declared country, by nation key.
COUNTRY_BY_NATION = [
    "", "United States", "canada", "United  Kingdom", "Germany", "France", "India", "Japan", "kenya",
    "Brazil", "US", "gb", "Australia", "Viet Nam", "Unknown", "New Zealand", "Atlantis", "Ireland",
    "au", "Czech Republic", "England", "n/a", "South Korea", "USA", "Korea, South",
]


def flag(codes: str) -> str:
    """Two-letter codes as flag emoji."""
    return "".join(chr(0x1F1E6 + ord(c) - ord("A")) for c in codes)


_PLACES = ["Qatar", "Nepal", "Sri Lanka", "Hong Kong"]
# A title ending per nation key: flags, places as words in three spellings, places inside longer words, and plain endings.
TITLE_END_BY_NATION = [
    *[f" {flag(codes)}" for codes in ("QA", "CA", "NPGB", "USAU", "GB")],
    *[f" {p} {w}" for p, w in zip(_PLACES, ("Diary", "Eats", "by Bus", "Nights"))],
    *[f" meets {p.upper()}" for p in _PLACES],
    *[f" {p.replace(' ', '')}ese" for p in _PLACES],
    *[f" ({p.lower()})" for p in _PLACES[:2]],
    *[f" No. {i}" for i in range(6)],
]
# A text ending per item key digit, as cue, gap and place: told, too far off, on the next line, without a cue, in the zone.
TEXT_END_BY_DIGIT = [f" {cue}{gap}{place}." for cue, gap, place in (
    ("located in", " ", "Qatar"), ("Life in", " a small town a day's walk from ", "Nepal"), ("living in", "\n", "Sri Lanka"), ("Home base", ", for now: ", "Hong Kong"),
    ("moved to", " a place that is" + " far" * 20 + " from ", "Qatar"), ("", "Postcards about ", "Nepal"), ("home in", " ", "Australia"), ("", "", ""),
    ("from the old harbour in", " ", "Singapore"), ("Location -", " ", "Malaysia"))]
ZONE = ["US", "CA", "GB", "AU"]
ITEMS_AS_OF = "2001-08-01 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def _pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def entities(spark, folder) -> DataFrame:
    c = table(spark, folder, "customer")
    n = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("entity_id"),
        F.col("c_name").alias("title"),
        F.lower(F.replace("c_name", F.lit("#"), F.lit("_"))).alias("handle"),
        F.nullif("n_name", F.lit("NATION_0")).alias("nation"),
        _pick(COUNTRY_BY_NATION, F.col("c_nationkey")).alias("country"),
        F.concat("c_name", _pick(TITLE_END_BY_NATION, F.col("c_nationkey"))).alias("full_title"),
        F.floor(F.abs("c_acctbal") * 100).alias("subscribers"),
        F.col("c_mktsegment").alias("niche"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("c_acctbal").alias("balance"),
    )


def items(spark, folder) -> DataFrame:
    """One row per item with its engagement sums; newest first is (published_at desc, item_id)."""
    o = table(spark, folder, "orders")
    sums = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("item_id")).agg(F.sum("l_quantity").alias("q"))
    key = F.col("item_id")
    return (
        o.select(
            F.col("o_orderkey").alias("item_id"), F.col("o_custkey").alias("entity_id"),
            F.col("o_orderdate").cast("timestamp").alias("published_at"), "o_totalprice", "o_orderpriority", "o_orderstatus",
        )
        .join(sums, "item_id", "left")
        .select(
            "entity_id", "item_id", "published_at",
            F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("title"),
            F.when(key % 17 != 0, F.floor("o_totalprice")).alias("views"),
            F.coalesce(F.col("q").cast("bigint"), F.lit(0)).alias("engagements"),
            (F.col("q") * 10).cast("bigint").alias("seconds"),
            F.when(key % 4 == 0, 1280).when(key % 4 == 1, 720).when(key % 4 == 2, 720).alias("w"),
            F.when(key % 4 == 0, 720).when(key % 4 == 1, 1280).when(key % 4 == 2, 720).alias("h"),
        )
    )


def plain_items(spark, folder) -> DataFrame:
    """Items without engagement sums, for operators that read dates and counts only."""
    o = table(spark, folder, "orders")
    return o.select(
        F.col("o_custkey").alias("entity_id"), F.col("o_orderkey").alias("item_id"),
        F.col("o_orderdate").cast("timestamp").alias("published_at"),
        F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("title"),
        F.when(F.col("o_orderkey") % 17 != 0, F.floor("o_totalprice")).alias("views"),
        "o_orderstatus", "o_orderpriority",
    )


def documents(spark, folder) -> DataFrame:
    """Texts grouped by source; order within a source is item_id; the first line is the title."""
    d = table(spark, folder, "documents")
    k = F.col("doc_id") % 4
    return d.select(
        F.col("source").alias("entity_id"), F.col("doc_id").alias("item_id"),
        F.regexp_extract("text", r"^[^\n]*", 0).alias("title"), F.col("text").alias("description"), "lang",
        F.col("n_chars").alias("seconds"),
        F.when(k == 0, 1280).when(k == 1, 720).when(k == 2, 720).alias("w"),
        F.when(k == 0, 720).when(k == 1, 1280).when(k == 2, 720).alias("h"),
        F.concat("text", _pick(TEXT_END_BY_DIGIT, F.col("doc_id") % 10)).alias("placed_text"),
    )


def events(spark, folder) -> DataFrame:
    e = table(spark, folder, "events")
    return e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", "props")


CLAIM_STATE_BY_EVENT = {"signup": "Claimed", "purchase": "Sent", "error": "NotSent", "view": "MaybeSent", "click": "Paused"}


def claims(spark, folder) -> DataFrame:
    """Events read as send-log rows; ``click`` stands for a state outside the known four."""
    state = F.create_map(*[F.lit(x) for kv in CLAIM_STATE_BY_EVENT.items() for x in kv])
    return events(spark, folder).select(
        F.col("event_id").alias("record_id"), F.col("user_id").alias("entity_id"), "ts",
        F.try_element_at(state, F.col("event_type")).alias("state"), "props",
    )


def pages(spark, folder) -> DataFrame:
    return table(spark, folder, "pages")


def labels(spark, folder) -> DataFrame:
    return table(spark, folder, "labels")


def suppression_rows(spark, folder) -> DataFrame:
    """Suppliers as a do-not-contact list; some rows share a key with entities by number."""
    s = table(spark, folder, "supplier")
    k, num = F.col("s_suppkey"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")
    return s.select(
        k.alias("row_id"),
        F.when(k % 3 == 0, F.concat(F.lit(" customer#"), num)).when(k % 3 == 1, F.col("s_name")).otherwise(F.lit("")).alias("name"),
        F.when(k % 4 == 0, F.concat(F.lit("https://video.example/@Customer_"), num, F.lit("/about"))).otherwise(F.lit("")).alias("url"),
        F.when(k % 5 == 0, F.concat(F.lit("Supplier."), num, F.lit("@Mail.example.com "))).otherwise(F.lit("")).alias("email"),
    )


def external_tables(spark, folder) -> list[tuple[DataFrame, str, str, str]]:
    """Three tables with different link and name columns, in rank order: (table, label, link, name)."""
    num = lambda c: F.lpad(F.col(c).cast("string"), 9, "0")
    s = table(spark, folder, "supplier").select(
        F.concat(F.lit("https://video.example/@customer_"), num("s_suppkey")).alias("link"), F.col("s_name").alias("name"))
    c = table(spark, folder, "customer").where("c_acctbal > 8000").select(
        F.concat(F.lit("@Customer_"), num("c_custkey")).alias("url"), F.upper("c_name").alias("display"))
    n = table(spark, folder, "nation").select(
        F.lit("").alias("link"), F.concat(F.lit("Customer#"), num("n_nationkey")).alias("label"))
    return [(s, "Leads North", "link", "name"), (c, "Leads South", "url", "display"), (n, "Outreach West", "link", "label")]
