"""Sources: scans, known ids, multi-table indexes and nested records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.links import first_email
from ..functions.shape import duration_seconds, parse_ts
from ..functions.text import as_int, blank, fold_name, normalize_handle, strip


def scan(df: DataFrame, id_col: str, fields) -> DataFrame:
    """Projected full scan; a row counts only if it has an id."""
    return df.where(F.col(id_col).isNotNull() & ~blank(F.col(id_col).cast("string"))).select(id_col, *[f for f in fields if f != id_col])


def known_ids(tables, id_col: str) -> DataFrame:
    """Distinct non-blank ids over several tables. Reads fail fast: a partial set would re-admit rows."""
    ids = [t.select(F.col(id_col).cast("string").alias("id")) for t in tables]
    return reduce(DataFrame.unionByName, ids).where(~blank("id")).distinct()


def tracked_handles(df: DataFrame, col: str = "handle") -> DataFrame:
    """Distinct bare lower-case handles; empty when the table has no such column."""
    if col not in df.columns:
        return df.limit(0).select(F.lit("").alias("handle"))
    key = F.lower(F.regexp_replace(strip(col), "^@+", ""))
    return df.select(key.alias("handle")).where(F.length("handle") > 0).distinct()


CREATORS = "struct<accounts:array<struct<user_id:string,profile:struct<username:string,full_name:string>>>>"


def flatten_creators(df: DataFrame, json_col: str, order_cols, label) -> DataFrame:
    """Nested accounts to one candidate per handle, first occurrence wins, rows without a handle dropped."""
    acc = df.select(*order_cols, F.posexplode(F.from_json(json_col, CREATORS)["accounts"]).alias("pos", "a"))
    flat = acc.select(
        F.struct(*[F.col(c) for c in order_cols], F.col("pos")).alias("ord"),
        normalize_handle("a.profile.username").alias("handle"),
        F.coalesce("a.profile.full_name", F.lit("")).alias("title"), F.col("a.user_id").alias("user_id"),
    ).where("handle <> ''")
    first = F.min_by(F.struct("title", "user_id"), "ord")
    return flat.groupBy("handle").agg(first.alias("f")).select(
        "handle", "f.title", "f.user_id", F.array(F.lit(label)).alias("matched"))


def response_totals(json_col: str):
    """Typed total, cost and balance of a response body; wrong types fall to defaults."""
    body = F.col(json_col)

    def raw(name):
        return F.get_json_object(body, f"$.{name}")

    def number(name):
        quoted = body.rlike(rf'"{name}"\s*:\s*"')
        return F.when(~quoted, raw(name).try_cast("double"))

    accounts = F.coalesce(F.json_array_length(raw("accounts")), F.lit(0)).cast("bigint")
    whole = F.when(raw("total").rlike(r"^-?\d+$") & ~body.rlike(r'"total"\s*:\s*"'), raw("total").try_cast("bigint"))
    return [
        F.coalesce(whole, accounts).alias("total"),
        F.coalesce(number("credits_cost"), F.lit(0.0)).alias("cost"),
        number("credits_left").alias("balance"),
    ]


def normalise_entity(df: DataFrame) -> DataFrame:
    """Raw nested entity to the flat shape: null-safe counters, default country, derived handle and contact."""
    s, st = "raw.snippet", "raw.statistics"
    return df.select(
        F.col("raw.id").alias("entity_id"),
        F.col(f"{s}.title").alias("title"),
        F.coalesce(f"{s}.country", F.lit("Unknown")).alias("country"),
        F.coalesce(f"{s}.publishedAt", F.lit("")).alias("published_at"),
        as_int(f"{st}.subscriberCount").alias("subscribers"),
        as_int(f"{st}.videoCount").alias("item_count"),
        as_int(f"{st}.viewCount").alias("view_count"),
        F.coalesce(f"{s}.description", F.lit("")).alias("description"),
        first_email(f"{s}.description").alias("contact"),
        normalize_handle(f"{s}.customUrl").alias("handle"),
    )


def normalise_items(df: DataFrame) -> DataFrame:
    """Raw nested items to the flat shape. An absent view count stays null; an unreadable one counts as 0."""
    s, st = "raw.snippet", "raw.statistics"
    views = F.when(F.col(f"{st}.viewCount").isNotNull(), as_int(f"{st}.viewCount"))
    return df.select(
        "entity_id", F.col("raw.id").alias("item_id"),
        F.coalesce(f"{s}.title", F.lit("")).alias("title"),
        F.coalesce(f"{s}.description", F.lit("")).alias("description"),
        parse_ts(F.col(f"{s}.publishedAt")).alias("published_at"),
        views.alias("views"),
        (as_int(f"{st}.likeCount") + as_int(f"{st}.commentCount")).alias("engagements"),
        duration_seconds("raw.contentDetails.duration").alias("seconds"),
        F.col("raw.player.embedWidth").alias("w"), F.col("raw.player.embedHeight").alias("h"),
        F.coalesce(F.nullif(F.col(f"{s}.defaultAudioLanguage"), F.lit("")), F.nullif(F.col(f"{s}.defaultLanguage"), F.lit("")), F.lit("")).alias("language"),
    )


def missing_value(df: DataFrame, id_col: str, col: str) -> DataFrame:
    """Rows that have an id and a blank ``col``."""
    return df.where(~blank(F.col(id_col).cast("string")) & blank(F.col(col).cast("string")))


def multi_source_index(tables) -> DataFrame:
    """Several tables with their own link and name columns as ``(kind, key, source, source_rank)``.

    One row per (kind, key): the earliest source wins. ``tables`` is a list of
    ``(df, label, link_col, name_col)`` in rank order.
    """
    parts = []
    for rank, (df, label, link, name) in enumerate(tables):
        keys = df.select(F.explode(F.array(
            F.struct(F.lit("handle").alias("kind"), normalize_handle(link).alias("key")),
            F.struct(F.lit("name").alias("kind"), fold_name(name).alias("key")),
        )).alias("k"))
        parts.append(keys.select("k.kind", "k.key", F.lit(label).alias("source"), F.lit(rank).alias("source_rank")))
    return (
        reduce(DataFrame.unionByName, parts).where("key <> ''")
        .groupBy("kind", "key").agg(F.min_by("source", "source_rank").alias("source"), F.min("source_rank").alias("source_rank"))
    )


def backfill(df: DataFrame, lookup: DataFrame, key: str, col: str) -> DataFrame:
    """Fill a blank column from a lookup and say what happened to each row."""
    found = lookup.select(key, F.col(col).alias("_found"))
    was_blank = blank(F.col(col))
    return df.join(found, key, "left").select(
        *[c for c in df.columns if c != col],
        F.when(was_blank & ~blank("_found"), F.col("_found")).otherwise(F.col(col)).alias(col),
        F.when(~was_blank, F.lit("kept")).when(~blank("_found"), F.lit("written")).otherwise(F.lit("unresolved")).alias("outcome"),
    )


