"""Suppression, already-tracked matching and exclusion sets.

Keys are long tables ``(kind, key)`` joined by equality. No side is force-broadcast: AQE
broadcasts a key list at run time when its measured size allows, otherwise the same join
shuffles on the key, and skewed keys are split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed_values as V
from ..functions.text import as_col, fold_name, handle_key, normalize_handle, strip, suppression_name


def suppression_keys(rows: DataFrame, name="name", url="url", email="email") -> DataFrame:
    """Distinct ``(kind, key)`` of a suppression list; blanks yield nothing."""
    keys = rows.select(F.explode(F.array(
        F.struct(F.lit("handle").alias("kind"), normalize_handle(url).alias("key")),
        F.struct(F.lit("email").alias("kind"), F.lower(strip(F.coalesce(as_col(email), F.lit("")))).alias("key")),
        F.struct(F.lit("name").alias("kind"), suppression_name(name).alias("key")),
    )).alias("k"))
    return keys.select("k.kind", "k.key").where("key <> ''").distinct()


def suppression_index(rows: DataFrame, name="name", url="url", email="email") -> DataFrame:
    """The keys to match against, failing the job when the list has no rows or no usable key.

    The check rides along as one more row of the index. Its ``kind`` is computed from the counts,
    so the filter that removes it must run, and an index that turns out empty has always been
    through the check first: an empty list cannot silently let everything pass.
    """
    keys = suppression_keys(rows, name, url, email)
    both = rows.select(F.lit(1).alias("r"), F.lit(0).alias("k")).unionByName(keys.select(F.lit(0).alias("r"), F.lit(1).alias("k")))
    counts = both.agg(F.coalesce(F.sum("r"), F.lit(0)).alias("r"), F.coalesce(F.sum("k"), F.lit(0)).alias("k"))
    checked = (
        F.when(F.col("r") == 0, F.raise_error(F.lit("suppression list has no rows")).cast("string"))
        .when(F.col("k") == 0, F.raise_error(F.lit("suppression list has no usable key")).cast("string"))
        .otherwise(F.lit("checked"))
    )
    return keys.unionByName(counts.select(checked.alias("kind"), F.lit("checked").alias("key"))).where("kind <> 'checked'")


def _handle_key(handle) -> Column:
    k = handle_key(handle)
    return F.struct(F.lit("handle").alias("kind"), F.lit(0).alias("rank"), k.alias("key"), F.concat(F.lit("handle @"), k).alias("detail"))


def _email_key(email) -> Column:
    e = F.lower(strip(F.coalesce(as_col(email), F.lit(""))))
    return F.struct(F.lit("email").alias("kind"), F.lit(1).alias("rank"), e.alias("key"), F.concat(F.lit("email "), e).alias("detail"))


def _name_key(name, for_external: bool = False, kind: str = "name") -> Column:
    n = fold_name(name) if for_external else suppression_name(name)
    shown = F.concat(F.lit("name '"), strip(F.coalesce(as_col(name), F.lit(""))), F.lit("'"))
    return F.struct(F.lit(kind).alias("kind"), F.lit(2).alias("rank"), n.alias("key"), shown.alias("detail"))


def _exploded(df: DataFrame, id_col: str, keys: list[Column]) -> DataFrame:
    return df.select(F.col(id_col), F.explode(F.array(*keys)).alias("k")).select(id_col, "k.*").where("key <> ''")


def entity_keys(df: DataFrame, id_col="entity_id", handle=None, email=None, name=None, for_external=False) -> DataFrame:
    """Entities as ``(id, kind, rank, key, detail)``; blank keys are dropped, so they never match."""
    keys = []
    if handle is not None:
        keys.append(_handle_key(handle))
    if email is not None:
        keys.append(_email_key(email))
    if name is not None:
        keys.append(_name_key(name, for_external))
    return _exploded(df, id_col, keys)


BLOCKED, KNOWN, RESCUED = 1, 2, 4


def tagged_index(suppression: DataFrame | None = None, external: DataFrame | None = None, known: DataFrame | None = None,
                 rescued: DataFrame | None = None) -> DataFrame:
    """All lists a candidate is held against as one index: ``(kind, key, bits, tracked)``, one row per key.

    ``bits`` tells which lists hold the key, ``tracked`` is the first external source that does. Names are folded
    differently for suppression and for external sources, so these are two kinds; ids are compared as text.
    A suppression list fails closed as in :func:`suppression_index`.
    """
    def part(df, kind, key, bit, tracked=None):
        none = F.lit(None).cast("struct<source_rank:int,source:string>")
        return df.select(kind.alias("kind"), key.alias("key"), F.lit(bit).alias("bits"), (none if tracked is None else tracked).alias("tracked"))

    parts = []
    if suppression is not None:
        parts.append(part(suppression_index(suppression), F.col("kind"), F.col("key"), BLOCKED))
    if external is not None:
        kind = F.when(F.col("kind") == "name", F.lit("tracked name")).otherwise(F.col("kind"))
        parts.append(part(external, kind, F.col("key"), 0, F.struct(F.col("source_rank").cast("int").alias("source_rank"), "source")))
    for ids, bit in ((known, KNOWN), (rescued, RESCUED)):
        if ids is not None:
            parts.append(part(ids, F.lit("id"), F.col(ids.columns[0]).cast("string"), bit))
    return reduce(DataFrame.unionByName, parts).groupBy("kind", "key").agg(F.bit_or("bits").alias("bits"), F.min("tracked").alias("tracked"))


def index_hits(df: DataFrame, index: DataFrame, id_col="entity_id", handle="handle", email="email", name="title") -> DataFrame:
    """What a :func:`tagged_index` knows of each entity, from one explode and one join: ``key_hit`` (first blocked handle or name),
    ``mail_hit``, ``tracked_in``, ``is_known``, ``is_rescued``. Entities without any hit have no row."""
    own_id = F.struct(F.lit("id").alias("kind"), F.lit(3).alias("rank"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), F.lit("").alias("detail"))
    mine = _exploded(df, id_col, [_handle_key(handle), _email_key(email), _name_key(name), _name_key(name, True, "tracked name"), own_id])
    has = lambda bit: F.col("bits").bitwiseAND(bit) != 0
    mail = F.col("kind") == "email"
    order = F.when(F.col("tracked").isNotNull(), F.struct("rank", "tracked.source_rank"))
    return mine.join(index, ["kind", "key"]).groupBy(id_col).agg(
        F.min_by("detail", F.when(has(BLOCKED) & ~mail, F.col("rank"))).alias("key_hit"),
        F.min(F.when(has(BLOCKED) & mail, F.col("detail"))).alias("mail_hit"),
        F.min_by("tracked.source", order).alias("tracked_in"),
        F.coalesce(F.bool_or(has(KNOWN)), F.lit(False)).alias("is_known"), F.coalesce(F.bool_or(has(RESCUED)), F.lit(False)).alias("is_rescued"))


def suppression_hits(df: DataFrame, rows: DataFrame, id_col="entity_id", handle=None, email=None, name=None) -> DataFrame:
    """One row per blocked entity with the first matching key in the order handle, email, name."""
    mine = entity_keys(df, id_col, handle, email, name)
    return mine.join(suppression_index(rows), ["kind", "key"]).groupBy(id_col).agg(F.min_by("detail", "rank").alias("hit"))


def suppress(df: DataFrame, rows: DataFrame, id_col="entity_id", handle=None, email=None, name=None) -> DataFrame:
    """Entities that no suppression key matches."""
    return df.join(suppression_hits(df, rows, id_col, handle, email, name), id_col, "left_anti")


def match_external(df: DataFrame, index: DataFrame, id_col="entity_id", handle="handle", name="title") -> DataFrame:
    """Source that already tracks an entity: by handle first, then by name."""
    mine = entity_keys(df, id_col, handle=handle, name=name, for_external=True)
    order = F.struct(F.col("rank"), F.col("source_rank"))
    return mine.join(index, ["kind", "key"]).groupBy(id_col).agg(F.min_by("source", order).alias("source"))


def drop_known(candidates: DataFrame, ids: DataFrame, id_col="entity_id") -> DataFrame:
    return candidates.join(ids.select(F.col(ids.columns[0]).alias(id_col)), id_col, "left_anti")


def _prioritised(index: DataFrame, hint: str) -> DataFrame:
    hinted = F.contains(F.lower("source"), F.lit(hint.lower())) if hint else F.lit(False)
    return index.select("key", "source", F.when(hinted, 0).otherwise(1).alias("priority"))


def rank_external(index: DataFrame, hint: str) -> DataFrame:
    """Handles with a priority: sources whose name contains the hint first, then alphabetical."""
    return _prioritised(index, hint).orderBy("priority", "key")


def exclude_set(must_keep: list[DataFrame], external: DataFrame, hint: str, cap: int = V.EXCLUDE_CAP) -> DataFrame:
    """Union of the must-keep handle sets, then external handles by priority into the room left under ``cap``.

    Must-keep rows are never cut. The external side is first reduced to its ``cap`` best rows by
    a distributed top-k, so the exact cut on the remaining room ranks at most ``cap`` rows.
    """
    keep = reduce(DataFrame.unionByName, [d.select(F.col(d.columns[0]).alias("handle")) for d in must_keep])
    keep = keep.where("handle <> ''").distinct()
    room = keep.agg(F.greatest(F.lit(0), F.lit(cap) - F.count(F.lit(1)))).scalar()
    ranked = _prioritised(external, hint).join(keep, F.col("key") == keep.handle, "left_anti")
    top = ranked.orderBy("priority", "key").limit(cap)
    numbered = top.withColumn("rn", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("priority", "key")))
    fits = numbered.where(F.col("rn") <= room).select(F.col("key").alias("handle"), F.lit("external").alias("origin"))
    return keep.select("handle", F.lit("must_keep").alias("origin")).unionByName(fits)


def find_duplicates(tracked: DataFrame, index: DataFrame, handle="handle") -> DataFrame:
    """Tracked rows whose handle another source already holds."""
    keys = index.where("kind = 'handle'").select("key", "source")
    return tracked.withColumn("key", handle_key(handle)).where("key <> ''").join(keys, "key")


def allowlist(targets: DataFrame, names: DataFrame, col="title") -> DataFrame:
    """Targets that are approved by name, and approved names no target has."""
    approved = names.select(F.col(names.columns[0]).alias(col)).distinct()
    kept = targets.select(col).distinct().join(approved, col, "left_semi").select(col, F.lit("approved").alias("outcome"))
    unmatched = approved.join(targets.select(col).distinct(), col, "left_anti").select(col, F.lit("unmatched").alias("outcome"))
    return kept.unionByName(unmatched)


def label_join(verdicts: DataFrame, labels: DataFrame, id_col: str, status_col: str, statuses) -> DataFrame:
    return verdicts.join(labels.where(F.col(status_col).isin(*statuses)), id_col)


def verdict_lookup(requests: DataFrame, cache: DataFrame, key_cols) -> DataFrame:
    """Requests with their cached verdict; a miss is work still to judge."""
    return requests.join(cache, list(key_cols), "left").withColumn("hit", F.col("verdict").isNotNull())


def items_by_order(order: DataFrame, stats: DataFrame) -> DataFrame:
    """Item facts re-attached to the authoritative order; items without facts drop out."""
    return order.join(stats, "item_id")
