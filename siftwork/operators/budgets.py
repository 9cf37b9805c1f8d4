"""Daily budgets: capped selection in order, early end of a scan, claims across niches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed_values as V


def headroom(caps: DataFrame, counts: DataFrame, keys) -> DataFrame:
    """``max(0, cap - used)`` per key; a key with no count yet has its whole cap."""
    return caps.join(counts, list(keys), "left").select(
        *keys, F.greatest(F.lit(0), F.col("cap") - F.coalesce("used", F.lit(0))).cast("bigint").alias("headroom"))


def _largest(room: DataFrame) -> int:
    """The largest budget, read from the budget table itself: a few rows, so a small job while the plan is built."""
    return int(room.agg(F.max("headroom")).first()[0] or 0)


def fill_budgets(candidates: DataFrame, room: DataFrame, order, keys=("niche", "qualification")) -> DataFrame:
    """Rows taken in order while their (niche, class) budget lasts.

    No budget is above the largest one, so the ranking keeps at most that many rows per class and task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = candidates.withColumn("slot", F.row_number().over(w)).where(F.col("slot") <= _largest(room))
    return ranked.join(room, list(keys)).where(F.col("slot") <= F.col("headroom"))


def apply_headroom(screened: DataFrame, room: DataFrame, order: list[str], keys=("niche", "bucket")) -> DataFrame:
    """Turn away rows that reach the budget check when their (niche, class) budget is spent.

    Only rows that pass everything use budget. The budget is spent at the ``headroom``-th such row;
    later rows that got as far as the check are dropped for it, whatever a later rule would say.
    ``bucket`` is the class of rows that reached the check and null for the others.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    passing = screened.where(F.col("bucket").isNotNull() & F.col("reason").isNull())
    ranked = passing.withColumn("slot", F.row_number().over(w)).where(F.col("slot") <= _largest(room))
    last = ranked.join(room, list(keys)).where(F.col("slot") == F.col("headroom")).select(*keys, F.struct(*order).alias("last"))
    ends = room.join(last, list(keys), "left").select(*keys, "headroom", "last")
    after = (F.col("headroom") == 0) | (F.struct(*order) > F.col("last"))
    spent = F.col("bucket").isNotNull() & F.coalesce(after, F.lit(False))
    kept = [c for c in screened.columns if c not in ("reason", "detail")]
    return screened.join(ends, list(keys), "left").select(
        *kept, F.when(spent, F.lit("no_headroom_for_bucket")).otherwise(F.col("reason")).alias("reason"), F.when(~spent, F.col("detail")).alias("detail"))


def scan_end(rows: DataFrame, key: str, order: list[str], kind: Column, q: int, f: int,
             patience: int = V.FLAGGED_PATIENCE, flagged_possible: bool = True) -> DataFrame:
    """Where a budgeted scan ends per key, and what it took.

    Rows are scanned in order. Once ``q`` qualified rows are taken the scan goes on only for
    flagged rows, and ends when ``f`` flagged are taken as well, after ``patience`` rows in a
    row without a flagged one, or at once when no flagged row is possible.

    No key's rows meet in one window. One limited window finds the q-th qualified row (the
    cut-over) and the first ``f`` flagged rows. These flagged rows split what follows the
    cut-over into stretches, of which only the first ``patience`` rows are ranked.
    """
    base = rows.select(F.col(key).alias("key"), F.struct(*order).alias("ord"), kind.alias("kind"))
    limit = max(q, f, 1)
    by_kind = Window.partitionBy("key", "kind").orderBy("ord")
    first = base.where(F.col("kind").isin("qualified", "flagged")).withColumn("rn", F.row_number().over(by_kind)).where(F.col("rn") <= limit)
    marks = first.groupBy("key").agg(
        F.max(F.when((F.col("kind") == "qualified") & (F.col("rn") == q), F.col("ord"))).alias("cut"),
        F.sort_array(F.collect_list(F.when((F.col("kind") == "flagged") & (F.col("rn") <= f), F.col("ord")))).alias("marks"))  # at most f
    open_at_start = F.lit(q == 0)
    full_mark = F.get(F.col("marks"), f - 1) if f > 0 else F.col("cut")
    full = F.when(F.col("cut").isNotNull(), F.greatest("cut", full_mark) if f > 0 else F.col("cut")).when(open_at_start, full_mark)
    if f > 0:
        # ``greatest`` skips nulls: without an f-th flagged row the budget never fills.
        full = F.when(full_mark.isNotNull(), full)
    if not flagged_possible or f == 0:
        ended = marks.select("key", F.col("cut").alias("stop"), F.when(F.col("cut").isNotNull(), "cut_over").alias("why"))
    else:
        rest = base.where(F.coalesce(F.col("kind"), F.lit("")) != "flagged").join(marks, "key", "left").where(open_at_start | (F.col("ord") > F.col("cut")))
        stretch = F.coalesce(F.size(F.filter("marks", lambda m: m < F.col("ord"))), F.lit(0))
        sw = Window.partitionBy("key", "stretch").orderBy("ord")
        tired = (
            rest.select("key", "ord", stretch.alias("stretch")).withColumn("rn", F.row_number().over(sw))
            .where(F.col("rn") == patience).groupBy("key").agg(F.min("ord").alias("tired"))
        )
        ended = marks.select("key", full.alias("full")).join(tired, "key", "full_outer").select(
            "key", F.least("full", "tired").alias("stop"),
            F.when(F.col("tired") < F.coalesce("full", "tired"), F.lit("patience")).when(F.col("full").isNotNull(), F.lit("both_full"))
            .when(F.col("tired").isNotNull(), F.lit("patience")).alias("why"))
    out = base.join(ended, "key", "left")
    never = F.lit(q == 0 and (f == 0 or not flagged_possible))
    scanned = ~never & (F.col("stop").isNull() | (F.col("ord") <= F.col("stop")))
    return out.groupBy("key").agg(
        F.count_if(scanned).alias("scanned"),
        F.least(F.lit(q), F.count_if(scanned & (F.col("kind") == "qualified"))).cast("bigint").alias("taken_qualified"),
        F.least(F.lit(f), F.count_if(scanned & (F.col("kind") == "flagged"))).cast("bigint").alias("taken_flagged"),
        F.coalesce(F.first("why"), F.lit("exhausted")).alias("ended_by"),
    ).withColumnRenamed("key", key)


def first_niche_claims(candidates: DataFrame, niches: list[str], cap: int, order, id_col="entity_id") -> DataFrame:
    """Niches take their best ``cap`` rows in turn; an id taken by one is gone for the next.

    The loop runs over the few niches only and builds one lazy plan. Each niche looks at its
    ``cap * niches`` best rows, which is enough: earlier niches can have taken at most the rest.
    """
    reach = cap * len(niches)
    w = Window.partitionBy("niche").orderBy(*order)
    short = candidates.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= reach)
    taken: list[DataFrame] = []
    for niche in niches:
        mine = short.where(F.col("niche") == niche)
        if taken:
            gone = reduce(DataFrame.unionByName, [t.select(id_col) for t in taken])
            mine = mine.join(gone, id_col, "left_anti")
        taken.append(mine.withColumn("slot", F.row_number().over(w)).where(F.col("slot") <= cap).drop("_rn"))
    return reduce(DataFrame.unionByName, taken)


def run_budget(queue: DataFrame, address: Column, order: list[str], n: int) -> DataFrame:
    """First row per normalised address, then the first ``n`` in queue order."""
    keyed = queue.withColumn("address", address)
    cols = [c for c in keyed.columns if c != "address"]
    first = keyed.groupBy("address").agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("r"))
    return first.select("address", "r.*").orderBy(*order).limit(n)


def claim_tiebreak(rows: DataFrame, key: str, record: str) -> DataFrame:
    """Per key the lowest record id keeps its claim, the others stand down."""
    low = rows.groupBy(key).agg(F.min(record).alias("_low"))
    return rows.join(low, key).select(*rows.columns, F.when(F.col(record) == F.col("_low"), F.lit("granted")).otherwise(F.lit("lost_verify")).alias("outcome"))


def top_bottom(df: DataFrame, score: str, tie: str, n: int = 8) -> DataFrame:
    """The ``n`` highest and ``n`` lowest rows by score."""
    top = df.orderBy(F.desc(score), F.asc(tie)).limit(n).withColumn("side", F.lit("top"))
    low = df.orderBy(F.asc(score), F.asc(tie)).limit(n).withColumn("side", F.lit("bottom"))
    return top.unionByName(low)
