"""Counts and summaries over screened rows and ledgers."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed_values as V
from ..functions.shape import local_day
from ..functions.text import blank, normalize_handle, rounded
from .ledger import UNIT, units
from .matching import suppression_keys


def added_on(df: DataFrame, day: str, tz=V.BUDGET_ZONE, ts="ts", by=()) -> DataFrame:
    """Rows of one local day. The wide range on the raw time reaches the scan and prunes files by their day."""
    d = F.lit(day).cast("date")
    near = (F.col(ts) >= F.date_sub(d, 1).cast("timestamp")) & (F.col(ts) < F.date_add(d, 3).cast("timestamp"))
    return df.where(near & (local_day(ts, tz) == d)).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def drop_counts(df: DataFrame, reason: str = "reason") -> DataFrame:
    return df.groupBy(F.coalesce(F.col(reason), F.lit("unknown")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def quota_by_day(events: DataFrame, cost: Column, tz=V.QUOTA_ZONE, ceiling=V.QUOTA_CEILING, ts="ts") -> DataFrame:
    g = events.groupBy(local_day(ts, tz).alias("day")).agg(F.sum(cost).alias("units"))
    return g.select("day", "units", (F.col("units") > ceiling).alias("over"))


def requests_by_model(events: DataFrame, model: Column, video: Column, exhausted: Column, tz=V.QUOTA_ZONE, ts="ts") -> DataFrame:
    return events.groupBy(local_day(ts, tz).alias("day"), model.alias("model")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(video).alias("video"), F.bool_or(exhausted).alias("exhausted"))


def run_summary(runs: DataFrame, run: str) -> DataFrame:
    """One row per run: totals over niches, duration and a reason -> count map."""
    totals = runs.groupBy(run).agg(
        F.sum("rows").alias("rows_pushed"), F.sum("discovered").alias("discovered"),
        rounded((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1e6, 1).alias("duration_s"),
        rounded(F.sum(units("spent")) / UNIT, 4).alias("spent"))
    reasons = runs.where("reason is not null").groupBy(run, "reason").agg(F.count(F.lit(1)).alias("n")).groupBy(run).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("reason", "n")))).alias("drop_reasons"))
    return totals.join(reasons, run, "left")


def coverage(rows: DataFrame, email="email", source="source", reachable="reachable", freemail=V.FREEMAIL_DOMAINS, any_case: bool = True) -> DataFrame:
    """Contacts found by source, how many are free mail (domains in any case, or just as listed), and the found share of reachable rows.

    Rows are read once, into one count per source and outcome; the totals add up these counts.
    """
    domain = F.substring_index(F.col(email), "@", -1)
    free = (F.lower(domain) if any_case else domain).isin(*freemail)
    counts = rows.where(F.col(reachable)).groupBy(source, (~blank(email)).alias("_found")).agg(F.count(F.lit(1)).alias("found"), F.count_if(free).alias("freemail"))
    overall = Window.partitionBy(F.lit(1))
    totals = counts.withColumn("reachable", F.sum("found").over(overall)).withColumn("_hit", F.sum(F.when(F.col("_found"), F.col("found"))).over(overall))
    return totals.where("_found").select(source, "found", "freemail", "reachable", rounded(F.try_divide(F.col("_hit").cast("double"), "reachable") * 100, 2).alias("found_pct"))


def backtest(rows: DataFrame, niche: str, status: str, score: str, flag: str, approved="Approved") -> DataFrame:
    """Score against reviewer label, per niche and overall: size, upper median, mean, range, 2x2 table, rates.

    Rows are first counted per distinct (niche, status, score, flag); everything else reads these
    counts, so the exact upper median (the smallest score whose cumulative count passes half)
    ranks distinct scores, not rows.
    """
    counts = rows.groupBy(F.col(niche).alias("niche"), F.col(status).alias("status"), F.col(score).alias("score"), F.col(flag).alias("flag")).agg(F.count(F.lit(1)).alias("c"))
    both = counts.select(F.explode(F.array("niche", F.lit("ALL"))).alias("grp"), "status", "score", "flag", "c")
    w = Window.partitionBy("grp", "status")
    cum = both.groupBy("grp", "status", "score").agg(F.sum("c").alias("c")).withColumn("n", F.sum("c").over(w)).withColumn("upto", F.sum("c").over(w.orderBy("score")))
    median = cum.where(F.col("upto") > F.floor(F.col("n") / 2)).groupBy("grp", "status").agg(F.min("score").alias("median"))
    on, ok = F.col("flag"), F.col("status") == approved

    def total(cond=F.lit(True)):
        return F.coalesce(F.sum(F.when(cond, F.col("c"))), F.lit(0))

    stats = both.groupBy("grp", "status").agg(
        total().alias("n"), rounded(F.try_divide(F.sum(F.col("score") * F.col("c")).cast("double"), F.sum("c")), 4).alias("mean"), F.min("score").alias("lo"), F.max("score").alias("hi"),
        total(on).alias("n_flag"), total(~on).alias("n_noflag"))

    def rate(cond):
        return rounded(F.try_divide(total(cond & ok).cast("double"), total(cond)), 4)

    base = both.groupBy("grp").agg(rate(F.lit(True)).alias("base_rate"), rate(on).alias("p_given_flag"), rate(~on).alias("p_given_noflag"))
    return stats.join(median, ["grp", "status"]).join(base, "grp")


def filter_ablation(pool: DataFrame, filters: dict[str, Column], relaxed: dict[str, Column] | None = None, rejected: Column | None = None) -> DataFrame:
    """Pool size under all filters and with each removed or relaxed, in one pass over the pool."""
    relaxed = relaxed or {}
    cols = [c.alias(f"f_{k}") for k, c in filters.items()] + [c.alias(f"r_{k}") for k, c in relaxed.items()]
    net = F.lit(True) if rejected is None else ~rejected
    marked = pool.select(*cols, net.alias("net"))

    def conj(skip=None, use=None):
        parts = [F.col(f"f_{k}") for k in filters if k != skip]
        return reduce(and_, parts + ([F.col(f"r_{use}")] if use else []), F.lit(True))

    variants = {"baseline": conj()}
    variants.update({f"drop {k}": conj(skip=k) for k in filters})
    variants.update({f"relax {k}": conj(skip=k, use=k) for k in relaxed})
    one = marked.agg(
        F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(v).alias("variant"), F.count_if(c).alias("pool"), F.count_if(c & F.col("net")).alias("net")) for i, (v, c) in enumerate(variants.items())]).alias("a"))
    rows = one.select(F.get("a", 0)["pool"].alias("base"), F.explode("a").alias("v"))
    return rows.select("v.variant", "v.pool", "v.net", rounded((F.try_divide(F.col("v.pool").cast("double"), "base") - 1) * 100, 2).alias("change_pct"))


def suppression_quality(rows: DataFrame, name="name", url="url", email="email") -> DataFrame:
    """Rows, distinct keys by kind, and rows that only a name could match."""
    weak = (normalize_handle(url) == "") & blank(email)
    keys = suppression_keys(rows, name, url, email)
    kinds = [keys.agg(F.count_if(F.col("kind") == x)).scalar().alias(f"{x}s") for x in ("handle", "email", "name")]
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(weak).alias("weak_rows")).select(
        "n_rows", *kinds, "weak_rows", rounded(F.try_divide(F.col("weak_rows").cast("double"), "n_rows") * 100, 2).alias("weak_pct"))


def verification_summary(judgements: DataFrame) -> DataFrame:
    return judgements.agg(
        *[F.count_if(F.col("state") == s).alias(s) for s in ("scored", "rescued", "unavailable")],
        F.count_if(~F.col("cached")).alias("requests"), F.count_if(~F.col("cached") & F.col("video")).alias("video_requests"),
        F.count_if(F.col("cached")).alias("cache_hits"), F.sum("tokens").alias("tokens"), rounded(F.sum(units("seconds")) / UNIT, 4).alias("seconds"))


def unit_cost(spend: DataFrame, written: DataFrame, key: str) -> DataFrame:
    """Credits per written row; null when nothing was written."""
    s = spend.groupBy(key).agg((F.sum(units("amount")) / UNIT).alias("spent"))
    w = written.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return s.join(w, key, "left").select(
        key, "spent", F.coalesce("rows", F.lit(0)).alias("rows"), rounded(F.try_divide("spent", "rows"), 4).alias("per_row"))


def latest_balance(events: DataFrame, balance: Column, account: str, day: str, day_cap=V.SPEND_DAY_CAP, month_cap=V.SPEND_MONTH_CAP, tz=V.BUDGET_ZONE) -> DataFrame:
    """Last reported balance per account beside the day's and month's spend and what the caps leave."""
    d = F.lit(day).cast("date")
    today = local_day("ts", tz) == d
    month = F.trunc(local_day("ts", tz), "month") == F.trunc(d, "month")
    order = F.when(balance.isNotNull(), F.struct(F.col("ts"), F.col("event_id")))
    g = events.groupBy(account).agg(
        F.max_by(balance, order).alias("balance"),
        (F.sum(F.when(today, units("amount")).otherwise(0)) / UNIT).alias("day_spent"),
        (F.sum(F.when(month, units("amount")).otherwise(0)) / UNIT).alias("month_spent"))
    return g.select(
        account, "balance", "day_spent", "month_spent",
        rounded(F.greatest(F.lit(0.0), F.least(F.lit(float(day_cap)) - F.col("day_spent"), F.lit(float(month_cap)) - F.col("month_spent"), F.col("balance"))), 4).alias("can_spend"))


def send_summary(decisions: DataFrame, outcome: str) -> DataFrame:
    return decisions.groupBy(outcome).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(outcome))


