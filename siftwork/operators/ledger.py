"""Spend, reject and send ledgers in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed_values as V
from ..functions.shape import local_day
from ..functions.text import as_col
from .folds import fold_in_order

UNIT = 10_000  # ledgers round to four places; folds run on whole units


def units(amount) -> Column:
    return F.round(as_col(amount) * UNIT).cast("bigint")


class _Running:
    """Totals of one account and month."""

    def __init__(self, day_cap: int, month_cap: int):
        self.day_cap, self.month_cap = day_cap, month_cap

    def __call__(self):
        on, d, m = None, 0, 0

        def step(day: int, u: int):
            nonlocal on, d, m
            if day != on:
                on, d = day, 0
            if d + u > self.day_cap or m + u > self.month_cap:
                return None
            d, m = d + u, m + u
            return d, m

        return step


def can_afford(events: DataFrame, day_cap: float, month_cap: float, tz=V.BUDGET_ZONE, balance: float | None = None,
               account="account", ts="ts", event_id="event_id", amount="amount", splits: int = 16) -> DataFrame:
    """Accept each event unless the day or month total would pass its cap; refused events add nothing.

    Returns ``event_id, accepted, day_total, month_total`` (totals after an accepted paid event).

    The fold passes over an account's month once, in order, and carries three numbers. It is sequential,
    so its input is bounded first. Of the events of
    one account, day and *amount* ``c`` at most ``cap // c`` can be accepted, and once one is
    refused every later one of that amount is too: only the first ``cap // c + 1`` need folding,
    however many events a hot account has. They are found in two steps, first within ``splits``
    random parts of a group, so a hot group is ranked by many tasks. Free events and single events above a cap or the
    balance never touch the totals.
    """
    cap_d, cap_m = int(round(day_cap * UNIT)), int(round(month_cap * UNIT))
    ceiling = min(cap_d, cap_m) if balance is None else min(cap_d, cap_m, int(balance * UNIT))
    e = events.select(
        F.col(account).alias("account"), F.col(event_id).alias("event_id"), F.col(ts).alias("ts"), units(amount).alias("u"),
        local_day(ts, tz).alias("day"))
    payable = e.where((F.col("u") > 0) & (F.col("u") <= ceiling))
    enough = F.floor(F.lit(cap_d) / F.col("u")) + 1

    def first_of(df, *keys):
        w = Window.partitionBy(*keys).orderBy("ts", "event_id")
        return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= enough)

    parts = first_of(payable.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(splits))), "account", "day", "u", "part")
    may = first_of(parts, "account", "day", "u")
    may = may.withColumn("month", F.trunc("day", "month")).withColumn("on", F.dayofmonth("day"))
    ok = fold_in_order(may, ["account", "month"], ["ts", "event_id"], ["on", "u"], _Running(cap_d, cap_m), ["event_id"], [("d", "bigint"), ("m", "bigint")])
    return e.join(ok, "event_id", "left").select(
        "event_id", "account", "day", ((F.col("u") <= 0) | F.col("d").isNotNull()).alias("accepted"),
        (F.col("d") / UNIT).alias("day_total"), (F.col("m") / UNIT).alias("month_total"))


def daily_spend(events: DataFrame, tz=V.BUDGET_ZONE, ts="ts", kind="kind", amount="amount") -> DataFrame:
    return events.groupBy(local_day(ts, tz).alias("day"), F.col(kind).alias("kind")).agg(
        (F.sum(units(amount)) / UNIT).alias("spent"), F.count(F.lit(1)).alias("n"))


def spend_rollup(events: DataFrame, tz=V.BUDGET_ZONE, ts="ts", kind="kind", amount="amount") -> DataFrame:
    """Amount by month, day and kind with day, month and grand totals."""
    day = local_day(ts, tz)
    e = events.where(F.col(amount) > 0).select(
        F.date_format(day, "yyyy-MM").alias("month"), F.date_format(day, "yyyy-MM-dd").alias("day"), F.col(kind).alias("kind"),
        F.col(amount).cast("decimal(18,4)").alias("a"))
    return e.rollup("month", "day", "kind").agg(F.sum("a").alias("spent"))


def strict_day(day_col: str) -> Column:
    return F.when(F.col(day_col).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(F.col(day_col), "yyyy-MM-dd"))


def retain(df: DataFrame, day_col: str, today: str, days: int) -> DataFrame:
    """Drop entries older than the window. The cut-off day stays, and so does a day that cannot be read."""
    strict = strict_day(day_col)
    return df.where(strict.isNull() | (strict >= F.date_sub(F.lit(today).cast("date"), days)))


def remember_rejects(rejects: DataFrame, niche: str, handle: Column, day: Column, durable: Column) -> DataFrame:
    """Latest day per (niche, handle) over durable rejects."""
    r = rejects.where(durable).select(F.col(niche).alias("niche"), handle.alias("handle"), day.alias("day"))
    return r.where("handle <> ''").groupBy("niche", "handle").agg(F.max("day").alias("last_day"))


_BLOCK_RANK = {"NotSent": 1, "Claimed": 2, "MaybeSent": 3, "Sent": 4}
_BLOCK_REASON = {1: "previously_not_sent", 2: "in_flight", 3: "maybe_sent", 4: "already_sent", 9: "unknown_state"}


def classify_claims(rows: DataFrame, key: str, state: str = "state") -> DataFrame:
    """Blocking reason per key: any unknown state first, then Sent, MaybeSent, Claimed, NotSent."""
    rank = F.lit(9)
    for s, r in _BLOCK_RANK.items():
        rank = F.when(F.col(state) == s, F.lit(r)).otherwise(rank)
    return rows.groupBy(key).agg(F.max(rank).alias("r"), F.count(F.lit(1)).alias("n_rows")).select(
        key, "n_rows", _reason(F.col("r")).alias("reason"), F.lit(True).alias("blocked"))


def _reason(r: Column) -> Column:
    out = F.lit("granted")
    for k, v in _BLOCK_REASON.items():
        out = F.when(r == k, F.lit(v)).otherwise(out)
    return out


def claim_state(events: DataFrame, key: str, ts: str = "ts", tie: str = "record_id", state: str = "state") -> DataFrame:
    """Current state per claim: the latest event decides. Only NotSent may be retried."""
    last = F.max_by(F.struct(F.col(state).alias("state"), F.col(ts).alias("state_at")), F.struct(ts, tie))
    return events.groupBy(key).agg(last.alias("l")).select(
        key, F.col("l.state").alias("state"), F.col("l.state_at").alias("state_at"), (F.col("l.state") == "NotSent").alias("retryable"))


def stranded(states: DataFrame, as_of: str, minutes: int = V.STRANDED_AFTER_MINUTES) -> DataFrame:
    """Claims still Claimed before the cut-off: reported, never resolved."""
    cutoff = F.lit(as_of).cast("timestamp") - F.expr(f"interval {int(minutes)} minutes")
    return states.where((F.col("state") == "Claimed") & (F.col("state_at") < cutoff))


def send_budget(claims: DataFrame, day: str, cap: int = V.SEND_DAILY_CAP, tz=V.BUDGET_ZONE, ts="ts") -> DataFrame:
    """Claims already made on the local day and what the cap leaves."""
    d = F.lit(day).cast("date")
    near = claims.where((F.col(ts) >= F.date_sub(d, 1).cast("timestamp")) & (F.col(ts) < F.date_add(d, 3).cast("timestamp")))
    n = F.count_if(local_day(ts, tz) == d)
    return near.agg(n.alias("claimed"), F.greatest(F.lit(0), F.lit(cap) - n).cast("bigint").alias("remaining"))


def claim_decision(queue: DataFrame, ledger: DataFrame, remaining: DataFrame,
                   allow_retry: bool = False, allow_recontact: bool = False) -> DataFrame:
    """First reason that blocks a send, per queued row, else ``granted``.

    ``queue``: entity_id, claim_key, qualification, address, ord. ``ledger``: entity_id, claim_key,
    state. ``remaining``: one row with the day's left budget, read while the plan is built:
    no more addresses than that are ranked.
    """
    sent = ledger.where("state = 'Sent'").select("entity_id").distinct().withColumn("ever_sent", F.lit(True))
    state = classify_claims(ledger, "claim_key").select("claim_key", F.col("reason").alias("key_reason"))
    j = queue.join(sent, "entity_id", "left").join(state, "claim_key", "left")
    blocked = F.col("key_reason")
    if allow_retry:
        blocked = F.when(F.col("key_reason") != "previously_not_sent", F.col("key_reason"))
    early = (
        F.when(F.coalesce(F.col("entity_id").cast("string"), F.lit("")) == "", F.lit("no_channel_id"))
        .when(~F.col("qualification").eqNullSafe(V.QUALIFIED), F.lit("not_qualified"))
        .when(F.lit(not allow_recontact) & F.col("ever_sent"), F.lit("already_sent"))
        .otherwise(blocked)
    )
    j = j.withColumn("early", early)
    open_rows = j.where("early is null")
    firsts = open_rows.groupBy("address").agg(F.min("ord").alias("ord"))
    left = int(remaining.select("remaining").first()[0])
    top = firsts.orderBy("ord").limit(left).withColumn("rn", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("ord")))
    granted = top
    end = granted.agg(F.struct(F.max("ord").alias("last"), F.count(F.lit(1)).alias("n"))).scalar()
    last_ord, n_granted = end["last"], end["n"]
    d = j.join(granted.select(F.col("ord").alias("_g")), F.col("ord") == F.col("_g"), "left")
    spent = (n_granted >= F.lit(left)) & (last_ord.isNull() | (F.col("ord") > last_ord))
    reason = F.coalesce(
        "early",
        F.when(F.col("_g").isNotNull(), F.lit("granted")).when(spent, F.lit("over_daily_cap")).otherwise(F.lit("duplicate_address")))
    return d.select(*queue.columns, reason.alias("reason"))


def followup(entities: DataFrame, ledger: DataFrame, as_of: str, prefix: str, min_days=V.FOLLOWUP_MIN_DAYS, max_touches=V.FOLLOWUP_MAX_TOUCHES) -> DataFrame:
    """Whether a non-replier may be contacted again, with the next touch and its label."""
    last = F.max(F.coalesce("settled_at", "claimed_at"))
    prior = ledger.where("state = 'Sent'").groupBy("entity_id").agg(F.count(F.lit(1)).alias("touches"), last.alias("last_sent"))
    age = F.floor((F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("last_sent")) / F.lit(86_400_000_000))
    known = F.coalesce(F.col("reply_state").isin(*V.REPLY_STATES), F.lit(False))
    reason = (
        F.when(~F.coalesce(F.col("requested"), F.lit(False)), F.lit("followup_not_requested"))
        .when(~F.col("qualification").eqNullSafe(V.QUALIFIED), F.lit("not_qualified"))
        .when(F.col("touches").isNull(), F.lit("no_prior_send"))
        .when(~known, F.lit("reply_state_unknown"))
        .when(F.col("reply_state") != V.REPLY_STATES[0], F.lit("replied"))
        .when(F.col("touches") >= max_touches, F.lit("max_touches_reached"))
        .when(F.col("last_sent").isNull() | (age < min_days), F.lit("too_soon"))
        .otherwise(F.lit("granted"))
    )
    r = entities.join(prior, "entity_id", "left").withColumn("reason", reason)
    ok = F.col("reason") == "granted"
    return r.select(
        "entity_id", "reason", ok.alias("eligible"),
        F.when(ok, F.col("touches") + 1).otherwise(F.when(F.col("reason").isin("max_touches_reached", "too_soon"), F.col("touches")).otherwise(0)).cast("bigint").alias("touch_number"),
        F.when(ok, F.concat(F.lit(f"{prefix}-followup"), (F.col("touches") + 1).cast("string"))).otherwise(F.lit("")).alias("next_campaign"))


def judge(flagged: Column, verdict_code: Column, confirmed: Column, why: Column, wanted: Column | None = None) -> Column:
    """``struct(state, detail, rescued)``. A verdict can re-admit a flagged row, never drop one."""
    run = F.lit(True) if wanted is None else wanted

    def out(state, detail, rescued):
        return F.struct(F.lit(state).alias("state"), detail.alias("detail"), F.lit(rescued).alias("rescued"))

    return (
        F.when(~run, out("scored", F.lit("video not run (rescue path only)"), False))
        .when(verdict_code.isNull(), out("scored", F.lit("no long-form video to sample"), False))
        .when(verdict_code != "ok", out("unavailable", F.concat(F.lit("unavailable ("), verdict_code, F.lit(")")), False))
        .when(flagged & confirmed, out("rescued", F.concat(F.lit("rescued ("), why, F.lit(")")), True))
        .otherwise(out("scored", why, False))
    )
