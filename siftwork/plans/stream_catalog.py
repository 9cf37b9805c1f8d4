"""Registered queries: the ledgers as streams over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as V, shape, text
from ..operators import gates
from ..sources import bindings as B
from ..streaming import io, ledgers
from .ledger_catalog import AFFORD_SQL, DAY_CAP, MONTH_CAP, REJECT_REASON, REMEMBER_SQL, RETAINED_SQL, k_col
from .registry import ORACLES, query

def _events(s, d):
    s.conf.set("spark.sql.streaming.stateStore.providerClass", io.ROCKSDB)
    return io.event_stream(s, d)


def _finite(s, d, label):
    return io.FiniteStream(_events(s, d), label)


def _states(e):
    m = F.create_map(*[F.lit(x) for kv in B.CLAIM_STATE_BY_EVENT.items() for x in kv])
    rows = e.select(F.col("event_id").alias("record_id"), F.col("user_id").alias("entity_id"), "ts", F.try_element_at(m, F.col("event_type")).alias("state"), *[c for c in (io.END,) if c in e.columns])
    return rows.where((F.col("state") != "Paused") | (F.col(io.END) if io.END in e.columns else F.lit(False)))


@query("T1_daily_spend_stream", ORACLES["T1_daily_spend"])
def _(s, d):
    f = _finite(s, d, "daily-spend")
    out = io.appended(s, ledgers.daily_spend(f.rows, kind="event_type", amount="value"), "daily-spend", stream=f)
    return out.withColumn("day", F.col("day").cast("string"))


@query("T2_can_afford_stream", AFFORD_SQL + " SELECT event_id, user_id AS account, CAST(day AS VARCHAR) AS day, ok AS accepted FROM st WHERE rn > 0")
def _(s, d):
    f = _finite(s, d, "can-afford")
    return io.appended(s, ledgers.can_afford(f.rows, DAY_CAP, MONTH_CAP, account="user_id", amount="value"), "can-afford", stream=f)


def _reject_parts():
    m = F.create_map(*[F.lit(x) for kv in REJECT_REASON.items() for x in kv])
    return F.concat(F.lit("n"), F.col("user_id") % 5), text.handle_key(F.concat(F.lit(" @U"), k_col())), gates.durable_reject(F.try_element_at(m, F.col("event_type")))


@query("T4_remember_rejects_stream", REMEMBER_SQL)
def _(s, d):
    updates = ledgers.remember_rejects(_events(s, d), *_reject_parts())
    return io.merged(s, updates, "rejects", ["niche", "handle"], ["last_day"]).withColumn("last_day", F.col("last_day").cast("string"))


#: Puts the watermark, ten minutes behind the end marker, at the midnight that the batch forms look from.
TODAY_END = "2024-01-31 00:10:00"


@query("T3_retain_stream", f"SELECT * FROM ({REMEMBER_SQL}) WHERE last_day >= '2024-01-29'")
def _(s, d):
    f = _finite(s, d, "retain")
    niche, handle, durable = _reject_parts()
    e = f.rows.where(durable | F.col(io.END)).withColumn("niche", niche).withColumn("handle", handle)
    kept = ledgers.retain(e, ["niche", "handle"], shape.local_day("ts", V.BUDGET_ZONE).cast("string"), 2)
    return io.merged(s, kept, "retain", ["niche", "handle"], ["until_ms", "n", "gone"], "gone", stream=f, end=TODAY_END).select("niche", "handle", "last_day")


@query("T3_retain_days_stream", f"SELECT day, count(*) AS n FROM ({RETAINED_SQL}) GROUP BY 1")
def _(s, d):
    f = _finite(s, d, "retain-days")
    e = f.rows.withColumn("label", F.when(F.col("event_type") == "error", F.concat(F.lit("day "), "user_id")).otherwise(F.date_format("ts", "yyyy-MM-dd")))
    kept = ledgers.retain(e, ["label"], F.col("label"), 7)
    return io.merged(s, kept, "retain-days", ["label"], ["until_ms", "n", "gone"], "gone", stream=f, end=TODAY_END).select(F.col("label").alias("day"), "n")


@query("T6_claim_state_stream", ORACLES["T6_claim_state"])
def _(s, d):
    now = io.merged(s, ledgers.claim_states(_states(_events(s, d)), "entity_id"), "claim-states", ["entity_id"], ["state_at", "record_id"])
    return now.select("entity_id", "state", F.date_format("state_at", "yyyy-MM-dd HH:mm:ss").alias("state_at"), "retryable")


@query("T9_stranded_stream", ORACLES["T9_stranded"])
def _(s, d):
    f = _finite(s, d, "stranded")
    out = io.merged(s, ledgers.stranded(_states(f.rows), 24 * 60), "stranded", ["entity_id"], ["seq"], "gone", stream=f, end=TODAY_END)
    return out.select("entity_id", F.date_format("state_at", "yyyy-MM-dd HH:mm:ss").alias("state_at"))
