"""The ledgers as streams. Each gives the batch operator's result on the same finite input.

State is bounded by the watermark: days that have closed leave the state store, and what
must outlive them (latest claim state, remembered rejects) is merged into a table of one row a key.
A :class:`~.io.FiniteStream` ends with a marker, which every ledger lets through to its watermark and no further.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import fixed_values as V
from ..operators.ledger import UNIT, strict_day, units
from .io import is_event


def daily_spend(events: DataFrame, delay: str = "10 minutes", tz: str = V.BUDGET_ZONE, kind="kind", amount="amount") -> DataFrame:
    """Amount per local day and kind, emitted once when the day has closed; rows later than that are dropped."""
    e = events.withColumn("local_ts", F.from_utc_timestamp("ts", tz)).withWatermark("local_ts", delay)
    g = e.where(is_event(e, "local_ts")).groupBy(F.window("local_ts", "1 day").alias("w"), F.col(kind).alias("kind")).agg(
        F.sum(units(amount)).alias("u"), F.count(F.lit(1)).alias("n"))
    return g.select(F.to_date("w.start").alias("day"), "kind", (F.col("u") / UNIT).alias("spent"), "n")


def remember_rejects(events: DataFrame, niche: Column, handle: Column, durable: Column, delay: str = "10 minutes", tz: str = V.BUDGET_ZONE) -> DataFrame:
    """Days on which a (niche, handle) was rejected for good, as updates; its newest day is the one to keep."""
    e = events.where(durable).select(F.from_utc_timestamp("ts", tz).alias("local_ts"), niche.alias("niche"), handle.alias("handle")).where("handle <> ''")
    g = e.withWatermark("local_ts", delay).groupBy(F.window("local_ts", "1 day").alias("w"), "niche", "handle").agg(F.count(F.lit(1)).alias("n"))
    return g.select("niche", "handle", F.to_date("w.start").alias("last_day"))


def claim_states(events: DataFrame, key: str, delay: str = "10 minutes") -> DataFrame:
    """Latest state per claim and day, as updates; the newest by (state_at, record_id) is the one to keep. Only NotSent may be retried."""
    last = F.max_by(F.struct("state", "ts", "record_id"), F.struct("ts", "record_id"))
    g = events.withWatermark("ts", delay).groupBy(F.window("ts", "1 day").alias("w"), F.col(key)).agg(last.alias("l"))
    return g.select(key, F.col("l.state").alias("state"), F.col("l.ts").alias("state_at"), F.col("l.record_id").alias("record_id"), (F.col("l.state") == "NotSent").alias("retryable"))


_DAY_MS = 86_400_000


class _Retained(StatefulProcessor):
    """The newest day of a key and its number of rows, until the watermark has passed that day by ``days``."""

    def __init__(self, days: int, keys: list[str]):
        self.days, self.keys = days, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", "last_day string, n bigint, until_ms bigint")  # until_ms -1: no day, kept for good

    def _row(self, key, day: str, n: int, until: int, gone: bool) -> pd.DataFrame:
        return pd.DataFrame([(*key, day, n, until, gone)], columns=[*self.keys, "last_day", "n", "until_ms", "gone"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.entry.get()  # None for a new key, which has no timers either: each call to the state is a round trip
        day, n, until = before = held or ("", 0, -2)
        for pdf in rows:
            n += len(pdf)
            top = pdf.loc[pdf["start_ms"].idxmax()]
            at = -1 if top["start_ms"] < 0 else int(top["start_ms"]) + (self.days + 1) * _DAY_MS
            if at > until or until == -2:
                day, until = top["day"], at
        if until >= 0 and until <= timerValues.getCurrentWatermarkInMs():
            return  # out of the window before it came
        if until != before[2]:
            if before[2] >= 0:
                self.handle.deleteTimer(before[2])
            if until >= 0:
                self.handle.registerTimer(until)
        self.entry.update((day, n, until))
        yield self._row(key, day, n, until, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.entry.exists():
            day, n, until = self.entry.get()
            self.entry.clear()
            yield self._row(key, day, n, until, True)


def retain(events: DataFrame, keys: list[str], day: Column, days: int, time: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Entries (one a key) that leave the state once their newest day is more than ``days`` before the watermark's day.

    Gives updates: keys, last_day, n, until_ms and ``gone``; the newest by (until_ms, n, gone) is the one to keep. The cut-off day stays, and so
    does an entry whose day cannot be read.
    """
    e = events.withWatermark(time, delay)
    start = F.coalesce(F.unix_millis(strict_day("day").cast("timestamp")), F.lit(-1))
    rows = e.where(is_event(e, time)).select(*keys, time, day.alias("day")).withColumn("start_ms", start)
    types = dict(rows.dtypes)
    out = ", ".join(f"{k} {types[k]}" for k in keys) + ", last_day string, n bigint, until_ms bigint, gone boolean"
    return rows.groupBy(*keys).transformWithStateInPandas(statefulProcessor=_Retained(days, keys), outputStructType=out, outputMode="Update", timeMode="EventTime")


class _Afford(StatefulProcessor):
    """Holds one account's events until the watermark has passed them, then folds them in event order."""

    def __init__(self, day_cap: int, month_cap: int):
        self.day_cap, self.month_cap = day_cap, month_cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "day string, d bigint, m bigint")
        self.waiting = handle.getListState("waiting", "us bigint, event_id bigint, day string, u bigint")

    def _decide(self, key, rows: list[tuple]) -> pd.DataFrame:
        day, d, m = self.totals.get() if self.totals.exists() else ("", 0, 0)
        out = []
        for _, event_id, on, u in sorted(rows):
            if on != day:
                d, m, day = 0, (m if on[:7] == day[:7] else 0), on
            ok = u <= 0 or (d + u <= self.day_cap and m + u <= self.month_cap)
            if ok and u > 0:
                d, m = d + u, m + u
            out.append((event_id, key[0], on, ok))
        self.totals.update((day, d, m))
        return pd.DataFrame(out, columns=["event_id", "account", "day", "accepted"])

    def _wake(self, at_ms: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(at_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for pdf in rows:  # chunk by chunk: a hot account's batch is never held as a whole
            got = [(int(us), int(event_id), day, int(u)) for us, event_id, day, u in pdf[["us", "event_id", "day", "u"]].itertuples(index=False, name=None)]
            if got:
                self.waiting.appendList(got)
                low = min(g[0] for g in got) // 1000 + 1
                first = low if first is None else min(first, low)
        if first is not None:
            timers = list(self.handle.listTimers())
            if not timers or first < min(timers):
                self._wake(max(first, timerValues.getCurrentWatermarkInMs() + 1))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        held = [tuple(r) for r in self.waiting.get()]
        ready = [r for r in held if r[0] < mark]
        later = [r for r in held if r[0] >= mark]
        if later:
            self.waiting.put(later)
            self.handle.registerTimer(max(min(r[0] for r in later) // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1))
        else:
            self.waiting.clear()
        if ready:
            yield self._decide(key, ready)


def can_afford(events: DataFrame, day_cap: float, month_cap: float, delay: str = "10 minutes", tz: str = V.BUDGET_ZONE, account="account", amount="amount") -> DataFrame:
    """Accept or refuse each event as in the batch fold, in event order even when events arrive out of order.

    Only events inside the watermark delay are held back; an account's running totals are three numbers.
    """
    e = events.withWatermark("ts", delay)
    e = e.where(is_event(e)).select(
        F.col(account).alias("account"), "ts", F.unix_micros("ts").alias("us"), "event_id",
        F.date_format(F.from_utc_timestamp("ts", tz), "yyyy-MM-dd").alias("day"), units(amount).alias("u"))
    return e.groupBy("account").transformWithStateInPandas(
        statefulProcessor=_Afford(int(round(day_cap * UNIT)), int(round(month_cap * UNIT))),
        outputStructType="event_id bigint, account bigint, day string, accepted boolean", outputMode="Append", timeMode="EventTime")


class _Stranded(StatefulProcessor):
    """The latest state of a claim, and whether it was reported: a row when a claim is due, one with ``gone`` when it was settled after all.

    A settled claim leaves once the watermark has passed it, as nothing older can come then.
    """

    def __init__(self, minutes: int):
        self.hold = minutes * 60_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us bigint, record_id bigint, claimed boolean, reported_us bigint")  # -1: not reported

    def _row(self, key, us: int, gone: bool, seq: int) -> pd.DataFrame:
        return pd.DataFrame([(key[0], us, gone, seq)], columns=["entity_id", "state_us", "gone", "seq"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        us, record, claimed, reported = self.last.get() if self.last.exists() else (-1, -1, False, -1)
        before = (us, record)
        for pdf in rows:  # only the newest of a key matters, so nothing is gathered or sorted
            n, i, state = max(zip(pdf["us"].tolist(), pdf["record_id"].tolist(), pdf["state"].tolist()))
            if (n, i) > (us, record):
                us, record, claimed = n, i, state == "Claimed"
        if (us, record) == before:
            return
        if reported >= 0:
            yield self._row(key, reported, True, 2 * us)
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.last.update((us, record, claimed, -1))
        self.handle.registerTimer(max((us + self.hold if claimed else us) // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.last.exists():
            return
        us, record, claimed, reported = self.last.get()
        if not claimed:
            self.last.clear()
        elif reported < 0:
            self.last.update((us, record, True, us))
            yield self._row(key, us, False, 2 * us + 1)


def stranded(events: DataFrame, minutes: int = V.STRANDED_AFTER_MINUTES, delay: str = "10 minutes") -> DataFrame:
    """Claims still Claimed when ``minutes`` of event time have passed, as in the batch form with the watermark as the time to look.

    Gives updates: entity_id, state_at, ``gone`` and seq; the newest by seq is the one to keep.
    """
    e = events.withWatermark("ts", delay)
    e = e.where(is_event(e)).select("entity_id", "ts", F.unix_micros("ts").alias("us"), "record_id", "state")
    out = e.groupBy("entity_id").transformWithStateInPandas(
        statefulProcessor=_Stranded(minutes), outputStructType="entity_id bigint, state_us bigint, gone boolean, seq bigint", outputMode="Update", timeMode="EventTime")
    return out.select("entity_id", F.timestamp_micros("state_us").alias("state_at"), "gone", "seq")
