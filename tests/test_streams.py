"""Streams over several files: same result as batch, late rows, and restarts."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from siftwork.operators import ledger
from siftwork.streaming import io, ledgers
from siftwork.streaming.state_table import StateTable

START = dt.datetime(2024, 1, 10, 12)


@pytest.fixture
def feed(spark, tmp_path):
    """Writes one file per micro-batch, in arrival order, and opens it as a stream."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", io.ROCKSDB)
    folder = tmp_path / "in"
    folder.mkdir()

    def put(*batches, first=0):
        for n, rows in enumerate(batches, first):
            df = spark.createDataFrame(rows, io.EVENT_SCHEMA).toPandas()
            df["ts"] = df["ts"].astype("datetime64[us]")
            path = folder / f"b{n:03d}.parquet"
            df.to_parquet(path, index=False, coerce_timestamps="us")
            os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
        return io.event_stream(spark, str(folder), "*.parquet", per_trigger=1)

    return put


def event(i, minutes, user=1, kind="view", value=1.0):
    return (i, START + dt.timedelta(minutes=minutes), user, kind, value, "{}")


def test_daily_spend_drops_rows_later_than_the_watermark(spark, feed):
    day = 24 * 60
    df = feed([event(1, 0, value=1.0), event(2, day, value=2.0)], [event(3, 2 * day, value=4.0)], [event(4, 5, value=100.0), event(5, 4 * day, value=8.0)], [event(6, 6 * day)])
    out = io.appended(spark, ledgers.daily_spend(df, kind="event_type", amount="value"), "t").collect()
    got = {str(r.day): (r.spent, r.n) for r in out}
    assert got["2024-01-10"] == (1.0, 1) and got["2024-01-11"] == (2.0, 1) and got["2024-01-14"] == (8.0, 1)


def test_can_afford_follows_event_order_not_arrival(spark, feed):
    rnd = random.Random(7)
    ev = [event(i, rnd.randrange(0, 4 * 24 * 60), rnd.choice([1, 1, 2]), value=rnd.choice([0.0, 1.5, 4.0, 7.25])) for i in range(300)]
    ev.sort(key=lambda e: e[1])
    arrival = sorted(range(len(ev)), key=lambda i: i + rnd.randrange(0, 20))  # shuffled within a short reach
    batches = [[ev[i] for i in arrival[k:k + 60]] for k in range(0, len(ev), 60)]
    end = [event(9999, 40 * 24 * 60, user=3)]
    df = feed(*batches, end)
    got = {r.event_id: r.accepted for r in io.appended(spark, ledgers.can_afford(df, 10.0, 25.0, delay="2 days", account="user_id", amount="value"), "t").collect()}
    static = spark.createDataFrame(ev, io.EVENT_SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))
    want = {r.event_id: r.accepted for r in ledger.can_afford(static, 10.0, 25.0, account="user_id", amount="value").collect()}
    assert got == want and len(set(want.values())) == 2


def states(df):
    return df.select(F.col("event_id").alias("record_id"), F.col("user_id").alias("entity_id"), "ts", F.col("event_type").alias("state"))


CLAIM = dict(keys=["entity_id"], order=["state_at", "record_id"])


def test_claim_state_survives_out_of_order_events_and_restarts(spark, feed, tmp_path):
    path, cp = str(tmp_path / "log"), str(tmp_path / "cp")
    now = lambda t: {r.entity_id: (r.state, r.retryable) for r in t.collect()}
    go = lambda df: now(io.merged(spark, ledgers.claim_states(states(df), "entity_id"), "t", **CLAIM, path=path, checkpoint=cp))
    assert go(feed([event(1, 0, 1, "Claimed"), event(2, 5, 2, "Claimed")], [event(4, 9, 1, "NotSent"), event(3, 7, 1, "Sent")])) == {1: ("NotSent", True), 2: ("Claimed", False)}
    assert go(feed()) == {1: ("NotSent", True), 2: ("Claimed", False)}
    assert go(feed([event(5, 3000, 2, "Sent")], first=2)) == {1: ("NotSent", True), 2: ("Sent", False)}


def test_remembered_rejects_keep_the_latest_day(spark, feed):
    df = feed([event(1, 0, 1), event(2, 60 * 30, 1), event(3, 0, 2, "error")], [event(4, 60 * 60, 2)])
    updates = ledgers.remember_rejects(df, F.lit("n"), F.concat(F.lit("u"), "user_id"), F.col("event_type") == "view")
    got = {r.handle: str(r.last_day) for r in io.merged(spark, updates, "t", ["niche", "handle"], ["last_day"]).collect()}
    assert got == {"u1": "2024-01-11", "u2": "2024-01-12"}


# ---- the compacted table --------------------------------------------------------------------

def table_of(spark, root, gone=None, buckets=4):
    schema = spark.createDataFrame([], "k int, at int, v string, out boolean").schema
    return StateTable(spark, str(root), schema, ["k"], ["at"], gone, buckets)


def test_state_table_reads_one_folder_a_bucket_however_many_batches(spark, tmp_path):
    t = table_of(spark, tmp_path / "t")
    want = {}
    for b in range(12):
        rows = [(k, b * 10 + k % 3, f"{b}-{k}", False) for k in range(b, b + 20, 2)]
        want |= {k: v for k, _, v, _ in rows}
        t.merge(spark.createDataFrame(rows, t.schema), b)
        t.merge(spark.createDataFrame([(0, 999, "replayed", False)], t.schema), b)  # a batch that was committed before
        assert len(t.read().inputFiles()) <= 4 * 2
    assert {r.k: r.v for r in t.read().collect()} == want
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith(("merged", "arrived"))]) <= 2 * 4


def test_state_table_takes_keys_out_and_ignores_older_rows(spark, tmp_path):
    t = table_of(spark, tmp_path / "t", "out")
    t.merge(spark.createDataFrame([(1, 5, "a", False), (2, 5, "b", False), (3, 1, "c", False)], t.schema), 0)
    t.merge(spark.createDataFrame([(1, 4, "older", False), (2, 6, "b", True), (2, 5, "b", False)], t.schema), 1)
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, "a"), (3, "c")]
    t.merge(spark.createDataFrame([(1, 7, "a", True), (3, 7, "c", True)], t.schema), 2)
    assert t.read().collect() == []


def test_a_batch_that_fails_leaves_the_table(spark, tmp_path):
    t = table_of(spark, tmp_path / "t")
    t.merge(spark.createDataFrame([(1, 5, "a", False)], t.schema), 0)
    held = t.read()
    bad = spark.createDataFrame([(1, 6, "x", False)], t.schema).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        t.merge(bad, 1)
    assert [r.v for r in t.read().collect()] == ["a"]
    t.merge(spark.createDataFrame([(1, 6, "b", False)], t.schema), 1)
    assert [r.v for r in t.read().collect()] == ["b"] and [r.v for r in held.collect()] == ["a"]


# ---- retention ------------------------------------------------------------------------------

def labelled(df):
    return df.withColumn("label", F.when(F.col("event_type") == "error", F.lit("day x")).otherwise(F.date_format("ts", "yyyy-MM-dd")))


def test_retained_days_leave_the_state(spark, feed):
    day = 24 * 60
    f = io.FiniteStream(feed([event(i, i * day) for i in range(6)] + [event(90, 0, kind="error")], [event(7, 9 * day), event(8, 9 * day + 1)], [event(9, 12 * day)]), "t")
    progress = []
    out = io.merged(spark, ledgers.retain(labelled(f.rows), ["label"], F.col("label"), 3), "t", ["label"], ["until_ms", "n", "gone"], "gone", stream=f, end="2024-01-23 00:10:00", progress=progress)
    # Day 22 less three days is the 19th: that day stays, as does what is no day.
    assert {(r.label, r.n) for r in out.collect()} == {("2024-01-22", 1), ("day x", 1)}
    state = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in progress if p["stateOperators"]]
    assert max(state) > state[-1] > 0


def test_retained_days_equal_the_batch_filter(spark, feed):
    day = 24 * 60
    for days in (0, 2, 5):
        f = io.FiniteStream(feed([event(i, i * day + 17) for i in range(9)] + [event(90, 0, kind="error")]), "t")
        out = io.merged(spark, ledgers.retain(labelled(f.rows), ["label"], F.col("label"), days), "t", ["label"], ["until_ms", "n", "gone"], "gone", stream=f, end="2024-01-20 00:10:00")
        static = spark.createDataFrame([(f"2024-01-{10 + i}",) for i in range(9)] + [("day x",)], "label string")
        assert {r.label for r in out.collect()} == {r.label for r in ledger.retain(static, "label", "2024-01-20", days).collect()}


# ---- stranded claims and the end of the input -----------------------------------------------

def stranded_at(spark, batches, feed, end):
    f = io.FiniteStream(feed(*batches), "t")
    rows = f.rows.select(F.col("event_id").alias("record_id"), F.col("user_id").alias("entity_id"), "ts", F.col("event_type").alias("state"), io.END)
    return {(r.entity_id, r.state_at) for r in io.merged(spark, ledgers.stranded(rows, 60), "t", ["entity_id"], ["seq"], "gone", stream=f, end=str(end)).collect()}


@pytest.mark.parametrize("minutes_on", [61, 60, 59, 500])
def test_stranded_stream_has_the_batch_meaning(spark, feed, minutes_on):
    batches = [
        [event(1, 0, 1, "Claimed"), event(2, 0, 2, "Claimed"), event(3, 30, 2, "Sent")],
        [event(4, 25, 3, "Claimed"), event(6, 28, 4, "Claimed"), event(5, 29, 4, "NotSent")], [event(7, 95, 3, "MaybeSent"), event(8, 100, 5, "Claimed"), event(9, 120, 1, "Claimed")]]
    now = START + dt.timedelta(minutes=120 + minutes_on)
    rows = [e for b in batches for e in b]
    static = states(spark.createDataFrame(rows, io.EVENT_SCHEMA).withColumn("ts", F.col("ts").cast("timestamp")))
    want = {(r.entity_id, r.state_at) for r in ledger.stranded(ledger.claim_state(static, "entity_id"), str(now), 60).collect()}
    assert stranded_at(spark, batches, feed, now + dt.timedelta(minutes=10)) == want


def test_a_report_is_taken_back_when_the_claim_is_settled(spark, feed):
    late = [[event(1, 0, 1, "Claimed"), event(2, 200, 9, "Sent")], [event(3, 300, 9, "Sent")], [event(4, 310, 1, "Sent")], [event(5, 400, 9, "Sent")]]
    assert stranded_at(spark, late, feed, START + dt.timedelta(minutes=900)) == set()


def test_a_claim_that_arrives_after_its_settlement_is_not_stranded(spark, feed):
    batches = [[event(1, 30, 1, "Sent")], [event(2, 25, 1, "Claimed"), event(3, 26, 2, "Claimed")], [event(4, 400, 9, "Sent")], [event(5, 430, 9, "Sent")]]
    assert {k for k, _ in stranded_at(spark, batches, feed, START + dt.timedelta(minutes=440))} == {2}


def test_the_end_closes_the_last_day(spark, feed):
    f = io.FiniteStream(feed([event(1, 0, value=1.0)], [event(2, 24 * 60, value=2.0), event(3, 24 * 60 + 1, value=4.0)]), "t")
    out = io.appended(spark, ledgers.daily_spend(f.rows, kind="event_type", amount="value"), "t", stream=f).collect()
    assert {str(r.day): (r.spent, r.n) for r in out} == {"2024-01-10": (1.0, 1), "2024-01-11": (6.0, 2)}
