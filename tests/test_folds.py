"""Order-dependent operators against step-by-step loops, with skewed keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from siftwork.operators import budgets, discovery, ledger, metrics, windows


# ---- re-uploads -----------------------------------------------------------------------------

def keep_loop(rows, tol):
    """rows: (entity, item, title, seconds) in item order."""
    out, seen = [], {}
    for e, i, t, s in rows:
        if t and s:
            kept = seen.setdefault((e, t), [])
            if any(abs(s - k) <= tol for k in kept):
                continue
            kept.append(s)
        out.append((e, i))
    return sorted(out)


def test_reuploads_compare_with_kept_entries(rows):
    df = rows("entity_id string, item_id int, title string, seconds int",
              *[("a", i, "Same (v2)" if i % 2 else "same!", s) for i, s in enumerate([10, 15, 30, 35, 41])], ("a", 9, "", 10), ("a", 10, "", 10), ("a", 11, "same", None), ("b", 12, "same", 10))
    assert sorted(r.item_id for r in windows.drop_reuploads(df).collect()) == [0, 2, 4, 9, 10, 11, 12]


@pytest.mark.parametrize("seed", [1, 2])
def test_reuploads_equal_the_loop_with_a_hot_title(rows, seed):
    rnd = random.Random(seed)
    data = [(rnd.choice(["hot", "hot", "x", "y"]), i, rnd.choice(["same", "same", "other", ""]), rnd.choice([None, 0, *range(5, 400)])) for i in range(1500)]
    got = sorted((r.entity_id, r.item_id) for r in windows.drop_reuploads(rows("entity_id string, item_id int, title string, seconds int", *data)).collect())
    assert got == keep_loop(data, 10)


# ---- budgeted scan --------------------------------------------------------------------------

def scan_loop(kinds, q, f, patience, possible):
    tq = tf = wait = scanned = 0
    for k in kinds:
        if tq >= q and tf >= f:
            return scanned, tq, tf, "both_full"
        hunting = tq >= q
        if hunting and not possible:
            return scanned, tq, tf, "cut_over"
        if hunting and wait >= patience:
            return scanned, tq, tf, "patience"
        scanned += 1
        if k == "flagged":
            wait = 0
            tf = min(f, tf + 1)
        else:
            wait += hunting
            tq = min(q, tq + (k == "qualified"))
    return scanned, tq, tf, "end"


@pytest.mark.parametrize("q,f,patience,possible", [(3, 2, 10, True), (0, 2, 3, True), (1, 0, 5, True), (2, 5, 2, False), (1, 3, 4, True), (0, 0, 4, True), (5, 1, 10, True)])
def test_scan_end_equals_the_loop(rows, q, f, patience, possible):
    rnd = random.Random(q * 100 + f * 10 + patience)
    data, want = [], {}
    for key in range(40):
        n = 400 if key == 0 else rnd.randrange(1, 40)
        kinds = [rnd.choice(["qualified", "flagged", None, None, None, None]) for _ in range(n)]
        data += [(key, i, k) for i, k in enumerate(kinds)]
        want[key] = scan_loop(kinds, q, f, patience, possible)
    rnd.shuffle(data)
    got = budgets.scan_end(rows("key0 int, i int, kind string", *data), "key0", ["i"], F.col("kind"), q, f, patience, possible).collect()
    assert {r.key0: (r.scanned, r.taken_qualified, r.taken_flagged) for r in got} == {k: w[:3] for k, w in want.items()}


@pytest.mark.parametrize("gap", [8, 9, 10, 11])
def test_patience_ends_after_exactly_ten_fruitless_rows(rows, gap):
    kinds = ["qualified"] + [None] * gap + ["flagged"] + [None] * 20
    got = budgets.scan_end(rows("k int, i int, kind string", *[(0, i, k) for i, k in enumerate(kinds)]), "k", ["i"], F.col("kind"), 1, 5).first()
    assert (got.scanned, got.taken_flagged) == ((11, 0) if gap >= 10 else (1 + gap + 1 + 10, 1))


# ---- spend ----------------------------------------------------------------------------------

def afford_loop(events, day_cap, month_cap):
    state, out = {}, {}
    for account, ts, eid, amount in sorted(events, key=lambda e: (e[1], e[2])):
        u, day = round(amount * 10000), (ts - dt.timedelta(hours=5)).date()
        on, d, m = state.get(account, (None, 0, 0))
        if on is None or on != day:
            d, m = 0, (m if on and (on.year, on.month) == (day.year, day.month) else 0)
        ok = u <= 0 or (d + u <= day_cap * 10000 and m + u <= month_cap * 10000)
        if ok and u > 0:
            d, m = d + u, m + u
        state[account] = (day, d, m)
        out[eid] = ok
    return out


def spend_events(seed, n, amounts):
    rnd, start = random.Random(seed), dt.datetime(2024, 1, 29, 4)
    return [(rnd.choice([1, 1, 1, 2, 3]), start + dt.timedelta(seconds=rnd.randrange(4 * 86400)), i, rnd.choice(amounts)) for i in range(n)]


@pytest.mark.parametrize("seed,amounts", [(1, [0.5, 1.25, 3.0, 0.01]), (2, [0.0, -1.0, 2.5, 9.99, 10.01]), (3, [round(x / 100, 2) for x in range(1, 300)])])
def test_can_afford_equals_the_loop_with_a_hot_account(rows, seed, amounts):
    ev = spend_events(seed, 1200, amounts)
    df = rows("account int, ts timestamp, event_id bigint, amount double", *ev)
    got = {r.event_id: r.accepted for r in ledger.can_afford(df, 10.0, 24.0).collect()}
    assert got == afford_loop(ev, 10.0, 24.0)


def test_a_smaller_event_fits_after_a_refused_one(rows):
    t = dt.datetime(2024, 1, 2, 12)
    df = rows("account int, ts timestamp, event_id bigint, amount double", (1, t, 1, 6.0), (1, t + dt.timedelta(1e-5), 2, 5.0), (1, t + dt.timedelta(2e-5), 3, 4.0))
    assert [r.accepted for r in ledger.can_afford(df, 10.0, 100.0).orderBy("event_id").collect()] == [True, False, True]
    assert [r.accepted for r in ledger.can_afford(df, 10.0, 100.0, balance=4.5).orderBy("event_id").collect()] == [False, False, True]


# ---- metrics --------------------------------------------------------------------------------

def item(entity, i, day, views, seconds=600, w="1280", h="720", title=None, eng=10):
    return (entity, i, dt.datetime(2024, 1, 1) - dt.timedelta(days=day), title or f"t{i}", views, eng, seconds, w, h)


ITEM = "entity_id string, item_id int, published_at timestamp, title string, views bigint, engagements bigint, seconds int, w string, h string"


def test_sample_filters_before_the_limit_and_dates_do_not(rows):
    data = [item("a", i, 20 + i, 1000 + i, seconds=60) for i in range(12)] + [item("a", 100 + i, 40 + i, 50 + i) for i in range(12)]
    m = metrics.entity_metrics(rows(ITEM, *data), "2024-01-01 00:00:00").first()
    assert m.sample_size == 10 and m.min_views == 50 and m.avg_views == pytest.approx(54.5) and m.days_since == 20 and m.long_count == 12 and not m.all_short


def test_fallback_when_no_long_item_is_settled(rows):
    data = [item("a", i, 20 + i, 1000, seconds=60) for i in range(3)] + [item("a", 9, 2, 7), item("a", 10, 30, None)]
    m = metrics.entity_metrics(rows(ITEM, *data), "2024-01-01 00:00:00").first()
    assert m.min_views is None and list(m.settled_views) == [] and m.sample_size == 5 and m.avg_views == pytest.approx((3000 + 7) / 5)


def test_unreadable_shape_neither_makes_nor_breaks(rows):
    m = metrics.entity_metrics(rows(ITEM, item("a", 1, 30, 5, seconds=60), item("a", 2, 31, 5, seconds=None, w=None, h=None)), "2024-01-01 00:00:00").first()
    assert not m.all_short and m.long_count == 0


def test_clears_ratio_bounds(evaluate):
    cases = [[20_000] + [1] * 3, [20_000] + [1] * 4, [20_000] * 2 + [1] * 3, [20_000] * 2 + [1] * 8, [10_000] * 3 + [1] * 7, []]
    assert evaluate("v array<bigint>", cases, metrics.clears_ratio(F.col("v"))) == [True, False, True, False, True, True]


def test_dominant_prefers_count_then_first_seen(rows):
    df = rows("entity_id string, v string, pos int", ("a", "es", 2), ("a", "en", 1), ("a", "es", 4), ("a", "en", 3), ("a", "", 0), ("a", None, 5), ("b", None, 1))
    assert [tuple(r) for r in metrics.dominant(df, "v", "pos").collect()] == [("a", "en", 2)]


def test_repeated_contact_counts_items_not_mentions(rows):
    df = rows("entity_id string, pos int, c array<string>", ("a", 1, ["x", "x", "x"]), ("a", 2, ["y"]), ("a", 3, ["y"]), ("a", 4, ["y", "x"]))
    assert [tuple(r) for r in metrics.repeated_contact(df, F.col("c"), "pos").collect()] == [("a", "y", 3)]


@pytest.mark.parametrize("n,pick", [(1, 0), (2, 1), (3, 1), (4, 2)])
def test_representative_is_the_upper_median(rows, n, pick):
    df = rows("entity_id string, item_id int, views bigint, seconds int, position int", *[("a", i, 10 * i, 300, n - i) for i in range(n)], ("a", 99, 0, None, 50))
    assert windows.representative(df).first().item_id == pick


def test_deep_scan_answers_on_the_first_page_that_repeats(rows):
    df = rows("entity_id string, item_id int, c array<string>", *[("a", i, ["late"] if i in (1, 4, 7) else ["early"] if i in (0, 2, 5) else []) for i in range(9)])
    r = windows.deep_scan(df, F.col("c"), page_size=3, pages=2, order=["item_id"]).first()
    assert (r.contact, r.found_page, r.n_items) == ("early", 1, 3)


def test_early_stop_counts_distinct_fresh_ids(rows):
    hits = rows("entity_id int, idx int", (1, 0), (2, 0), (2, 1), (3, 1), (4, 2))
    got = discovery.early_stop(hits, ["a", "b", "c"], 3).orderBy("idx").collect()
    assert [(r.fresh, r.banked, r.searched) for r in got] == [(2, 2, True), (1, 3, True), (1, 4, False)]


def test_newest_n_keeps_only_n_rows_of_a_hot_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("entity_id"), F.col("id").alias("item_id"), F.timestamp_seconds("id").alias("published_at"))
    out = windows.newest_n(df, 10)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    hot = out.where("entity_id = 'hot'").orderBy("position").collect()
    assert [r.item_id for r in hot] == [29_997 - 3 * i for i in range(10)]


def test_a_title_with_very_many_lengths(spark):
    """100,000 lengths of one title, most of them on one island: one pass, no list."""
    n, tol = 100_000, 3
    df = spark.range(n).selectExpr("'a' as entity_id", "id as item_id", "'same title' as title", "cast(10 + pmod(id * 7919, 100003) as int) as seconds")
    seen, want = {}, 0
    for i in range(n):
        s = 10 + (i * 7919) % 100003
        cell = s // (tol + 1)
        if not any(abs(seen.get(c, -99) - s) <= tol for c in (cell - 1, cell, cell + 1)):
            seen[cell] = s
            want += 1
    assert windows.drop_reuploads(df, tol).count() == want
    assert "collect_list" not in windows.drop_reuploads(df, tol)._jdf.queryExecution().toString()


def test_an_account_with_a_million_amounts(spark):
    """The fold carries three numbers: no list, however many amounts an account has."""
    df = spark.range(1_000_000).selectExpr("1 as account", "timestamp'2024-01-05 12:00:00' + make_interval(0, 0, 0, 0, 0, 0, id / 1000) as ts", "id as event_id", "cast((pmod(id * 7919, 1000003) + 1) / 10000 as double) as amount")
    out = ledger.can_afford(df, 90.0, 700.0)
    assert "collect_list" not in out._jdf.queryExecution().toString()
    got = out.where("accepted").agg(F.max("day_total").alias("d"), F.count("*").alias("n")).first()
    total, n = 0, 0
    for i in range(1_000_000):
        u = (i * 7919) % 1000003 + 1
        if total + u <= 900_000:
            total, n = total + u, n + 1
    assert (got.n, got.d) == (n, total / 10000)


def chain_loop(items, page_size, pages, least):
    """items of one entity in order: (contacts, address)."""
    for step in range(pages + 1):
        n, first = {}, {}
        for at, (found, _) in enumerate(items[: page_size * (step + 1)]):
            for c in dict.fromkeys(found):
                n[c] = n.get(c, 0) + 1
                first.setdefault(c, at)
        good = sorted((-n[c], first[c], c) for c in n if n[c] >= least)
        if good:
            if step == 0:
                return good[0][2], 0
            older = good[0][2]
            break
    else:
        older = ""
    mail = next((a for _, a in items if a), "")
    return (mail, 1) if mail else (older, 2) if older else ("", None)


@pytest.mark.parametrize("seed", range(4))
def test_contact_chain_equals_the_steps(rows, seed):
    from siftwork.functions import fixed_values as V
    from siftwork.operators import contacts

    rnd = random.Random(seed)
    data, want = [], {}
    for e in range(30):
        mine = [([rnd.choice("abcdefgh") for _ in range(rnd.randrange(3))], rnd.choice([None, "", "", f"x{e}@y.z"]) if e % 3 == 0 else None) for _ in range(rnd.randrange(1, 40))]
        data += [(e, i, c, a) for i, (c, a) in enumerate(mine)]
        value, source = chain_loop(mine, 6, 2, 4)
        want[e] = (value, "" if source is None else V.CONTACT_SOURCES[source])
    rnd.shuffle(data)
    df = rows("entity_id int, item_id int, c array<string>, a string", *data)
    got = contacts.contact_chain(df, F.col("c"), F.col("a"), page_size=6, pages=2, min_items=4, order=["item_id"])
    assert {r.entity_id: (r.value, r.source) for r in got.collect()} == want and len({s for _, s in want.values()}) >= 3
