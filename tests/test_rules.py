"""Gates, suppression, guards, sinks and ledger states on literals."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siftwork.functions import links, text
from siftwork.operators import budgets, gates, ledger, matching, metrics, reports
from siftwork.plans import screening
from siftwork.sources import sinks, tables

GATE = "subscribers bigint, avg_views double, all_short boolean, language string, item_count bigint, settled_views array<bigint>, per_year double, days_since bigint"
GOOD = (1000, 20_000.0, False, "en", 30, [20_000] * 10, 6.0, 365)


def changed(**kw):
    names = [c.split()[0] for c in GATE.split(", ")]
    return tuple(kw.get(n, v) for n, v in zip(names, GOOD))


@pytest.mark.parametrize("change,reason", [
    ({}, None), ({"all_short": True}, "shorts_only"), ({"language": None}, "not_english"), ({"language": "fr"}, "not_english"),
    ({"item_count": 29}, "too_few_videos"), ({"item_count": None}, None), ({"avg_views": 9_999.0}, "below_view_minimum"), ({"avg_views": None}, "below_view_minimum"), ({"avg_views": 10_000.0}, None),
    ({"settled_views": [20_000] * 2 + [1] * 8}, "video_below_view_minimum"), ({"settled_views": [1] * 4}, None), ({"settled_views": None}, None),
    ({"per_year": 5.9}, "upload_cadence_too_low"), ({"per_year": None}, None), ({"days_since": 366}, "stale_channel"), ({"days_since": None}, None),
    ({"all_short": True, "language": "fr"}, "shorts_only"), ({"item_count": 1, "days_since": 999}, "too_few_videos"),
])
def test_hard_gate(rows, change, reason):
    assert rows(GATE, changed(**change)).select(gates.hard_gate(min_avg_views=10_000.0).alias("r")).first().r == reason


@pytest.mark.parametrize("subs,views,dead", [(99, 99.0, True), (100, 99.0, False), (99, 100.0, False), (None, None, True)])
def test_dead_needs_both(rows, subs, views, dead):
    got = rows(GATE, changed(subscribers=subs, avg_views=views)).select(gates.hard_gate(min_avg_views=0.0).alias("r")).first().r
    assert got == ("dead_channel" if dead else None)


def test_off_target_equal_shares_and_missing_terms(rows):
    df = rows("entity_id string, title string", *[("tie", t) for t in ("Fortnite", "sofa tour")], *[("off", t) for t in ("Xbox", "minecraft", "sofa")], ("none", " "), ("on", "sofa"))
    shares = metrics.off_target_shares(df, {"gaming": ["fortnite", "xbox", "minecraft"]}, ["sofa"])
    v = shares.select("entity_id", metrics.off_target_verdict(F.array().cast("array<string>")).alias("v")).collect()
    assert {r.entity_id: r.v and r.v.detail for r in v} == {"tie": None, "off": "67% of 3 recent titles are gaming vs 33% on-niche", "on": None}


def test_persona_needs_a_title_hit_and_no_category_list(rows):
    df = rows("n_titles bigint, off_hits bigint, on_hits bigint, categories array<string>, bio string", (50, 2, 0, ["gaming"], "a Gamer who likes let's play"), (50, 0, 0, [], "gamer"))
    sig = text.persona_signals("bio")
    got = [r.v for r in df.select(metrics.off_target_verdict(sig).alias("v")).collect()]
    assert got[0].detail.endswith("""; bio says ['gamer', "let's play"]""") and got[1] is None
    assert df.select(metrics.off_target_verdict(sig, restricted=True).alias("v")).first().v is None


# ---- suppression ----------------------------------------------------------------------------

LIST = "name string, url string, email string"
ENT = "entity_id int, handle string, email string, title string"


def test_suppression_order_and_blanks(rows):
    lst = rows(LIST, (" Bad Co ", "https://v/@Bad/about", "X@Y.z "), ("", "no handle here", None), (None, None, "only@mail.q"))
    ent = rows(ENT, (1, "@BAD", "x@y.z", "bad co"), (2, "", "x@y.z", "bad co"), (3, "", "", "Bad Co"), (4, "", "", ""), (5, "ok", "ok@ok.k", "Bad  Co"), (6, None, " ONLY@mail.q", None))
    hits = {r.entity_id: r.hit for r in matching.suppression_hits(ent, lst, handle="handle", email="email", name="title").collect()}
    assert hits == {1: "handle @bad", 2: "email x@y.z", 3: "name 'Bad Co'", 6: "email only@mail.q"}
    assert sorted(r.entity_id for r in matching.suppress(ent, lst, handle="handle", email="email", name="title").collect()) == [4, 5]


@pytest.mark.parametrize("data", [[], [("", "no handle", " ")]])
def test_suppression_fails_closed(spark, rows, data):
    lst = spark.createDataFrame(data, LIST)
    ent = rows(ENT, (1, "a", "b", "c"))
    with pytest.raises(Exception, match="suppression list"):
        matching.suppress(ent, lst, handle="handle", name="title").collect()
    with pytest.raises(Exception, match="suppression list"):
        matching.suppression_index(lst).collect()


def test_suppression_fails_closed_on_an_empty_file(spark, rows, tmp_path):
    path = str(tmp_path / "list")
    spark.createDataFrame([], LIST).write.parquet(path)
    big = spark.range(1000).select(F.col("id").alias("entity_id"), F.lit("h").alias("handle"), F.lit("n").alias("title"))
    with pytest.raises(Exception, match="suppression list"):
        matching.suppress(big, spark.read.schema(LIST).parquet(path), handle="handle", name="title").count()


def test_external_handle_beats_name_and_earliest_source_wins(rows):
    a = rows("link string, n string", ("https://v/@one", "Shared  Name"))
    b = rows("u string, d string", ("@one", "x"), ("@two", "shared name"))
    idx = tables.multi_source_index([(a, "A", "link", "n"), (b, "B", "u", "d")])
    ent = rows("entity_id int, handle string, title string", (1, "one", "zzz"), (2, "two", "Shared Name"), (3, "", "SHARED   name"), (4, "", ""))
    assert {r.entity_id: r.source for r in matching.match_external(ent, idx).collect()} == {1: "A", 2: "B", 3: "A"}


def test_exclude_set_never_cuts_must_keep(rows):
    ext = rows("kind string, key string, source string, source_rank int", ("handle", "a", "South", 1), ("handle", "b", "North", 0), ("handle", "z", "south two", 2))
    keep = [rows("h string", ("k1",), ("k2",), ("",)), rows("h string", ("k2",), ("k3",))]
    assert {r.handle for r in matching.exclude_set(keep, ext, "south", cap=5).collect()} == {"k1", "k2", "k3", "a", "z"}
    assert {r.handle for r in matching.exclude_set(keep, ext, "", cap=4).collect()} == {"k1", "k2", "k3", "a"}
    assert {r.handle for r in matching.exclude_set(keep, ext, "south", cap=2).collect()} == {"k1", "k2", "k3"}


# ---- sinks ----------------------------------------------------------------------------------

def test_upsert_protects_and_is_idempotent(rows, tmp_path, spark):
    old = rows("id int, v string, status string", (1, "a", "Approved"), (2, "b", "New"))
    new = rows("id int, v string, status string", (2, "B", "Reset"), (3, "c", "New"))
    once = sinks.upsert(old, new, "id")
    want = [(1, "a", "Approved"), (2, "B", "New"), (3, "c", "New")]
    assert sorted(map(tuple, once.collect())) == want
    path = str(tmp_path / "s1")
    sinks.write_snapshot(once, path)
    for version in (2, 3):  # written back to the table it was computed from
        assert sinks.upsert_snapshot(new, path, "id") == version
        assert sorted(map(tuple, sinks.read_snapshot(spark, path).collect())) == want


def test_a_failed_write_leaves_the_old_version(rows, tmp_path, spark):
    path = str(tmp_path / "t")
    first = rows("id int, v string", (1, "a"), (2, "b"))
    sinks.write_snapshot(first, path)
    table = lambda back=0: sorted(map(tuple, sinks.read_snapshot(spark, path, back).collect()))
    broken = first.withColumn("v", F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="no"):
        sinks.write_snapshot(broken, path)
    with pytest.raises(ValueError, match="not unique"):
        sinks.write_snapshot(first.union(first), path, unique="id")
    assert table() == [(1, "a"), (2, "b")]
    held = sinks.read_snapshot(spark, path)
    sinks.write_snapshot(first.where("id = 1"), path)
    assert table() == [(1, "a")] and table(1) == [(1, "a"), (2, "b")] == sorted(map(tuple, held.collect()))
    with pytest.raises(FileNotFoundError):
        sinks.read_snapshot(spark, path, 2)
    sinks.write_snapshot(first, path, partition_by=["v"])
    assert table() == [(1, "a"), (2, "b")] and len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("version-")]) == 2


def test_delete_from_the_table_itself(spark, tmp_path):
    path = str(tmp_path / "d")
    sinks.write_snapshot(spark.range(40), path)
    sinks.delete_from_snapshot(spark.range(10), path, "id")
    assert sinks.read_snapshot(spark, path).count() == 30
    sinks.delete_from_snapshot(spark.range(10, 40), path, "id")
    assert sinks.read_snapshot(spark, path).count() == 30


def test_sparse_upsert_never_blanks(rows):
    old = rows("id int, email string", (1, "typed@x.y"), (2, None))
    new = rows("id int, email string", (1, None), (2, "found@x.y"))
    assert sorted(map(tuple, sinks.upsert(old, new, "id", protected=(), sparse=True).collect())) == [(1, "typed@x.y"), (2, "found@x.y")]


@pytest.mark.parametrize("n,k,left", [(100, 25, 75), (100, 26, 100), (10, 5, 5), (10, 6, 10), (10, 0, 10)])
def test_guarded_delete(spark, n, k, left):
    df = spark.range(n)
    assert sinks.guarded_delete(df, "id", df.where(F.col("id") < k)).count() == left


def test_enum_guard_stops(rows):
    df = rows("s string", ("a",), ("b",), (None,))
    assert sinks.enum_guard(df, "s", ["a", "b"]).count() == 3
    with pytest.raises(Exception, match="not an option"):
        sinks.enum_guard(df, "s", ["a"]).collect()
    assert len(sinks.enum_guard(df, "s", ["a"], allow_new=True).collect()) == 3


# ---- ledgers --------------------------------------------------------------------------------

def test_classify_claims_precedence(rows):
    cases = {"s": ["Sent", "MaybeSent", "Claimed", "NotSent"], "m": ["MaybeSent", "Claimed", "NotSent"], "c": ["Claimed", "NotSent"], "n": ["NotSent"], "u": ["Sent", "sent"], "x": [None, "Sent"]}
    df = rows("key string, state string", *[(k, s) for k, v in cases.items() for s in v])
    assert {r.key: r.reason for r in ledger.classify_claims(df, "key").collect()} == {
        "s": "already_sent", "m": "maybe_sent", "c": "in_flight", "n": "previously_not_sent", "u": "unknown_state", "x": "unknown_state"}


def test_claim_decision_order_and_budget(rows):
    q = rows("entity_id int, claim_key string, qualification string, address string, ord int",
             (None, "", "Qualified", "a", 1), (2, "2:c", "New Channel", "b", 2), (3, "3:c", "Qualified", "c", 3), (4, "4:c", "Qualified", "d", 4), (5, "5:c", "Qualified", "e", 5),
             (6, "6:c", "Qualified", "e", 6), (7, "7:c", "Qualified", "f", 7), (8, "8:c", "Qualified", "e", 8), (9, "9:c", None, "z", 9))
    led = rows("entity_id int, claim_key string, state string", (3, "3:old", "Sent"), (4, "4:c", "NotSent"))
    one = rows("remaining bigint", (2,))
    got = {r.ord: r.reason for r in ledger.claim_decision(q, led, one).collect()}
    assert got == {1: "no_channel_id", 2: "not_qualified", 3: "already_sent", 4: "previously_not_sent", 5: "granted", 6: "duplicate_address", 7: "granted", 8: "over_daily_cap", 9: "not_qualified"}
    retry = {r.ord: r.reason for r in ledger.claim_decision(q, led, one, allow_retry=True, allow_recontact=True).collect()}
    assert retry[3] == "granted" and retry[4] == "granted" and retry[5] == "over_daily_cap"
    assert {r.reason for r in ledger.claim_decision(q, led, rows("remaining bigint", (0,))).where("ord >= 5 and ord < 9").collect()} == {"over_daily_cap"}


def test_retention_keeps_cutoff_and_unreadable(rows):
    df = rows("day string", ("2024-01-24",), ("2024-01-23",), ("2024-13-40",), ("soon",), (None,))
    assert [r.day for r in ledger.retain(df, "day", "2024-01-31", 7).collect()] == ["2024-01-24", "2024-13-40", "soon", None]


def test_followup_order(rows):
    t = dt.datetime(2024, 1, 1)
    e = rows("entity_id int, requested boolean, qualification string, reply_state string",
             (1, False, "Qualified", "No Reply"), (2, True, "x", "No Reply"), (3, True, "Qualified", "No Reply"), (4, True, "Qualified", ""), (5, True, "Qualified", "Replied"), (6, True, "Qualified", "No Reply"), (7, True, "Qualified", "No Reply"), (8, True, "Qualified", "No Reply"))
    led = rows("entity_id int, state string, settled_at timestamp, claimed_at timestamp", (4, "Sent", t, t), (5, "Sent", t, t), (6, "Sent", t, t), (6, "Sent", t, t), (7, "Sent", None, dt.datetime(2024, 3, 1)), (8, "Sent", t, t), (8, "NotSent", t, t))
    got = {r.entity_id: (r.reason, r.touch_number, r.next_campaign) for r in ledger.followup(e, led, "2024-04-01 00:00:00", "spring").collect()}
    assert got == {1: ("followup_not_requested", 0, ""), 2: ("not_qualified", 0, ""), 3: ("no_prior_send", 0, ""), 4: ("reply_state_unknown", 0, ""), 5: ("replied", 0, ""),
                   6: ("max_touches_reached", 2, ""), 7: ("too_soon", 1, ""), 8: ("granted", 2, "spring-followup2")}


def test_budgets_fill_in_order_and_claims_pass_on(rows):
    c = rows("entity_id int, niche string, qualification string", *[(i, "n", "q" if i % 2 else "f") for i in range(8)])
    room = rows("niche string, qualification string, headroom bigint", ("n", "q", 2), ("n", "f", 0))
    assert sorted(r.entity_id for r in budgets.fill_budgets(c, room, ["entity_id"]).collect()) == [1, 3]
    both = rows("entity_id int, niche string", (1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "b"))
    got = {(r.entity_id, r.niche) for r in budgets.first_niche_claims(both, ["a", "b"], 1, ["entity_id"]).collect()}
    assert got == {(1, "a"), (2, "b")}


def test_backtest_median_is_upper(rows):
    df = rows("niche string, status string, score int, flag boolean", *[("n", "Approved", s, s > 1) for s in (1, 2, 3, 4)], ("n", "Rejected", 9, False))
    r = {(x.grp, x.status): x for x in reports.backtest(df, "niche", "status", "score", "flag").collect()}
    assert r["ALL", "Approved"].median == 3 and r["n", "Rejected"].median == 9 and r["ALL", "Approved"].base_rate == 0.8 and r["ALL", "Approved"].p_given_noflag == 0.5


def test_screen_reports_the_first_reason(spark, rows, tmp_path):
    ent = rows("entity_id int, title string, handle string, description string, country string, language string, subscribers bigint, published_at timestamp, email string, links array<string>",
               (1, "Blocked", "b", "politics", "", "fr", 10, None, "", None), (2, "Topic", "t", "politics", "", "fr", 10, None, "", None), (3, "Fine", "f", "sofas", "US", "en", 90_000, dt.datetime(2020, 1, 1), "ok@ok.k", ["x"]),
               (4, "No items", "g", "", "US", "en", 10, None, "", None), (5, "Empty links", "h", "", "US", "en", 90_000, None, "", []))
    day = dt.datetime(2024, 1, 1)
    items = [(e, e * 100 + i, day - dt.timedelta(days=20 + 7 * i), f"sofa {i}", 50_000, 500, 600, "1280", "720") for e in (3, 5) for i in range(40)]
    rules = screening.Rules(zone=["US"], on_terms=["sofa"], gate=dict(min_avg_views=10_000.0))
    args = dict(suppression=rows(LIST, ("blocked", "", "")), known=rows("id int", (99,)))
    its = rows("entity_id int, item_id int, published_at timestamp, title string, views bigint, engagements bigint, seconds int, w string, h string", *items)
    want = {1: "blocked", 2: "excluded_topic", 3: None, 4: "unreachable", 5: "no_social_presence"}
    for stage in (None, str(tmp_path / "stage")):
        got = screening.screen(ent, its, rules, "2024-01-01 00:00:00", stage=stage, **args).collect()
        assert {r.entity_id: r.reason for r in got} == want
    passed = next(r for r in got if r.entity_id == 3)
    assert passed.qualification == "Qualified" and passed.risk == 0.0 and passed.score > 50


def test_headroom_is_used_by_passing_rows_only(rows):
    sc = rows("entity_id int, niche string, bucket string, reason string, detail string",
              (1, "n", "Qualified", "no_social_presence", ""), (2, "n", "Qualified", None, None), (3, "n", None, "shorts_only", ""), (4, "n", "Qualified", "blocked", "email x"),
              (5, "n", "New Channel", None, None), (6, "m", "Qualified", None, None))
    room = rows("niche string, bucket string, headroom int", ("n", "Qualified", 1), ("n", "New Channel", 0))
    got = {r.entity_id: r.reason for r in budgets.apply_headroom(sc, room, ["entity_id"]).collect()}
    full = "no_headroom_for_bucket"
    assert got == {1: "no_social_presence", 2: None, 3: "shorts_only", 4: full, 5: full, 6: None}


def test_normalise_items_tells_absent_from_unreadable(rows):
    schema = ("entity_id string, raw struct<id:string,snippet:struct<title:string,description:string,publishedAt:string,defaultAudioLanguage:string,defaultLanguage:string>,"
              "statistics:struct<viewCount:string,likeCount:string,commentCount:string>,contentDetails:struct<duration:string>,player:struct<embedWidth:string,embedHeight:string>>")
    df = rows(schema, ("a", ("v1", ("T", None, "2024-01-02T03:04:05Z", "", "en-GB"), ("12", None, "x"), ("PT1M",), ("720", "1280"))), ("a", ("v2", (None, None, "bad", "fr", "en"), (None, "3", "4"), (None,), (None, None))),
              ("a", ("v3", None, ("many", None, None), None, None)))
    got = [(r.item_id, r.title, r.published_at, r.views, r.engagements, r.seconds, r.language) for r in tables.normalise_items(df).collect()]
    assert got == [("v1", "T", dt.datetime(2024, 1, 2, 3, 4, 5), 12, 0, 60, "en-GB"), ("v2", "", None, None, 7, None, "fr"), ("v3", "", None, 0, 0, None, "")]


def test_budgets_above_any_literal_are_filled(rows):
    c = rows("entity_id int, niche string, qualification string", *[(i, "a", "q") for i in range(20)])
    room = rows("niche string, qualification string, headroom bigint", ("a", "q", 12))
    assert sorted(r.entity_id for r in budgets.fill_budgets(c, room, ["entity_id"]).collect()) == list(range(12))


def test_large_headroom_is_spent_in_order(rows):
    sc = rows("entity_id int, niche string, bucket string, reason string, detail string", *[(i, "a", "q", None, None) for i in range(20)])
    room = rows("niche string, bucket string, headroom bigint", ("a", "q", 12))
    got = {r.entity_id: r.reason for r in budgets.apply_headroom(sc, room, ["entity_id"]).collect()}
    assert [i for i in range(20) if got[i] is None] == list(range(12)) and got[12] == "no_headroom_for_bucket"


def test_a_large_send_budget_grants_all_it_covers(rows):
    q = rows("entity_id int, claim_key string, qualification string, address string, ord int", *[(i, f"k{i}", "Qualified", f"a{i}", i) for i in range(20)])
    led = rows("entity_id int, claim_key string, state string, settled_at timestamp, claimed_at timestamp")
    got = [r.reason for r in ledger.claim_decision(q, led, rows("remaining bigint", (15,))).orderBy("ord").collect()]
    assert got == ["granted"] * 15 + ["over_daily_cap"] * 5


# ---- nested links ---------------------------------------------------------------------------

def walk(node, depth=0, out=None):
    """Destinations as a recursive walk finds them, fields of an object by name."""
    out = [] if out is None else out
    if depth <= 12 and isinstance(node, dict):
        if isinstance(node.get("url"), str) and "/redirect" in node["url"]:
            out.append(node["url"].split("q=")[-1])
        for k in sorted(node):
            walk(node[k], depth + 1, out)
    elif depth <= 12 and isinstance(node, list):
        for x in node:
            walk(x, depth + 1, out)
    return list(dict.fromkeys(out))


def link_to(x):
    return {"url": f"https://go.example/redirect?q={x}"}


def deep(node, n):
    return {"in": [deep(node, n - 2)]} if n > 1 else ({"in": node} if n else node)


def test_nested_links_equal_the_walk(rows):
    import json

    docs = [
        [deep(link_to("a"), 9), deep(link_to("b"), 8), link_to("a")], [], {}, None, 7, "https://go.example/redirect?q=text",
        {"url": "https://go.example/redirect?q=own", "z": link_to("later"), "m": [link_to("1"), {"url": 5, "k": link_to("2")}]},
        [deep(link_to("edge"), 11)], [deep(link_to("too deep"), 12)], {"url": {"url": "https://go.example/redirect?q=inner"}}, {"url": "https://plain.example"},
        [[link_to(str(i)) for i in range(30)], [[link_to("3")]]]]
    data = [(i, json.dumps(x)) for i, x in enumerate(docs)] + [(90, None), (91, ""), (92, "{not json")]
    got = {r.i: r.found for r in links.nested_links(rows("i int, doc string", *data), "doc", "found", host="go.example").collect()}
    assert got == {**{i: walk(x) for i, x in enumerate(docs)}, 90: [], 91: [], 92: []}


def test_language_and_item_count_decide_in_the_screen(spark, rows, tmp_path):
    day = dt.datetime(2024, 1, 1)
    ent = rows("entity_id int, title string, handle string, description string, country string, subscribers bigint, published_at timestamp, email string, links array<string>, item_count bigint",
               *[(e, f"T{e}", f"h{e}", "text" * 9, "US", 90_000, day, "", None, n) for e, n in ((1, 40), (2, 40), (3, None), (4, 2), (5, 40))])
    tags = {1: ["en", "de"], 2: ["de", "en"], 3: ["", "en-GB", None], 4: ["en"], 5: ["", None]}  # newest first, in turn
    its = rows("entity_id int, item_id int, published_at timestamp, title string, views bigint, engagements bigint, seconds int, w string, h string, language string",
               *[(e, e * 100 + i, day - dt.timedelta(days=20 + 7 * i), f"sofa {i}", 50_000, 500, 600, "1280", "720", t[i % len(t)]) for e, t in tags.items() for i in range(40)])
    rules = screening.Rules(zone=["US"], gate=dict(min_avg_views=10_000.0))
    stage = str(tmp_path / "stage")
    got = {r.entity_id: r for r in screening.screen(ent, its, rules, "2024-01-01 00:00:00", stage=stage).collect()}
    assert {e: (r.reason, r.language) for e, r in got.items()} == {1: (None, "en"), 2: ("not_english", "de"), 3: (None, "en-GB"), 4: ("too_few_videos", "en"), 5: ("not_english", "")}
    assert got[4].detail.startswith("avg 50,000 views, ") and got[4].detail.endswith(", 2 videos, lang en") and got[5].detail.endswith("40 videos, lang unset")
    for step in ("rules", "keys"):  # no long text goes into either folder
        assert "description" not in spark.read.parquet(f"{stage}/{step}").columns


def test_one_index_of_all_lists(rows):
    ent = rows("entity_id int, title string, handle string, email string", (1, "Kim  Lee", "kim", "a@a.io"), (2, "Zed", "zed", " B@b.io "), (3, "Ann", "", ""), (4, None, None, None), (5, "Q", "q", ""))
    sup = rows(LIST, ("Kim  Lee", "https://x.example/@kim", ""), ("", "", "b@B.io"))
    ext = rows("kind string, key string, source string, source_rank int", ("name", "kim lee", "B", 1), ("name", "ann", "B", 1), ("name", "ann", "A", 0), ("handle", "zed", "C", 2))
    index = matching.tagged_index(sup, ext, rows("id int", (3,), (3,)), rows("entity_id int", (5,)))
    got = {r.entity_id: tuple(r)[1:] for r in matching.index_hits(ent, index).collect()}
    assert got == {1: ("handle @kim", None, "B", False, False), 2: (None, "email b@b.io", "C", False, False), 3: (None, None, "A", True, False), 5: (None, None, None, False, True)}
    with pytest.raises(Exception, match="suppression list has no rows"):
        matching.index_hits(ent, matching.tagged_index(sup.limit(0), ext)).collect()
