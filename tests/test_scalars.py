"""Edge cases of the scalar functions, on literals."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from siftwork.functions import geo, links, scoring, shape, text, verdicts
from siftwork.sources.bindings import flag


def test_normalize_handle(evaluate):
    got = evaluate("s string", ["https://www.youtube.com/@Foo.Bar/videos", "@x_1-y", "bare", "", None, "mail me@host.org"], text.normalize_handle("s"))
    assert got == ["foo.bar", "x_1-y", "", "", "", "host.org"]


def test_handle_key_falls_back_to_bare_text(evaluate):
    assert evaluate("s string", [" Bare\t", "@@Two", "https://v/@A/b", None], text.handle_key("s")) == ["bare", "two", "a", ""]


def test_normalize_title(evaluate):
    cases = ["MYSTERY Doors! (Portrait)", "a [b] c", "Émile  x", "({[nested]})", "", None, "Straße 7", "x (" + "y" * 31 + ")"]
    assert evaluate("s string", cases, text.normalize_title("s")) == ["mystery doors", "a b c", "mile x", "nested", "", "", "strasse 7", "x " + "y" * 31]


def test_duration_seconds(evaluate):
    cases = ["PT12M35S", "P1DT2H", "PT", "P1D", "", None, "abc", " PT5S ", "PT0S"]
    assert evaluate("s string", cases, shape.duration_seconds("s")) == [755, 93600, None, None, None, None, None, 5, None]


def test_orientation_and_short_form(evaluate):
    cases = [(100, "720", "1280"), (180, "1280", "720"), (181, "1280", "720"), (999, "720", "720"), (999, "0", "1280"),
             (None, "abc", "x"), (None, "720", "1280"), (None, "1280", "720"), (None, None, None)]
    schema = "secs int, w string, h string"
    assert evaluate(schema, cases, shape.is_vertical("w", "h")) == [True, False, False, False, None, None, True, False, None]
    assert evaluate(schema, cases, shape.is_short("secs", "w", "h")) == [True, True, False, False, False, None, True, None, None]


def test_parse_ts(evaluate):
    cases = ["2024-01-02", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05.250Z", "2024-01-02T03:04:05+02:00", "2024", "2024-13-01", "x", None, ""]
    got = evaluate("s string", cases, F.date_format(shape.parse_ts("s"), "yyyy-MM-dd HH:mm:ss.SSS"))
    assert got == ["2024-01-02 00:00:00.000", "2024-01-02 03:04:05.000", "2024-01-02 03:04:05.250", "2024-01-02 01:04:05.000", None, None, None, None, None]


def test_settled_needs_whole_days(evaluate):
    cases = ["2024-01-17 12:00:00", "2024-01-17 12:00:01", None]
    assert evaluate("s string", cases, shape.settled(F.col("s").cast("timestamp"), "2024-01-31 12:00:00")) == [True, False, False]


def test_cadence_shapes(evaluate):
    schema = "n int, a string, b string"
    a, b = F.col("a").cast("timestamp"), F.col("b").cast("timestamp")
    cases = [(1, "2024-01-01", "2024-01-01"), (10, "2024-01-01", "2024-01-01"), (2, "2023-01-01", "2024-01-01"), (0, None, None)]
    assert evaluate(schema, cases, shape.upload_frequency("n", a, b)) == [0.0, 10.0, 0.16, 0.0]
    assert evaluate(schema, cases, shape.uploads_per_year("n", a, b)) == [None, None, pytest.approx(1.92), None]


def test_qualify(evaluate):
    assert evaluate("a double", [11.9, 12.0, None], shape.qualify("a", 12.0)) == ["New Channel", "Qualified", "Qualified"]
    assert evaluate("a double", [0.0], shape.qualify("a", None)) == ["Qualified"]


def test_as_int(evaluate):
    assert evaluate("s string", ["12", " -3 ", "1.5", "x", None, "99999999999999999999"], text.as_int("s")) == [12, -3, 0, 0, 0, 0]


def test_csv_round_trip(evaluate):
    cases = ["=x", "+x", "-x", "@x", "\tx", "\rx", "'=already", "'Round Midnight", "plain", "", None]
    safe = evaluate("s string", cases, text.csv_safe("s"))
    assert safe == ["'=x", "'+x", "'-x", "'@x", "'\tx", "'\rx", "'=already", "'Round Midnight", "plain", "", None]
    assert evaluate("s string", safe, text.csv_unsafe("s"))[:6] == cases[:6]
    assert evaluate("s string", ["'Round Midnight", "'", "''=x"], text.csv_unsafe("s")) == ["'Round Midnight", "'", "''=x"]


def test_redact_and_greeting(evaluate):
    assert evaluate("s string", ["john@x.org", "no", None, "@x"], text.redact("s")) == ["j***@x.org", "?", "?", "***@x"]
    assert evaluate("s string", [" Bob\r\n", "\x00***", "", None, "日本"], text.greeting_name("s")) == ["Bob", "there", "there", "there", "日本"]


def test_display_count(evaluate):
    assert evaluate("n bigint", [999, 1000, 121_400, 3_500_000, 3_000_000], text.display_count("n")) == ["999", "1K", "121K", "3.5M", "3M"]


def test_non_latin_thresholds(evaluate):
    cases = ["日" * 7, "日" * 8, "日" * 8 + "a" * 72, "日" * 8 + "a" * 73, "", None, "é" * 50, "  " + "日" * 8 + "a" * 72 + "  "]
    assert evaluate("s string", cases, text.non_latin("s")) == [False, True, True, False, False, False, False, True]


def test_english_tag(evaluate):
    assert evaluate("s string", ["en", " EN-gb", "eng", "fr", "", None], text.is_english("s")) == [True, True, True, False, False, False]


def test_topics_match_words_in_category_order(evaluate):
    cases = ["GLOCK and politics", "apolitical", "the maga hat", "Décor", "left-wing", "asmr!", None]
    assert evaluate("s string", cases, text.excluded_topic(["s"])) == ["political", None, "political", None, "political", "asmr", None]


def test_broadcaster_names_count_in_the_title_only(evaluate):
    cases = [("HGTV Home", ""), ("Jo", "as seen on HGTV"), ("Jo", "Full Episodes weekly"), ("A&E fan", None), ("itvx", "x")]
    assert evaluate("t string, d string", cases, text.broadcaster("t", "d")) == ["broadcast_tv_name", None, "broadcast_tv_phrase", "broadcast_tv_name", None]


def test_country_code(evaluate):
    cases = ["us", "United  States", "Korea", "Unknown", "", None, "N/A", "-", "Atlantis", "Czech Republic", "XX"]
    assert evaluate("s string", cases, geo.country_code("s")) == ["US", "US", "KR", "", "", "", "", "", "", "CZ", "XX"]


def test_region_of(evaluate):
    assert evaluate("s string", ["en-GB", "zh-Hant-TW", "en", "en-419", "pt_br", None], geo.region_of("s")) == ["GB", "TW", "", "", "BR", ""]


def test_flags(evaluate):
    cases = [f"Tea {flag('NP')}", flag("USCA"), f"{flag('QA')} and {flag('BR')}", "none", None]
    assert evaluate("s string", cases, F.array_join(geo.flag_codes("s"), ",")) == ["NP", "CA,US", "BR,QA", "", ""]
    assert evaluate("s string", cases, geo.flag_outside("s", ["US", "CA"])) == ["NP", "", "BR", "", ""]


PLACES = {"Qatar": "QA", "Nepal": "NP", "Sri Lanka": "LK", "Saudi Arabia": "SA", "Viet Nam": "VN"}


def test_title_country_is_a_word_and_longest_first(evaluate):
    cases = {f(p): code for p, code in PLACES.items() for f in (str.upper, str.lower, lambda p: f"Two weeks, {p}: part 1")}
    cases |= {f(p): "" for p in PLACES for f in (lambda p: f"{p}i tea", lambda p: f"no{p}")}
    cases |= {"Republic of Ireland by rail": "IE", "Canada": "", "": ""}
    assert evaluate("s string", list(cases), geo.title_country("s")) == list(cases.values())


@pytest.mark.parametrize("cue", ["located in", "Living in", "life in", "moved to", "HOME BASE", "from the quiet coast in", "from a boat in", "Location -", "\N{ROUND PUSHPIN}"])
def test_description_needs_a_cue(evaluate, cue):
    cases = {}
    for p, code in PLACES.items():
        cases |= {f"{cue} {p}": code, f"Hello! {cue} a town near {p}, mostly": code, f"{cue} {'x' * 58} {p}": code, f"{cue} {'x' * 59} {p}": "", f"{cue}\n{p}": "", f"Songs about {p}": "", f"{cue} {p}ville": ""}
    assert evaluate("s string", list(cases), geo.desc_location("s")) == list(cases.values())


def test_location_precedence(evaluate):
    zone, told = ["US", "CA"], "located in Qatar"
    cases = [(f"X {flag('BR')} Nepal", told, "US"), ("Nepal X", told, "US"), ("X", told, "US"), ("X", "", "Germany"), ("X", "", ""), ("X", "", "us")]
    got = evaluate("t string, d string, c string", cases, geo.location_gate("t", "d", "c", zone))
    outside = [("outside_search_zone", d) for d in ("title flies the BR flag", "title names NP", "description says QA", "declared country Germany")]
    assert [g and (g.reason, g.detail) for g in got] == [*outside, ("no_declared_country", "no country set on the channel"), None]



def test_emails(evaluate):
    cases = ["a@cash.app then b@studio.com", "x@YouTube.com", "none", None, "+promo@s.co.uk!", "a@b.co%x@y.org"]
    assert evaluate("s string", cases, links.first_email("s")) == ["b@studio.com", "", "", "", "+promo@s.co.uk", "a@b.co"]


def test_links(evaluate):
    cases = ["https://www.youtube.com/redirect?e=1&q=https%3A%2F%2Fmy.site%2Fa%3Fb%3D1&v=2", "https://x.org/redirect?q=1", "", None]
    assert evaluate("s string", cases, links.unwrap_redirect("s")) == ["https://my.site/a?b=1", "https://x.org/redirect?q=1", "", ""]
    assert evaluate("s string", ["www.Foo.com/x", "http://u:p@A.b:80/c", "//h.org", "", None], links.link_host("s")) == ["foo.com", "a.b", "h.org", "", ""]
    assert evaluate("s string", ["www.foo.com/x?y", "HTTP://a.b:8/c"], links.contact_url("s")) == ["https://www.foo.com/contact", "http://a.b:8/contact"]


def test_link_lists(evaluate):
    cases = [["www.foo.com", "https://linktr.ee/x", "www.foo.com", "", "https://b.org"], [], None]
    assert evaluate("s array<string>", cases, links.external_links("s")) == [["https://www.foo.com", "https://b.org"], [], []]
    social = [["https://www.facebook.com/me/", "facebook.com/me/about", "https://facebook.com/profile.php?id=3", "https://facebook.com/", "https://x.com/me"]]
    assert evaluate("s array<string>", social, links.about_urls("s")) == [["https://www.facebook.com/me/about", "https://facebook.com/me/about"]]
    assert evaluate("s array<string>", [[], ["a"], None], links.no_presence("s")) == ["no_social_presence", None, None]


def test_safe_urls(evaluate):
    uc = "UC" + "a" * 22
    cases = [(f"https://www.youtube.com/channel/{uc}\r", ""), ("javascript:x", uc), ("https://www.youtube.com/@a-b", None), ("bad", "bad")]
    assert evaluate("u string, eid string", cases, links.safe_entity_url("u", "eid")) == [
        f"https://www.youtube.com/channel/{uc}", f"https://www.youtube.com/channel/{uc}", "https://www.youtube.com/@a-b", None]
    assert evaluate("u string", ["http://a/b", "mailto:a@b.c?subject=x", "data:x", "javascript:a", None], links.safe_unsubscribe_url("u")) == [
        "http://a/b", "mailto:a@b.c?subject=x", None, None, None]
    assert evaluate("u string", ["https://y/watch?v=abc&t=1", "https://y/shorts/xyz/", "plain"], links.item_id_from_url("u")) == ["abc", "xyz", "plain"]


def test_scores(evaluate):
    cases = [(0, 10.0, 1.0), (1000, 0.0, 0.0), (100_000, 100.0, 0.1), (1000, 1000.0, 5.0), (100, 1.0, 0.5)]
    assert evaluate("s bigint, v double, e double", cases, scoring.fake_follower_risk("s", "v", "e")) == [100.0, 80.0, 90.8, 0.0, 22.5]
    assert evaluate("f double", [0.0, 1.0, 2.0, 20.0, 25.0, 100.0], scoring.norm_freq("f")) == [0.0, 50.0, 100.0, 100.0, 80.0, 50.0]
    assert evaluate("v double", [-1.0, 0.0, 999_999.0, 5e6], scoring.norm_log("v", 1_000_000)) == [0.0, 0.0, 100.0, 100.0]
    assert evaluate("v double", [4.0, 80.0, -1.0], scoring.norm_linear("v", 8.0)) == [50.0, 100.0, 0.0]


def test_criteria_hash_equals_canonical_json(evaluate, rows):
    crit = [("née", "does it – fit? 🎬"), ("plain", 'quote " and \\')]
    want = hashlib.sha256(json.dumps([{"name": n, "test": t} for n, t in crit], sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]
    df = rows("c array<struct<name:string,test:string>>", (crit,))
    assert df.select(verdicts.criteria_hash("c")).first()[0] == want


def body(text, finish="STOP"):
    return json.dumps({"candidates": [{"finishReason": finish, "content": {"parts": [{"text": text}]}}]})


def test_valid_verdict(evaluate):
    good = {"matches": True, "confidence": 0.5, "reason": "r", "criteria_results": []}
    cases = [body(json.dumps(good)), body(json.dumps({**good, "confidence": 1.1})), body(json.dumps({**good, "confidence": "0.5"})), body(json.dumps({**good, "matches": "true"})),
             body(json.dumps({**good, "criteria_results": {}})), body("", "max_tokens"), body("", "RECITATION"), body(""), body("[1]"), '{"candidates":[]}', "<html>", None,
             body(json.dumps({k: v for k, v in good.items() if k != "matches"}))]
    want = ["ok"] + ["malformed"] * 4 + ["max_tokens", "safety_blocked"] + ["malformed"] * 6
    assert evaluate("s string", cases, verdicts.valid_verdict("s")) == want


def test_verdict_confirms(evaluate):
    c = lambda *ms: [(f"c{i}", m, "e") for i, m in enumerate(ms)]
    cases = [(False, 0.59, c(True, True)), (True, 0.6, c(False)), (False, 0.9, c(True, False)), (False, 0.9, c(False, False, True)), (False, 0.9, []), (None, None, None), (True, 0.9, c(None, True))]
    p = F.struct(F.col("m").alias("matches"), F.col("f").alias("confidence"), F.col("r").alias("criteria_results"))
    schema = "m boolean, f double, r array<struct<criterion:string,matches:boolean,evidence:string>>"
    got = evaluate(schema, cases, verdicts.verdict_confirms(p))
    assert [(g.confirmed, g.why) for g in got] == [
        (False, "below confidence (0.59)"), (True, "video confirmed 0.60"), (True, "video partly confirmed 0.90 (1/2 criteria)"), (False, "video did not confirm (0.90, 1/3 criteria)"),
        (False, "video did not confirm (0.90)"), (False, "below confidence (0.00)"), (True, "video confirmed 0.90")]
    required = evaluate(schema, cases[1:2] + cases[6:], verdicts.verdict_confirms(p, required=["c0"]))
    assert [g.why for g in required] == ["failed a required criterion: c0"] * 2


def test_classify_error(evaluate):
    cases = [(429, "x PerDay"), (429, "limit per minute"), (429, "?"), (403, "The VIDEO is private"), (400, "bad field"), (500, "video"), (404, None)]
    assert evaluate("s int, b string", cases, verdicts.classify_error("s", "b")) == [
        "quota_exhausted", "rate_limited", "quota_exhausted", "video_unavailable", "request_rejected", "unreachable", "request_rejected"]


def test_notes_are_one_line_and_cut(evaluate):
    cases = [(" why\nso ", [("a", True, "x\ty"), ("b", None, None)]), ("z" * 2000, [])]
    got = evaluate("r string, c array<struct<criterion:string,matches:boolean,evidence:string>>", cases, verdicts.verdict_notes("r", "c"))
    assert got[0] == "why so [a: yes] x y [b: no]" and got[1] == "z" * 1500
