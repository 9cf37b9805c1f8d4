"""Cases that earlier rounds got wrong."""

import hashlib
import random
import re
import tracemalloc

import pytest
from tokenizers import Tokenizer

from siftwork.llm import bpe, common, language_id, main_text, quality_rules, secret_scan, site_quality


def test_keep_good_leaves_columns_of_any_name_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("doc_id", "text", "lang", "source", "cast(7 as int) as n_words", "'far' as distance", "'x' as kept", "'y' as doc")
    kept = quality_rules.keep_good(docs)
    assert kept.dtypes == docs.dtypes
    plain = {r.doc_id for r in quality_rules.quality_rules(docs).collect() if r.kept}
    rows = kept.collect()
    assert {r.doc_id for r in rows} == plain and len(plain) > 500
    assert all((r.n_words, r.distance, r.kept, r.doc) == (7, "far", "x", "y") for r in rows)


def test_letters_decide_whether_a_text_has_a_language(spark):
    hindi, thai, plain = "यह एक हिन्दी वाक्य है जिसमें मात्राएँ हैं", "ภาษาไทยมีสระและวรรณยุกต์กำกับอยู่", "this is plain writing with the usual words"
    data = [(k, text, lang) for k in range(40) for text, lang in ((f"{hindi} {'क' * (k % 7)}", "hi"), (f"{thai}{'ก' * (k % 7)}", "th"), (f"{plain} {'a' * (k % 7)}", "en"))]
    rows = [(i, text, lang) for i, (_, text, lang) in enumerate(data)]
    extra = [(1000 + i, text, None) for i, text in enumerate(["½ ² ①", "12 %", "", None, "हिन्दी में", "ภาษาไทย", "the usual words ½"])]
    got = {r.doc_id: r for r in language_id.predict(spark.createDataFrame(rows + extra, "doc_id long, text string, lang string")).collect()}
    assert [got[1000 + i].lang_pred for i in range(7)] == ["und", "und", "und", "und", "hi", "th", "en"] and got[1000].score == 0
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert language_id.words("Ab हिन्दी c½d ภาษาไทย") == ["ab", "हिन्दी", "c", "d", "ภาษาไทย"]


def test_no_language_is_lost_and_copies_teach_once(spark):
    rows = [(i, "xx yy zz " * 400, "aa") for i in range(300)] + [(1000 + i, f"q{chr(97 + i % 26)}w rare words of zz {i}", "zz") for i in range(30)] + [(2000, "½", "none")]
    learned = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(learned) == {"aa", "zz"} and len(learned["aa"]) <= language_id.CHARS + 2 and learned["zz"].count("rare") > 15


def test_all_texts_in_step_count_what_each_alone_does():
    rng = random.Random(4)
    judge = language_id.Judge({x: language_id.reference(["".join(rng.choice(alphabet) for _ in range(900))]) for x, alphabet in (("a", "abc  "), ("b", "bcdé "), ("c", "".join(chr(0x4E00 + k) for k in range(90)) + " "))})
    for n in (0, 1, 23, 24, 120):
        texts = ["".join(rng.choice("abcdé ß" + chr(0x4E00) + chr(0x4E50)) for _ in range(rng.randrange(60))) for _ in range(n)]
        assert judge.phrases(texts).tolist() == [[a.phrases(t) for t in texts] for a in judge.automata]


def page(inner, before="", after=""):
    return f"<html><head><title>t</title></head><body>{before}{inner}{after}</body></html>"


@pytest.fixture(scope="module")
def weights(spark):
    return main_text.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_articles_come_back_whole(weights):
    figure = "<article><h1>T</h1><p>Short one.</p><figure><img><figcaption><a>c</a></figcaption></figure><p>Second here.</p></article>"
    assert main_text.extract(page(figure), weights) == "T\nShort one.\nc\nSecond here."
    table = "<table>" + "".join(f"<tr><td>{i}</td><td>v{i}</td></tr>" for i in range(60)) + "</table>"
    got = main_text.extract(page(f"<article><p>Before it all.</p>{table}<pre><code>x = 1</code></pre><ul><li>one</li></ul><p>After.</p></article>", "<nav><a>Home</a></nav>", "<footer>f</footer>"), weights).split("\n")
    assert got[0] == "Before it all." and got[-3:] == ["x = 1", "one", "After."] and len(got) == 124
    for name in ("discussion", "related-work", "side-effects", "share-price", "search-methods", "alert-levels", "tags", "notice-period"):
        assert main_text.extract(page(f'<article><p>One two.</p><section id="{name}"><h2>Head</h2><p>Three four five.</p></section><p class="{name}">Six.</p><p>End.</p></article>'), weights) == "One two.\nHead\nThree four five.\nSix.\nEnd."


def test_what_is_no_article_goes(weights):
    noise = ('<div class="ad-slot">Buy</div>', '<section class="comments"><p>First! a long comment of many words</p></section>', '<div class="share"><a>Post</a> <a>Mail</a></div>', '<ul class="tags"><li><a>x</a><ul><li><a>y</a></li></ul></li></ul>',
             '<div id="cookie_notice">We use them</div>', '<div class="search">Find <input> <button>Go</button></div>', '<p hidden>no</p>', '<div class="reader-comments">Nice</div>', '<form><label>Mail</label></form>', "<aside>Side</aside>")
    for x in noise:
        assert main_text.extract(page(f"<article><h1>T</h1><p>One two three.</p>{x}<p>Last words.</p></article>", x, x), weights) == "T\nOne two three.\nLast words.", x


def test_pages_without_an_article(weights):
    body = "<div class='story'><h1>Head</h1><p>Some words that make up the first part of it.</p><div class='fig'><table><tr><td>1</td></tr></table></div><p>More of the words.</p></div>"
    got = main_text.extract(page(f"<div id='page'><div class='top'><a>Home</a> <a>About</a></div>{body}<ul class='links'><li><a>a</a></li></ul></div>"), weights)
    assert got == "Head\nSome words that make up the first part of it.\n1\nMore of the words."
    assert main_text.extract("<main><h1>A</h1><p>b c d</p></main><p>x</p>", weights) == "A\nb c d" and main_text.extract("plain words", {}) == "plain words" and main_text.extract("", weights) == ""


def test_best_run_is_the_maximum():
    rng = random.Random(9)
    for _ in range(300):
        scored = [(rng.choice([0.5, 1.0, 3.0]), k) if rng.random() < 0.5 else (-rng.choice([0.5, 1.0, 4.0]), None) for k in range(rng.randrange(14))]
        start, end = main_text.best_run(scored)
        best = max((sum(x for x, _ in scored[i:j]) for i in range(len(scored)) for j in range(i + 1, len(scored) + 1)), default=0)
        if best <= 0:
            assert end == -1
        else:
            assert sum(x for x, _ in scored[start:end + 1]) == best


def test_awkward_pages(spark):
    long = "<div>" * 3000 + "<p>deep words</p>" + "<article><p>" + "word " * 50_000 + "</article>"
    rows = [(1, "u", long, "t", 5), (1, "u", long, "t", 5), (2, None, None, None, None), (None, "u", "", "t", 1), (None, "u", "<p>a b", "t", 1), (3, "v", "</div></article></p><a></b></a><li class=share>x<li>y", "t", 1)]
    got = main_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text[:4], r.n_chars) for r in got) == sorted([(1, "u", "word", 249_999), (1, "u", "word", 249_999), (2, "", "", 0), (0, "u", "", 0), (0, "u", "a b", 3), (3, "v", "x\ny", 3)])


BASE = [("assign", re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A), 2, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)]


def test_base_spans_of_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    found = 0
    for r in secret_scan.scan(docs).collect():
        spans = sorted((m.start(), k, m.end()) for k, (_, pattern, group, least) in enumerate(BASE) for m in pattern.finditer(texts[r.doc_id]) if len(m.group(group)) >= least)
        found += len(spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[1] == k for x in spans) for k in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(f"{BASE[k][0]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
    assert found > 5


def test_random_parts_beside_ordinary_ones_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    key, access = "Zk9q7Xw2Lp0Vb8Rt5Yn1MfG6Hs3Jd4Qc", "AKIA" + "ABCD1234" * 2
    texts = [f"{access}/{key}", f"long_setting_name={key}", f"/usr/share/readable/names/{key}/more_of_the_path_names", f"{key}-ordinary_words_in_a_name-{key[::-1]}", "an_ordinary_name_of_many_words/and_a_path_of_others", None]
    rows = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: [x.split(":") for x in r.spans.split(",") if x.startswith("markov")] for r in secret_scan.scan(docs.union(rows)).filter("doc_id < 0").collect()}
    caught = [[(texts[i] or "")[int(a):int(b)] for _, a, b in got[-1 - i]] for i in range(6)]
    assert caught == [[key], [key], [key], [key, key[::-1]], [], []]


def test_redaction_passes_columns_of_any_name(spark):
    secret = "token = abcdef123"
    rows = spark.createDataFrame([(1, secret, 17, "a", 1, "r"), (1, secret, 17, "a", 1, "r"), (2, "clean", 3, "b", 2, None), (None, None, None, None, None, None)], "doc_id long, TEXT string, N_CHARS int, __text string, masked int, row string")
    done = secret_scan.redact(rows)
    assert done.dtypes == rows.dtypes
    out = "token = [SECRET]"
    assert sorted(map(tuple, done.collect()), key=str) == sorted([(1, out, len(out), "a", 1, "r")] * 2 + [(2, "clean", 3, "b", 2, None), (None,) * 6], key=str)


def test_best_stretch_is_the_maximum():
    rng = random.Random(5)
    for _ in range(300):
        x = [rng.choice([-3, -1, 1, 2]) for _ in range(rng.randrange(1, 14))]
        best, s, e = secret_scan.best_stretch(x)
        assert best == max(0, max(sum(x[i:j]) for i in range(len(x)) for j in range(i + 1, len(x) + 1))) == sum(x[s:e])


def test_site_quality_on_labels_it_was_not_given(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    half = labels.filter("crc32(cast(doc_id as string)) % 2 = 0")
    rest = site_quality.site_quality(docs, half).join(labels.join(half, "doc_id", "left_anti"), "doc_id").collect()
    good, bad = [r for r in rest if r.quality], [r for r in rest if not r.quality]
    assert len(good) > 50 and len(bad) > 10 and sum(r.kept for r in good) >= 0.95 * len(good) and sum(not r.kept for r in bad) >= 0.8 * len(bad)


def test_samples_follow_one_rule_at_every_size(spark):
    rows = spark.range(20_000).selectExpr("cast(null as long) as id", "concat('t', id % 5000) as text")
    taken = common.sampled(rows, 2_000).collect()
    assert 350 < len(taken) < 650 and len(set(taken)) == len(taken)
    assert common.sampled(rows.limit(50), 2_000).count() == rows.limit(50).distinct().count()


def test_a_batch_of_texts_is_not_held_in_pieces(spark):
    coder = bpe.Coder(bpe.Vocabulary.read(common.tokenizer_path()))
    texts = [" ".join(f"w{i % 50}" for i in range(400)) for _ in range(300)]
    coder.encode(texts[:1])
    tracemalloc.start()
    ids, counts = coder.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(counts) == 300 and peak < 70 * len(ids)  # a piece as a string of its own takes 50 bytes besides
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    coded = bpe.with_tokens(docs, common.tokenizer_path())
    assert coded._jdf.queryExecution().optimizedPlan().toString().count("coalesce(text") == 0  # the text goes to the workers once
    assert [(r.doc_id, r.text, r.n_tokens) for r in coded.orderBy("doc_id").collect()] == [(1, "a b", 2), (2, None, 0)]


def test_forgotten_pieces_and_special_tokens_get_the_same_ids(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 6)
    path = common.tokenizer_path()
    library, coder = Tokenizer.from_file(path), bpe.Coder(bpe.Vocabulary.read(path))
    for texts in (["ab <|endoftext|>cde x", "", "cde cde"], ["<|endoftext|>", "new words come <|endoftext|> here"], [], ["ab x", "words of old"], ["ab <|endoftext|>cde x"]):
        ids, counts = coder.encode(texts)
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
