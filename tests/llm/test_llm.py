"""The operators of the llm subpackage against brute force, and on awkward rows."""

import collections
import functools
import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from siftwork.llm import bpe, components, decontamination, jaccard_join, language_id, main_text, ngram_model, quality_rules, secret_scan, sharding, site_quality
from siftwork.llm.common import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, words int, n string"
EXTRA = ("x", 1, "y")
ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{ROOT}/documents.parquet")


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, clashing columns."""
    long = " ".join(f"word{i % 4000}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, long), (4, long), (None, "a text without an id that is long enough to be kept"), (None, None), (5, "one two"), (6, "one two"), (7, "a\nb\n\na\n b"), (8, "x" * 50_000)]
    return spark.createDataFrame([(i, t, "en" if i != 2 else None, "s" if i != 3 else None, None if t is None else len(t), *EXTRA) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


QUERIES = {
    "op1": lambda d, s: sharding.digest(d),
    "op2": lambda d, s: decontamination.contaminated(d, s.createDataFrame([(1, "one two"), (2, None), (None, "word1 word2 word3 word4 word5 word6 word7 word8 word9")], "item_id long, text string")),
    "op3": lambda d, s: site_quality.site_quality(d, s.createDataFrame([(1, 0), (4, 1), (4, 1), (None, 1), (5, None), (99, 1)], "doc_id long, quality int")),
    "op4": lambda d, s: bpe.digests(d, tokenizer_path()),
    "op5": lambda d, s: language_id.predict(d),
    "op6": lambda d, s: jaccard_join.jaccard_join(d),
    "op7": lambda d, s: secret_scan.scan(d),
    "op9": lambda d, s: ngram_model.score(d),
    "op10": lambda d, s: quality_rules.quality_rules(d),
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_awkward_and_empty_tables(spark, awkward, empty, name):
    n = len(QUERIES[name](awkward, spark).collect())
    assert n == (3 if name == "op2" else 11)  # op2: doc 5 and 6 hold item 1, both rows of doc 4 the item without an id (one pair), nothing else
    assert QUERIES[name](empty, spark).collect() == []


def test_filters_keep_columns(spark, awkward, empty):
    for stage in (quality_rules.keep_good, jaccard_join.keep_first, secret_scan.redact):
        assert stage(awkward).columns == awkward.columns and stage(empty).count() == 0
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert {r.doc_id for r in decontamination.drop_contaminated(awkward, bench).collect()} == {1, 2, 3, 4, 7, 8, None}


def test_sharding(documents, awkward):
    for docs in (documents, awkward):
        rows = sharding.digest(docs).collect()
        slots = collections.defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
        assert len(rows) == docs.count() and all(sorted(v) == list(range(len(v))) for v in slots.values())
        assert all(r.grown_shard in (r.shard, 24) and r.law == "key" for r in rows)
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = sharding.digest(documents).collect()
    assert all(r.size == len((texts[r.doc_id] or "").encode()) + 8 and r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in rows)
    small = sharding.shard(documents, shards=2, bucket_bytes=20_000).collect()
    assert all(sorted(x.slot for x in small if x.shard == k) == list(range(sum(x.shard == k for x in small))) for k in (0, 1))


def test_sharding_writes_whole_shards_in_slots(spark, documents, tmp_path):
    sharding.write_shards(documents, str(tmp_path / "s"), shards=3, bucket_bytes=100_000)
    written = spark.read.parquet(str(tmp_path / "s"))
    rows = written.collect()
    assert sorted((r.doc_id, r.text) for r in rows) == sorted((r.doc_id, r.text) for r in documents.collect())
    assert all(sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows))) for k in range(3))
    # A shuffle, not a sort: neighbours in a shard are not in the order of their ids.
    first = [r.doc_id for r in sorted(rows, key=lambda r: r.slot) if r.shard == 0]
    assert 0.3 < sum(a < b for a, b in zip(first, first[1:])) / len(first) < 0.7


def test_sharding_deals_out_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 7)
    docs = spark.createDataFrame([(1, "same")] * 50 + [(None, None)] * 15 + [(None, "")] * 7 + [(2, "same"), (3, "other")], "doc_id long, text string").repartition(5)
    rows = sharding.digest(docs).collect()
    assert collections.Counter((r.doc_id, r.size) for r in rows) == {(1, 12): 50, (None, 8): 22, (2, 12): 1, (3, 13): 1}
    for k in {r.shard for r in rows}:
        own = [r.slot for r in rows if r.shard == k]
        assert sorted(own) == list(range(len(own)))
    assert sorted(map(tuple, sharding.digest(docs.repartition(3)).collect()), key=str) == sorted(map(tuple, rows), key=str)
    # Copies that a column tells apart are placed one by one.
    copies = spark.range(2000).selectExpr("1L AS doc_id", "'same' AS text", "id AS n")
    spread = sharding.shard(copies, shards=1, bucket_bytes=1200, copy="n")
    assert sorted(r.slot for r in spread.collect()) == list(range(2000))


def test_quality_counts(documents, awkward):
    texts = [*documents.collect(), *awkward.filter("doc_id not in (4, 8)").collect()]
    got = {r.doc_id: r for d in (documents, awkward.filter("doc_id not in (4, 8)").withColumn("doc_id", awkward.doc_id + 10**6)) for r in quality_rules.quality_rules(d).collect()}
    for k, r in enumerate(texts):
        if r.doc_id is None:
            continue
        g = got[r.doc_id + (10**6 if k >= documents.count() else 0)]
        t = r.text or ""
        words = WORD.findall(t)
        at = collections.defaultdict(list)
        for i in range(len(words) - 4):
            at[tuple(words[i:i + 5])].append(i)
        inside = {x for p in at.values() if len(p) > 1 for i in p for x in range(i, i + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside))
        assert g.base_failed == (len(words) < 10 or 100 * len(inside) > 20 * len(words)) and not (g.kept and g.base_failed)


def test_quality_keeps_good_documents(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality_rules.quality_rules(docs).join(labels, "doc_id").filter("not base_failed").collect()
    assert sum(r.kept for r in rows if r.quality == 1) >= 0.99 * sum(r.quality == 1 for r in rows)


def test_quality_rejects_junk(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    caps = docs.limit(1).selectExpr("-1L doc_id", "upper('the rain had stopped and we went on along the river to town') text", "'en' lang", "'src1' source")
    rows = quality_rules.quality_rules(docs.select("doc_id", "text", "lang", "source").union(caps)).join(labels.union(spark.createDataFrame([(-1, 0, 0)], labels.schema)), "doc_id").filter("not base_failed").collect()
    junk = [r for r in rows if r.quality == 0]
    assert len(junk) > 20 and sum(not r.kept for r in junk) >= 0.95 * len(junk) and not any(r.kept for r in junk if r.doc_id == -1)
    assert sum(r.kept for r in rows if r.quality == 1) >= 0.99 * sum(r.quality == 1 for r in rows)


def _links(texts):
    sets = {}
    for k, t in texts.items():
        w = WORD.findall(t or "")
        sets[k] = frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    links = collections.defaultdict(set)
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a != b and common and 10 * common >= 8 * (len(sets[a]) + len(sets[b]) - common):
                links[a].add(b)
    return links


@pytest.mark.parametrize("bucket,in_memory", [(400, 40_000), (4, 40_000), (4, 6)])
def test_jaccard_join_finds_every_link(spark, monkeypatch, bucket, in_memory):
    monkeypatch.setattr(jaccard_join, "BUCKET", bucket)
    monkeypatch.setattr(jaccard_join, "IN_MEMORY", in_memory)
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    texts = {}
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(120)]
        for _ in range(8):
            w = list(base)
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = f"r{rng.random()}"
            texts[len(texts)] = " ".join(w + (passage if g % 2 else []))
    texts |= {len(texts): "tiny text", len(texts) + 1: "tiny text", len(texts) + 2: None}
    rows = {r.doc_id: r for r in jaccard_join.jaccard_join(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    links = _links(texts)
    assert {k: r.n_links for k, r in rows.items()} == {k: len(links[k]) for k in texts}
    for a, own in links.items():
        assert all(rows[a].class_id == rows[b].class_id for b in own)


def test_components(rows):
    edges = rows("u long, v long", *[(i, i + 1) for i in range(60)], (100, 101), (103, 101))
    got = {r.id: r.root for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 103: 100}


def test_decontamination(rows, documents, spark):
    item = "Alice had 12 apples and gave 5 kg of them to Bob before the market closed at 9 that day"
    other = "so we learn that Carol had 30 apples and gave 7 kg of them to Dan before the market closed at 8 that day again"
    mixed = "numbers: Alice had 12 apples and gave 5 kg of them to Bob"
    bench = rows("item_id long, text string", (1, item.replace("Alice", "then Alice")), (2, "short one"))
    docs = rows("doc_id long, text string", (1, "x y " + item.replace("Alice", "then Alice")), (2, other.replace("that Carol", "then Carol")), (3, "nothing of the kind is told here at all"), (4, "1 2 3 4 5 6 7 8 9 10 11 12"), (5, "short one"), (6, mixed))
    got = {(r.doc_id, r.item_id): r.kind for r in decontamination.contaminated(docs, bench).collect()}
    assert got.pop((1, 1)) == "exact" and got.pop((2, 1)) == "reparameterised" and got.pop((5, 2)) == "exact" and not {k for k in got if k[0] in (3, 4)}
    items = spark.read.parquet(f"{ROOT}/benchmark.parquet").collect()
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(documents, spark.read.parquet(f"{ROOT}/benchmark.parquet")).collect()}
    assert {(d.doc_id, i.item_id) for d in documents.collect() for i in items if d.text and i.text in d.text} <= found


def test_decontamination_finds_names_that_open_sentences(rows):
    item = "Alice has 5 apples. Bob takes 2 of them. How many apples remain now?"
    other = "Carol has 9 apples. Dan takes 4 of them. How many apples remain now?"
    docs = rows("doc_id long, text string", (1, other), (2, f"Some text.\n{other} And more."), (3, item), (4, "so we ask: then " + other), (5, other.replace("Dan", "Eve").replace("remain", "rot")), (6, "Carol has no pears. Dan takes none of them. How many people remain now?"))
    got = {r.doc_id: r.kind for r in decontamination.contaminated(docs, rows("item_id long, text string", (1, item))).collect()}
    assert got.pop(3) == "exact" and got == dict.fromkeys([1, 2, 4, 5], "reparameterised")


def test_decontamination_finds_copies_of_any_words(rows):
    items = {1: "What is the boiling point?", 2: "12 kg 7 cm 9 Bob 4 days 30 km 8", 3: "Paris is the largest city of old France"}
    texts = {1: f"He asks: {items[1]} Nobody in the room knew it at that hour", 2: f"we read {items[2]} and then it went on", 3: f"as we know, {items[3]} by far and more", 4: "12 kg 7 cm 9 Dan 5 days 31 km 9 10 11 12", 5: "what is the melting point of this and what is the boiling heat"}
    found = decontamination.contaminated(rows("doc_id long, text string", *texts.items()), rows("item_id long, text string", *items.items())).collect()
    assert {(r.doc_id, r.item_id, r.kind) for r in found} == {(k, k, "exact") for k in items}
    assert all(r.n_found == r.n_runs for r in found)


def test_bpe_equals_the_library(documents, awkward, spark):
    path = tokenizer_path()
    library = Tokenizer.from_file(path)
    rng = random.Random(7)
    pool = "abc dé \t\n\r\x0b\x1c\x85\xa0'sdmltreve09½²٣一𝄞🙂​　 ª.,!?#<|>"
    made = ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(300)] + ["<|endoftext|>a<|endoftext|>", "'s's 'll", "aaaaaaaaaaaa", "\U00010940x"]
    coder = bpe.Coder(bpe.Vocabulary.read(path))
    for t in made:
        ids, counts = coder.encode([t])
        want = library.encode(t, add_special_tokens=False).ids
        assert ids.tolist() == want and coder.decode(ids, counts)[0] == library.decode(want, skip_special_tokens=False)
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    for r in bpe.digests(documents, path).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    both = bpe.decode(bpe.encode(awkward, path), path).collect()
    assert all(r.decoded == (r.text or "") for r in both)


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.predict(docs).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_suffix_automaton_counts_greedy_phrases():
    rng = random.Random(2)
    for _ in range(200):
        ref, text = ("".join(rng.choice("abc") for _ in range(rng.randrange(1, 25))) for _ in range(2))
        n = i = 0
        while i < len(text):
            k = 1
            while i + k < len(text) + 1 and text[i:i + k] in ref:
                k += 1
            i += max(1, k - 1)
            n += 1
        assert language_id.SuffixAutomaton(ref).phrases(text) == n


def test_secret_spans(rows, documents):
    key = "AKIA" + "ABCD1234" * 2
    text = f"é token = \"abcdef123\" password: x {key} {'0a' * 14} Secret: token: abcdefgh {'Zk9' + 'q7Xw2Lp0Vb8Rt5Yn1M'} ordinary_identifier_name_here"
    r = secret_scan.scan(documents.select("doc_id", "text").union(rows("doc_id long, text string", (-1, text)))).filter("doc_id = -1").first()
    assert (r.n_assign, r.n_access, r.n_hex) == (1, 1, 1)
    base = [x for x in r.spans.split(",") if not x.startswith("markov")]
    assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
    caught = {k: text[int(a):int(b)] for k, a, b in (x.split(":") for x in r.spans.split(","))}
    assert caught["assign"] == 'token = "abcdef123' and caught["access"] == key and caught["hex"] == "0a" * 14 and caught["markov"].startswith("Zk9q7")
    assert "ordinary_identifier" not in "".join(caught.values())
    masked = secret_scan.redact(rows("doc_id long, text string, n_chars long", (1, text, 5), (2, "clean", 5))).orderBy("doc_id").collect()
    assert key not in masked[0].text and 'token = "[SECRET]"' in masked[0].text and masked[0].n_chars == len(masked[0].text) and masked[1].text == "clean"


def test_main_text(spark, rows):
    pages = spark.read.parquet(f"{ROOT}/pages.parquet")
    page = ('<html><head><title>T</title></head><body><div class="cookie-notice">We use cookies</div><nav><ul><li><a>Home</a></li></ul></nav><div>stray box</div><article><h1>A  title&amp;</h1>'
            '<p>One two three four five six.<br>seven</p><div class="ad">Buy now</div><ul><li>item a b c</li><li>item d e f</li></ul><p>Last words here.</p></article>'
            '<section id="comments"><p>First! great post</p></section><aside>Side</aside><form><p>name</p></form><footer>foot</footer>')
    weights = main_text.train(pages)
    assert main_text.extract(page, weights) == "A title&\nOne two three four five six. seven\nitem a b c\nitem d e f\nLast words here."
    odd = rows("page_id long, url string, html string", (1, "u", None), (None, None, ""), (3, "u", "<p>un<b>closed & text &lt;x"), (3, "u", "<script>var a='</p>'"))
    got = [(r.page_id, r.n_chars) for r in main_text.main_text(odd).collect()]
    assert sorted(got, key=str) == sorted([(1, 0), (None, 0), (3, len("unclosed & text <x")), (3, 0)], key=str)
    assert main_text.main_text(odd.limit(0)).collect() == []


@pytest.mark.parametrize("order", [2, 3, 4])
def test_ngram_model(spark, order):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    low = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})
    tokens = {r.doc_id: [*WORD.findall((r.text or "").translate(low)), "</s>"] for r in docs.collect()}

    def grams(t):
        marked = ["<s>"] * (order - 1) + t
        return [tuple(marked[k:k + order]) for k in range(len(t))]

    c, value = collections.Counter(), {k: collections.Counter() for k in range(1, order + 1)}
    raw = {k: collections.Counter() for k in range(1, order + 1)}
    for key, t in tokens.items():
        if zlib.crc32(str(key).encode()) % 10:
            c.update(t)
            for k in raw:
                raw[k].update(g[-k:] for g in grams(t))
    n, v = sum(c.values()), len(c)
    value[order] = raw[order]
    for k in range(order - 1, 0, -1):
        behind = collections.Counter(g[1:] for g in value[k + 1])
        value[k] = collections.Counter({g: raw[k][g] if g[0] == "<s>" else m for g, m in behind.items()})
    total, kinds, d = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0]), {}
    for k in value:
        seen = collections.Counter(value[k].values())
        d[k] = (0, *ngram_model.discounts(*(seen[j] for j in (1, 2, 3, 4))))
        for g, m in value[k].items():
            total[g[:-1]] += m
            kinds[g[:-1]][min(m, 3) - 1] += 1

    @functools.cache
    def p(g):
        if not g:
            return 1 / (v + 1)
        if not total[g[:-1]]:
            return p(g[1:])
        m, own = value[len(g)][g], d[len(g)]
        return max(m - own[min(m, 3)], 0) / total[g[:-1]] + sum(x * y for x, y in zip(own[1:], kinds[g[:-1]])) / total[g[:-1]] * p(g[1:])

    for r in ngram_model.score(docs, order).collect():
        t = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), rel=1e-9)
        assert r.score == pytest.approx(sum(math.log10(p(g)) for g in grams(t)), rel=1e-5)


def test_mapped_arrays_hold_no_open_files(tmp_path):
    made = []
    for k in range(50):
        np.save(tmp_path / f"{k}.npy", np.arange(k, dtype=np.uint64))
        made.append(ngram_model.mapped(str(tmp_path / f"{k}.npy")))
    assert all(list(a) == list(range(k)) for k, a in enumerate(made))
    assert not [f for f in os.listdir("/proc/self/fd") if os.path.realpath(f"/proc/self/fd/{f}").startswith(str(tmp_path))]


def test_site_quality_finds_bad_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = site_quality.site_quality(docs, labels).join(labels, "doc_id").collect()
    assert sum(r.kept for r in rows if r.quality) >= 0.97 * sum(r.quality for r in rows)
    assert sum(not r.kept for r in rows if not r.quality) >= 0.8 * sum(not r.quality for r in rows)


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, ROOT).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()}
    assert 0.5 * len(docs) < len(rows) <= len(docs) and len({r.doc_id for r in rows}) == len(rows)
    library = Tokenizer.from_file(tokenizer_path())
    assert all(r.token_ids == library.encode(r.text, add_special_tokens=False).ids and r.n_tokens == len(r.token_ids) for r in rows[:50])
    assert all(r.text == docs[r.doc_id].text or "[SECRET]" in r.text for r in rows)
