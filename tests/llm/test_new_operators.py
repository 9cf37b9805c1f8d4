"""Conversation prefix trie, phrase collocations and source mixing against brute force, and on awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest

from siftwork.llm import collocations, mixing, prefix_trie
from siftwork.llm.ranks import numbered

ROOT = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TURNS = "conv_id long, turn long, role string, text string, n_convs string, codes int"


# --- op11

def trie_by_lists(rows):
    own = collections.defaultdict(list)
    for r in rows:
        if r.conv_id is not None:
            own[r.conv_id].append(((r.turn is not None, r.turn or 0), (r.role or "", r.text or "")))
    own = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
    members = collections.defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members[p]) - 1) * len(p[-1][1]) if p else 0
    digest = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return {(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], digest(sorted(c for c in m if len(built[c]) == len(p)))) for p, m in members.items()}


def nodes(df):
    rows = [tuple(r) for r in df.select(*[c.split()[0] for c in prefix_trie.NODE.split(",")]).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("part_bytes,fan", [(prefix_trie.PART_BYTES, 32), (4000, 3), (600, 2)])
def test_trie_matches_lists_however_it_is_cut(spark, monkeypatch, part_bytes, fan):
    monkeypatch.setattr(prefix_trie, "FAN", fan)
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert nodes(prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(turns)), part_bytes)) == trie_by_lists(turns.collect())


def test_trie_of_copies_over_many_parts(spark, monkeypatch):
    """Hundreds of equal conversations, a shared first turn, and prefixes of each other, cut into parts that hold a few rows."""
    monkeypatch.setattr(prefix_trie, "FAN", 4)
    monkeypatch.setattr(prefix_trie, "IDS_A_PIECE", 7)
    rng = random.Random(3)
    rows = [(c, t, "u", f"copy {t}") for c in range(5, 305) for t in range(3)]
    rows += [(c, t, "u", rng.choice("abc") * 5) for c in range(1000, 1200) for t in range(rng.randrange(1, 7))]
    rows += [(c, t, "u", "copy 0" if t == 0 else f"{c} {t}") for c in range(2000, 2060) for t in range(4)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert nodes(prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(turns)), 800)) == trie_by_lists(turns.collect())


def test_trie_of_awkward_rows(spark):
    long = "ä" * 200_000
    rows = [(0, 0, "u", long), (0, None, None, None), (1, 0, "u", ""), (2, 5, "u", "same"), (2, 5, "u", "same"), (7, 3, None, long), (None, 0, "u", "lost"), (5, None, "", ""), (102, 1, "u", "a")]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)
    assert nodes(prefix_trie.digest(turns)) == trie_by_lists(turns.collect())
    assert prefix_trie.digest(turns.limit(0)).collect() == []


# --- op12

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def phrases_by_counting(rows, least, top=2000, absorb=100):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, 6):
                    if i + k <= len(w):
                        f[lang, tuple(w[i:i + k])] += 1
    found = {g: a for g, a in f.items() if a >= least and len(g[1]) > 1}
    inside = {(lang, g[i:i + m]) for (lang, g), a in found.items() for m in range(2, len(g)) for i in range(len(g) - m + 1) if 100 * a >= absorb * f[lang, g[i:i + m]]}
    out = collections.defaultdict(list)
    for (lang, g), a in found.items():
        if (lang, g) not in inside:
            score, k = min((1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g)))
            out[lang].append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    return {(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, v in out.items() for i, (s, a, p, x, y) in enumerate(sorted(v)[:top])}


@pytest.mark.parametrize("least,top,absorb,small", [(100, 2000, 100, False), (3, 2000, 100, True), (4, 30, 60, True)])
def test_collocations_match_counting(spark, monkeypatch, least, top, absorb, small):
    if small:
        monkeypatch.setattr(collocations, "PORTION", 20_000)
        monkeypatch.setattr(collocations, "HELD_WORDS", 5_000)
        monkeypatch.setattr(collocations, "PART_BYTES", 200_000)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("lang", "text")
    rows = [tuple(r) for r in collocations.collocations(docs, least, absorb, top).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == phrases_by_counting([tuple(r) for r in docs.collect()], least, top, absorb)


def test_a_full_filter_changes_no_count(spark, monkeypatch):
    monkeypatch.setattr(collocations, "FILTER_BITS", 32_768)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("lang", "text")
    assert {tuple(r) for r in collocations.collocations(docs, 3).collect()} == phrases_by_counting([tuple(r) for r in docs.collect()], 3)


def test_collocations_of_awkward_rows(spark):
    texts = ["New York city, new york CITY", None, "", " \t ", "a\x01 a a\x00 b", "é É new\x0byork", "x" * 60_000 + " new york", " ".join(f"w{i % 50}" for i in range(9_000)), "ab " * 3_000, "new york."]
    rows = [(lang, t, 1, "p") for t in texts for lang in ("en", None, "two words", "a\nb")] + [("en", texts[0], 1, "p")] * 5
    docs = spark.createDataFrame(rows, "lang string, text string, n int, phrase string")
    got = {tuple(r) for r in collocations.collocations(docs, 2).collect()}
    assert got == phrases_by_counting([r[:2] for r in rows], 2)
    assert collocations.collocations(docs.limit(0)).collect() == []


def test_distinct_chunks_hold_every_place_once(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    twice = docs.union(docs)
    one, two = collocations.dictionary(docs).collect(), collocations.dictionary(twice).collect()
    assert {(r.lang, r.chunk): 2 * r.n for r in one} == {(r.lang, r.chunk): r.n for r in two}
    words = sum((len(r.chunk.split()) - (0 if r.chunk.endswith("\n") else collocations.OVERLAP)) * r.n for r in one)
    assert words == sum(len(re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", r.text or "")) for r in docs.collect())


# --- op13

def targets_by_hand(sizes):
    """sizes: source -> words, in the order of sources."""
    total, order = sum(sizes.values()), sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, capped = {s: i % 3 + 1 for i, s in enumerate(order)}, set()
    while True:
        free = total - sum(3 * sizes[s] for s in capped)
        share = sum(weight[s] for s in order if s not in capped)
        target = {s: 3.0 * sizes[s] if s in capped else free * weight[s] / share for s in order}
        over = {s for s in order if s not in capped and target[s] >= 3 * sizes[s]}
        if not over:
            return target
        capped |= over
        if len(capped) == len(order):
            return {s: 3.0 * sizes[s] for s in order}


def check_mix(rows, text_of):
    sizes, got = collections.Counter(), collections.Counter()
    for r in rows:
        assert r.size == len(WORD.findall(text_of(r) or "")) and 0 <= r.taken <= 3 * r["size"]
        sizes[r.source] += r["size"]
        got[r.source] += r.taken
    want = targets_by_hand(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-6)
        epochs = round(want[r.source]) // max(1, sizes[r.source])
        assert epochs * r["size"] <= r.taken <= (epochs + 1) * r["size"]
    return sizes, got, want


@pytest.mark.parametrize("bin_rows", [mixing.BIN_ROWS, 5])
def test_mix_meets_targets(spark, bin_rows):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = mixing.mix(docs, bin_rows=bin_rows).collect()
    _, got, want = check_mix(rows, lambda r: texts[r.doc_id])
    assert all(abs(got[s] - want[s]) <= 1 for s in want)
    # No more than one document of a source is cut, and it is the next one by its key.
    keys = {r.doc.doc_id: r.key for r in mixing.measured(docs).collect()}
    for s in want:
        mine = sorted((keys[r.doc_id], r) for r in rows if r.source == s and r["size"])
        least = min(r.copies for _, r in mine)
        state = [(r.copies - least, r.tail) for _, r in mine]
        assert state == sorted(state, key=lambda x: (-x[0], -x[1])) and sum(t > 0 for _, t in state) <= 1


def test_mix_of_uneven_sources(spark):
    """A source of a third of all words, tiny ones that stop at three times their words, empty ones and null."""
    rows = [(i, "big", "w " * 50) for i in range(400)] + [(1000 + i, f"s{i:02}", "a b c") for i in range(40)] + [(2000, None, "one two"), (2001, "", "x"), (2002, "void", None)]
    docs = spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id long, source string, text string, taken int, key string")
    got = mixing.mix(docs)
    assert got.columns == ["doc_id", "source", "text", "key", "size", "source_size", "target", "copies", "tail", "taken"]
    _, took, want = check_mix(got.collect(), lambda r: r.text)
    assert all(abs(took[s] - want[s]) <= 1 for s in want)
    words = collections.Counter()
    for r in mixing.expand(got).collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    assert words == collections.Counter({r.doc_id: r.taken for r in got.collect() if r.taken})


def test_mix_of_equal_rows_reruns_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a", "same text here")] * 30 + [(7, "b", "x y")] * 3 + [(8, "c", "z " * 40)], "doc_id long, source string, text string")
    one = sorted(map(str, mixing.digest(docs).collect()))
    assert one == sorted(map(str, mixing.digest(docs.repartition(5)).collect()))
    rows = mixing.digest(docs).collect()
    assert len(rows) == 34 and len({r.taken for r in rows if r.source == "a"}) == 1
    assert mixing.digest(docs.limit(0)).collect() == [] and mixing.mix(docs.limit(0)).collect() == []


def test_quality_moves_documents_forward(spark):
    """Efraimidis-Spirakis: a document of four times the quality is first in four of five draws."""
    from pyspark.sql import functions as F

    keys = spark.range(4000).select(mixing.exponential_key(F.lit(1.0), 1, F.col("id")).alias("a"), mixing.exponential_key(F.lit(0.25), 2, F.col("id")).alias("b"))
    assert abs(keys.filter("a < b").count() / 4000 - 0.8) < 0.03


def test_places_over_parts(spark):
    df = spark.range(1000).selectExpr("id * 7 % 1000 as v")
    from pyspark.sql import functions as F

    assert all(r.v == r.place for r in numbered(df, "place", F.col("v")).collect())
