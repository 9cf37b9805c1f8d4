"""Phrase collocation mining over a prefix-free parse of the corpus.

Texts are cut into chunks where four words in a row hash to a trigger, so equal passages are cut alike wherever they stand. A chunk
ends behind its trigger and the next one begins with the trigger's words: neighbours overlap by four words, and every phrase of up
to five words lies whole in the chunk in which it starts. Distinct chunks with their frequencies are the dictionary.
Phrases are counted inside distinct chunks, weighted by frequency; those that start in the overlap belong to the next
chunk only. A document's last chunk has no such overlap, and is told apart by the line end behind it.

Counting sorts: each word of a chunk gives the window of up to five words that it opens, windows are dealt by ranges and sorted, and
the frequency of every phrase is the sum over the run of windows that begin with it. Frequent windows and hot first words
spread over parts, since a range may end anywhere; the runs at the ends of a part are summed once more across parts.

A phrase is no more frequent than any word or pair in it, so words and pairs are counted before, as hashes, and a window ends where
the next pair is rare. The frequent ones are known to tasks as a bitmap of ``FILTER_BITS`` bits, whatever the size of the corpus:
the more of it is taken, the more rare pairs pass, which costs time but changes no count.

A null text has no words; a null lang is ``und``. Repeated rows count each. Other columns are not used. An empty table has no
phrase. Text is compared as it is but for A-Z in lower case; blanks in a phrase are single spaces.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged
from .words import hash_words, mix, portions

#: Words of a phrase, at most.
LONGEST = 5
OVERLAP = LONGEST - 1
#: One of so many places is a trigger.
EVERY = 32
LEAST_FREQUENCY = 100
#: A phrase goes if a longer candidate around it has so many percent of its frequency.
ABSORB_PERCENT = 100
TOP = 2000
#: Parts of a language's candidates that are cut to TOP before they meet.
SALTS = 64
#: Bytes of text of the windows sorted in one part, and of the texts worked on at once.
PART_BYTES = 64 << 20
PORTION = 2 << 20
#: Words whose hashes are summed in a task before they leave it.
HELD_WORDS = 2_000_000
FILTER_BITS = 1 << 27
BITMAP_BITS = 32_768  # of Spark's bitmap functions
BLANK, END = 0x20, 0x0A

#: What each byte becomes: A-Z in lower case, tabs as spaces, all that ends a piece as a line end.
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[ord("A"):ord("Z") + 1] += 32
_BYTES[0x09] = BLANK
_BYTES[[*b".,;:!?", *range(0x0A, 0x0E)]] = END


class _Words:
    """The words of some texts: ``text`` holds each followed by one byte, a blank inside a piece and a line end behind it."""

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        raw = _BYTES[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
        solid = (raw != BLANK) & (raw != END)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8)))
        first, behind = edges[::2], edges[1::2]
        self.n = len(first)
        pieces = np.cumsum(raw == END, dtype=np.int32)
        #: Whether the word is the last of its piece, and the text it is in.
        self.last = np.ones(self.n, bool)
        self.last[:-1] = pieces[first[1:]] != pieces[first[:-1]]
        self.owner = np.searchsorted(np.cumsum(sizes), first, "right")
        lengths = behind - first
        self.ends = np.cumsum(lengths + 1)
        self.starts = self.ends - lengths - 1
        self.text = np.full(int(self.ends[-1]) if self.n else 0, BLANK, np.uint8)
        self.text[_places(self.starts, lengths)] = raw[solid]
        self.text[self.ends[self.last] - 1] = END
        self.lengths = lengths

    def hashes(self) -> np.ndarray:
        """A hash of each word, equal in every process."""
        solid = np.concatenate([[0], np.cumsum(self.lengths)])
        data = self.text[_places(self.starts, self.lengths)]
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), self.n, [None, pa.py_buffer(solid), pa.py_buffer(data)]).dictionary_encode()
        return hash_words(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all ranges, one after the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))


def _ends(groups: np.ndarray) -> np.ndarray:
    """Whether a place is the last of its group."""
    return np.concatenate([groups[1:] != groups[:-1], [True]])


def _nth_group(ends: np.ndarray) -> np.ndarray:
    """The number of each place's group, from where groups end."""
    return np.concatenate([[0], np.cumsum(ends[:-1])]).astype(np.int64)


def _ranges(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """These ranges of ``text`` as an array of strings."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(text[_places(starts, ends - starts)]))


def _summed(by: dict[str, pa.Array], n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Equal rows once, with their sum n."""
    got = pa.table({**by, "n": n}).group_by(list(by)).aggregate([("n", "sum")])
    out = pa.table({**{c: got[c].cast(pa.string()) if pa.types.is_large_string(got[c].type) else got[c] for c in by}, "n": got["n_sum"]})
    yield from out.to_batches(20_000)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, chunk, n) of the texts, summed for each portion."""
    for batch in batches:
        for a, b in portions(batch["text"], PORTION):
            langs, texts = batch["lang"].slice(a, b - a), batch["text"].slice(a, b - a).cast(pa.binary()).to_pylist()
            w = _Words(texts)
            if not w.n:
                continue
            h = w.hashes() + w.last.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            rolled = np.zeros(w.n, np.uint64)
            if w.n >= OVERLAP:
                with np.errstate(over="ignore"):
                    for k in range(OVERLAP):
                        rolled[OVERLAP - 1:] = mix(rolled[OVERLAP - 1:] + h[k: w.n - OVERLAP + 1 + k] + np.uint64(k + 1))
            final = _ends(w.owner)
            nth = np.arange(w.n) - np.concatenate([[0], np.flatnonzero(final)[:-1] + 1])[_nth_group(final)]
            # The text goes on behind a trigger, and the words of a trigger are all in it, behind its first word.
            trigger = (rolled % np.uint64(EVERY) == 0) & (nth >= OVERLAP) & ~final
            stop = np.flatnonzero(trigger | final)
            start = np.zeros(len(stop), np.int64)
            start[1:] = np.where(final[stop[:-1]], stop[:-1] + 1, stop[:-1] - OVERLAP + 1)
            chunks = _ranges(w.text, w.starts[start], w.ends[stop] - np.where(final[stop], 0, 1))
            yield from _summed({"lang": langs.take(pa.array(w.owner[start])), "chunk": chunks}, np.ones(len(stop), np.int64))


class _Owned:
    """The words of some chunks that are counted there, with the last place their windows may reach."""

    def __init__(self, rows: pa.RecordBatch):
        chunks = rows["chunk"].cast(pa.binary()).to_pylist()
        self.words = w = _Words(chunks)
        complete = np.fromiter((c.endswith(b"\n") for c in chunks), bool, len(chunks))
        final = _ends(w.owner)
        left = np.flatnonzero(final)[_nth_group(final)] - np.arange(w.n)
        self.at = np.flatnonzero(complete[w.owner] | (left >= OVERLAP))
        self.piece_end = np.flatnonzero(w.last)[_nth_group(w.last)]
        self.n = rows["n"].to_numpy()[w.owner[self.at]]
        langs = hash_words(rows["lang"].to_pylist(), 1)
        with np.errstate(over="ignore"):
            h = w.hashes() if w.n else np.zeros(0, np.uint64)
            #: Hashes of each word, and of each word with the next one of its piece, in its language.
            self.word = mix(h + langs[w.owner])
            self.pair = np.zeros(w.n, np.uint64)
            self.pair[:-1] = mix(self.word[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
        self.has_next = self.piece_end > np.arange(w.n)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in portions(batch["chunk"], PORTION):
            yield batch.slice(a, b - a)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, n): how often each hash of a word or pair occurs."""
    hashes, counts, held = [], [], 0

    def out() -> Iterator[pa.RecordBatch]:
        return _summed({"h": pa.array(np.concatenate(hashes).view(np.int64))}, np.concatenate(counts))

    for rows in _small(batches):
        o = _Owned(rows)
        pairs = o.has_next[o.at]
        hashes += [o.word[o.at], o.pair[o.at[pairs]]]
        counts += [o.n, o.n[pairs]]
        held += len(o.at)
        if held >= HELD_WORDS:
            yield from out()
            hashes, counts, held = [], [], 0
    if held:
        yield from out()


def _frequent_bits(chunks: DataFrame, least: int) -> np.ndarray:
    """A bitmap over the hashes of all words and pairs that occur ``least`` times, FILTER_BITS / 8 bytes."""
    counted = chunks.mapInArrow(_hashes, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    place = F.pmod("h", F.lit(FILTER_BITS)) + 1
    maps = counted.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    size = BITMAP_BITS // 8
    for r in maps.toLocalIterator():  # FILTER_BITS / BITMAP_BITS rows at most
        bits[(r.bucket - 1) * size: r.bucket * size] = np.frombuffer(r.bits, np.uint8)
    return bits


def _windows(bits) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(window, n): language, line end, and words with a blank behind each, for every word of the chunks.

    The words go on as long as their pairs may be frequent; there is none for a rare word.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bits.value
        frequent = lambda h: (known[(h & np.uint64(FILTER_BITS - 1)) >> np.uint64(3)] >> (h & np.uint64(7)).astype(np.uint8)) & 1 == 1
        for rows in _small(batches):
            o = _Owned(rows)
            w = o.words
            if not w.n:
                continue
            goes_on = frequent(o.pair) & o.has_next
            # The first place at or behind each one where a window must end.
            stop = np.flatnonzero(~goes_on)[_nth_group(~goes_on)]
            to = np.minimum(o.at + LONGEST - 1, stop[o.at])
            ends = np.where(frequent(o.word[o.at]), w.ends[to], w.starts[o.at])
            w.text[w.text == END] = BLANK
            langs = rows["lang"].take(pa.array(w.owner[o.at])).cast(pa.large_string())
            yield from _summed({"window": pc.binary_join_element_wise(langs, _ranges(w.text, w.starts[o.at], ends), pa.scalar("\n", pa.large_string()))}, o.n)

    return windows


def _marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For every window, where its language and its first, second, ... word end; -1 where there are fewer."""
    lines, blanks = np.flatnonzero(data == END), np.flatnonzero(data == BLANK)
    line = lines[np.searchsorted(lines, ends) - 1]
    first = np.searchsorted(blanks, line)
    out = np.full((len(starts), LONGEST + 1), -1, np.int64)
    out[:, 0] = line + 1
    blanks = np.append(blanks, len(data))
    for k in range(LONGEST):
        at = blanks[np.minimum(first + k, len(blanks) - 1)]
        out[:, k + 1] = np.where(at < ends, at + 1, -1)
    return out


def _prefix_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Running sums over the bytes, each times a number that its place in the window draws; differences are hashes of prefixes."""
    drawn = np.random.default_rng(5).integers(0, 1 << 64, int(lengths.max()), np.uint64, endpoint=False) | np.uint64(1)
    at = np.arange(len(data)) - np.repeat(starts, lengths)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * drawn[at], out=out[1:])
    return out


class _Runs:
    """Sums over runs of sorted windows that begin with the same ``k`` words. k = 0 stands for the language."""

    def __init__(self, k: int, least: int, out: list[tuple]):
        self.k, self.least, self.out = k, least, out
        self.gram, self.n, self.at_edge = None, 0, False

    def close(self, at_edge: bool = False) -> None:
        """Frequent runs count, and those at an end of the part, which may go on in another one."""
        if self.gram is not None and (self.k == 0 or self.n >= self.least or self.at_edge or at_edge):
            self.out.append((self.gram, self.k, self.n))
        self.gram = None

    def add(self, raw: bytes, n: np.ndarray, starts: np.ndarray, marks: np.ndarray, same: np.ndarray, opening: bool) -> None:
        """A batch of windows; ``same`` says which begin like the one before. Python sees the frequent runs and the two outer ones."""
        firsts = np.concatenate([[0], np.flatnonzero(~same) + 1])
        totals, there = np.add.reduceat(n, firsts), marks[firsts] >= 0
        keep = there & ((totals >= self.least) | (self.k == 0))
        keep[[0, -1]] = there[[0, -1]]
        if not there[0]:
            self.close()
        for r in np.flatnonzero(keep).tolist():
            gram, total = raw[starts[firsts[r]]: marks[firsts[r]]], int(totals[r])
            if r == 0 and gram == self.gram:
                self.n += total
                continue
            self.close()
            self.gram, self.n, self.at_edge = gram, total, opening and r == 0
        if not there[-1]:
            self.close()


def _counted(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(gram, k, n) from a sorted part: phrases with ``least`` occurrences in it, and the runs at its ends whatever their sum."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        runs = [_Runs(k, least, out) for k in range(LONGEST + 1)]
        opening = True
        for b in batches:
            if not b.num_rows:
                continue
            windows, n = b["window"].cast(pa.large_binary()), b["n"].to_numpy()
            bounds = np.frombuffer(windows.buffers()[1], np.int64)[windows.offset: windows.offset + len(windows) + 1]
            data = np.frombuffer(windows.buffers()[2], np.uint8)[bounds[0]: bounds[-1]]
            starts, ends = bounds[:-1] - bounds[0], bounds[1:] - bounds[0]
            marks, sums, raw = _marks(data, starts, ends), _prefix_hashes(data, starts, ends - starts), data.tobytes()
            same = np.ones(len(n) - 1, bool)
            for k in range(LONGEST + 1):
                there, at = marks[:, k] >= 0, np.maximum(marks[:, k], 0)
                h, length = sums[at] - sums[starts], at - starts
                same = same & there[1:] & there[:-1] & (h[1:] == h[:-1]) & (length[1:] == length[:-1])
                runs[k].add(raw, n, starts, marks[:, k], same, opening)
            opening = False
            if len(out) >= 20_000:
                yield _grams(out)
                out.clear()
        for r in runs:
            r.close(at_edge=True)
        if out:
            yield _grams(out)

    return count


def _grams(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([g.decode() for g, _, _ in out], pa.string()), pa.array([k for _, k, _ in out], pa.int32()), pa.array([n for _, _, n in out], pa.int64())], names=["gram", "k", "n"])


def dictionary(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, chunk, n): the distinct chunks of the parse. One that ends its text has a line end behind it."""
    c = lambda x: F.col(f"`{x}`")
    rows = docs.select(F.coalesce(c(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(c(text), F.lit("")).alias("text"))
    return rows.mapInArrow(_parse, "lang string, chunk string, n long").groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


def frequencies(chunks: DataFrame, least: int = LEAST_FREQUENCY, part_bytes: int = PART_BYTES) -> DataFrame:
    """(lang, phrase, k, f) of all phrases of up to LONGEST words with f >= ``least``; k = 0, with an empty phrase, counts all words."""
    bits = chunks.sparkSession.sparkContext.broadcast(_frequent_bits(chunks, least))
    windows = staged(chunks.mapInArrow(_windows(bits), "window string, n long"), "windows")
    size = windows.agg(F.sum(F.octet_length("window") + 16)).first()[0] or 0
    dealt = windows.repartitionByRange(max(1, -(-int(size) // part_bytes)), "window").sortWithinPartitions("window")
    counted = dealt.mapInArrow(_counted(least), "gram string, k int, n long").groupBy("gram", "k").agg(F.sum("n").alias("f"))
    # The language may hold a line end itself, the words do not.
    cut = F.length("gram") - F.length(F.substring_index("gram", "\n", -1))
    split = counted.select(F.expr("substring(gram, 1, length(gram) - length(substring_index(gram, '\n', -1)) - 1)").alias("lang"), F.rtrim(F.substring_index("gram", "\n", -1)).alias("phrase"), "k", "f")
    return split.filter((F.col("f") >= least) | (F.col("k") == 0))


def _number(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def collocations(docs: DataFrame, least: int = LEAST_FREQUENCY, absorb_percent: int = ABSORB_PERCENT, top: int = TOP, lang: str = "lang", text: str = "text") -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    grams = staged(frequencies(staged(dictionary(docs, lang, text), "chunks"), least), "phrases")
    part = lambda side: grams.filter("k between 1 and 4").select(F.col("lang").alias("lang"), F.col("phrase").alias(side), F.col("f").alias(f"f_{side}"))
    candidates = grams.filter("k >= 2").withColumn("words", F.split("phrase", " ", -1))
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    joined = lambda start, n: F.array_join(F.slice("words", start, n), " ")
    cuts = cuts.withColumn("left", joined(F.lit(1), F.col("cut"))).withColumn("right", joined(F.col("cut") + 1, F.size("words")))
    cuts = cuts.join(part("left"), ["lang", "left"]).join(part("right"), ["lang", "right"]).join(grams.filter("k = 0").select("lang", F.col("f").alias("n")), "lang")
    # Up to 10^12 times 10^18 times 1000 fits 38 digits.
    cuts = cuts.select("lang", "phrase", "a", "n", "cut", F.col("f_left").alias("l"), F.col("f_right").alias("r"), _number("a").alias("da"), _number("n").alias("dn"), _number("f_left").alias("dl"), _number("f_right").alias("dr"))
    cuts = cuts.withColumn("score", F.expr("cast((1000 * da * dn) div (dl * dr) as bigint)"))
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "cut", "l", "r")).alias("best"))

    inner = F.flatten(F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda i: F.transform(F.sequence(F.lit(2), F.size("words")), lambda m: F.when((m < F.size("words")) & (i + m - 1 <= F.size("words")), F.array_join(F.slice("words", i, m), " ")))))
    around = candidates.filter("k >= 3").select("lang", F.col("f"), F.explode(inner).alias("phrase")).filter("phrase is not null").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    # A phrase can start at the second word and go on to the last.
    kept = scored.join(around, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < absorb_percent * F.col("a"), F.lit(True)))
    rows = kept.select("lang", "phrase", "a", "n", "best.score", "best.l", "best.r")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The best of every salt first, so that no language's candidates meet in one task.
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("place") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
