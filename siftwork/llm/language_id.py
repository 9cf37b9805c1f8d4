"""Language identification by cross-parsing: suffix automata of labelled text tell how many phrases a text falls into.

For every language a reference text is built from a bounded sample of its labelled documents: of its distinct texts the ``DOCS`` with
the least hash, from each a piece of up to ``CHARS`` characters at a hashed place of the whole text, until ``BUDGET`` characters are
reached. Every language with a letter in some text has one. Its suffix automaton gives the longest match from any place. A whole text,
brought to lower-case words with one blank between them, is cut greedily into longest matches, which run on over the ends of words; the language
with the fewest phrases, each weighed by the logarithm of the reference's size, wins.

Words are letters (Unicode ``L``) with the marks that follow them; other signs, fractions and raised digits among them, are none. A null
text, or one without letters, is ``und`` with score 0. Null languages teach nothing; a null id teaches nothing and is
not held out. Ties go to the least language code. Repeated rows are judged alike and teach once. Other columns are left out. Without any
labelled text every document is ``und``; an empty table gives an empty result.
"""

from __future__ import annotations

import gc
import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_remainder

FOLDS, DOCS, CHARS, BUDGET = 5, 300, 1_500, 45_000
_WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
DENSE, NARROW, TOGETHER = 63, 24, 4_000_000


class SuffixAutomaton:
    """Transitions of the suffix automaton of a text."""

    def __init__(self, text: str):
        self.size = len(text)
        follow: list[dict[str, int]] = [{}]
        link, length = [-1], [0]
        last = 0
        for c in text:
            cur = len(follow)
            follow.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in follow[p]:
                follow[p][c] = cur
                p = link[p]
            if p >= 0:
                q = follow[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    copy = len(follow)
                    follow.append(dict(follow[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p >= 0 and follow[p].get(c) == q:
                        follow[p][c] = copy
                        p = link[p]
                    link[q] = link[cur] = copy
            last = cur
        self.follow = follow

    def step(self, state: int, text: str) -> tuple[int, int]:
        """The state after ``text`` and how many phrases ended within it."""
        follow, n = self.follow, 0
        for c in text:
            to = follow[state].get(c)
            if to is None:
                n += state != 0
                to = follow[0].get(c)
                if to is None:
                    n += 1
                    to = 0
            state = to
        return state, n

    def phrases(self, text: str) -> int:
        """Longest matches, or single unknown characters, that the text falls into."""
        state, n = self.step(0, text)
        return n + (state != 0)


def words(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def reference(texts: list[str]) -> str:
    """The pieces as words; no phrase runs from one into the next."""
    return "\n".join(f" {' '.join(w)} " for t in texts if (w := words(t)))


class Judge:
    """Parses texts against all references.

    All texts and languages go forward together, one character a step, over one table of transitions with a column for each of the
    ``DENSE`` most frequent characters of the references; other characters, and the last texts when fewer than ``NARROW`` go on, take the
    automata's own transitions. Both give the same states.
    """

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        self.automata = [SuffixAutomaton(samples[x]) for x in self.languages]
        self.weights = np.array([math.log2(a.size + 2) for a in self.automata])
        often = Counter(chain.from_iterable(samples.values()))
        code = {c: k for k, c in enumerate(sorted(often, key=lambda c: (-often[c], c))[:DENSE], 1)}
        self.columns = len(code) + 1
        self.codes = np.zeros(0x110000, np.uint8)
        self.codes[[ord(c) for c in code]] = list(code.values())
        self.roots = np.cumsum([0, *(len(a.follow) for a in self.automata)])[:-1].astype(np.int64)
        tables = []
        for a, root in zip(self.automata, self.roots, strict=True):
            steps = [(s * self.columns + code[c], to + root) for s, f in enumerate(a.follow) for c, to in f.items() if c in code]
            table = np.full(len(a.follow) * self.columns, -1, np.int32)
            table[[k for k, _ in steps]] = [to for _, to in steps]
            tables.append(table)
        self.table = np.concatenate(tables) if tables else np.empty(0, np.int32)

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of every text by language (rows) and text (columns)."""
        order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
        sizes = np.array([len(texts[k]) for k in order])
        signs = np.frombuffer("".join(texts[k] for k in order).encode("utf-32-le"), np.uint32)
        codes = self.codes[signs]
        at = np.cumsum(sizes) - sizes
        roots, columns, table = self.roots[:, None], self.columns, self.table
        state = np.repeat(roots, len(texts), 1)
        n = np.zeros(state.shape, np.int64)
        i, wide = 0, len(texts)
        while True:
            while wide and sizes[wide - 1] <= i:
                wide -= 1
            if wide < NARROW:
                break
            now, here = codes[at[:wide] + i], state[:, :wide]
            to = table[here * columns + now].astype(np.int64)
            for j in np.flatnonzero(now == 0):
                for k, a in enumerate(self.automata):
                    place, ended = a.step(here[k, j] - self.roots[k], chr(signs[at[j] + i]))
                    to[k, j] = place + self.roots[k]
                    n[k, j] += ended
            row, col = np.nonzero(to < 0)
            if len(row):
                root = self.roots[row]
                again = table[root * columns + now[col]].astype(np.int64)
                n[row, col] += (here[row, col] != root).astype(np.int64) + (again < 0)
                to[row, col] = np.where(again < 0, root, again)
            state[:, :wide] = to
            i += 1
        for j in range(wide):
            for k, a in enumerate(self.automata):
                place, ended = a.step(state[k, j] - self.roots[k], texts[order[j]][i:])
                state[k, j] = place + self.roots[k]
                n[k, j] += ended
        n += state != roots
        out = np.empty_like(n)
        out[:, order] = n
        return out

    def judge(self, texts: list[str]) -> tuple[list[str], list[float]]:
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        own = [words(t) for t in texts]
        some = [k for k, w in enumerate(own) if w and self.languages]
        at = 0
        while at < len(some):
            to, size = at, 0
            while to < len(some) and size < TOGETHER:
                size += len(texts[some[to]])
                to += 1
            costs = self.phrases([f" {' '.join(own[k])} " for k in some[at:to]]) * self.weights[:, None]
            best = np.argsort(costs, 0, kind="stable")
            for j, k in enumerate(some[at:to]):
                langs[k] = self.languages[best[0, j]]
                scores[k] = float(1 - costs[best[0, j], j] / costs[best[1, j], j]) if len(best) > 1 else 1.0
            at = to
        return langs, scores


_JUDGES: dict[int, Judge] = {}


def _judge(samples: dict[str, str]) -> Judge:
    """One for each Python worker, which serves many tasks."""
    key = hash(tuple(sorted(samples.items())))
    if key not in _JUDGES:
        _JUDGES.clear()
        _JUDGES[key] = Judge(samples)
    return _JUDGES[key]


def learn(docs: DataFrame) -> dict[str, str]:
    """Reference texts by language; at most DOCS hashes of a language are broadcast and BUDGET characters of one reach the driver."""
    taught = docs.filter((id_remainder("doc_id", FOLDS) != 0) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    taught = taught.select("lang", "text", F.xxhash64("text").alias("hash"))
    least = taught.groupBy("lang", "hash").agg(F.lit(1).alias("one")).withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("hash"))).filter(F.col("n") <= DOCS)
    flat = F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{M}]+", " "))
    start = F.pmod("hash", F.greatest(F.lit(1), F.length("flat") - CHARS + 1)).cast("int") + 1
    pieces = taught.join(F.broadcast(least.select("lang", "hash", "n")), ["lang", "hash"]).select("lang", "n", "hash", flat.alias("flat")).select("lang", "n", F.substring("flat", start, F.lit(CHARS)).alias("piece"))
    once = pieces.groupBy("lang", "n").agg(F.min("piece").alias("piece"))
    before = F.sum(F.length("piece")).over(Window.partitionBy("lang").orderBy("n").rowsBetween(Window.unboundedPreceding, -1))
    rows = once.withColumn("room", BUDGET - F.coalesce(before, F.lit(0))).filter("room > 0").select("lang", "n", F.expr("left(piece, cast(room as int))").alias("piece")).collect()
    texts: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.n)):
        texts.setdefault(r.lang, []).append(r.piece)
    return {k: t for k, v in texts.items() if (t := reference(v))}


def predict(docs: DataFrame) -> DataFrame:
    """Query form: the language of every document, from its text alone."""
    samples = docs.sparkSession.sparkContext.broadcast(learn(docs))

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here makes cycles
        judge = _judge(samples.value)
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.slice(at, 2000)
                langs, scores = judge.judge([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", F.coalesce(id_remainder("doc_id", FOLDS) == 0, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(use, rows.drop("text").schema.add("lang_pred", "string").add("score", "double"))
