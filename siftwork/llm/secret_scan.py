"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Two first-order models over the characters of keys and names are counted from labelled strings: random ones are what the
patterns catch in a bounded sample of documents, and strings drawn uniformly from the usual alphabets; ordinary ones are all
other runs of the same characters in that sample, but for long ones that mix letters and digits. The sample is about ``SAMPLE`` distinct documents, by the hash of id and text.
The patterns' spans always stay and are cut out of the runs of such characters. In what is left of a run the stretch with the best
log-likelihood ratio in favour of random, widened to the next of ``/_=-`` or the end on both sides, less the parts between
these signs that speak for ordinary names (at its edges, or enough of them in a row to divide it), is a secret if the ratio is ``RATIO`` or more and it has ``LEAST`` characters or more with a letter among them; the rests beside it are looked at in the same way.

Offsets are code points, ends exclusive. A null text is empty and has no spans; null ids stay. Repeated rows give repeated
rows. Other columns pass through ``redact`` unchanged and are left out of ``scan``. An empty table gives an empty result; its
models rest on the drawn strings alone. Spans of one start are listed by kind: assign, access, hex, markov.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sampled, whole

KINDS = ["assign", "access", "hex", "markov"]
#: The base patterns and the least sizes of what they must catch.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
#: A run of 24 or more from its start is the same as a run of any size kept from 24 on, and is found faster.
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST, RATIO, SAMPLE, DRAWN = 16, 10.0, 2_000, 300
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_WORDS = re.compile(r"[A-Za-z0-9+/_=-]{4,}")
_PART = re.compile(r"[^/_=-]+")
#: Long runs of letters and digits are what is to be judged, so they are labelled as neither.
_MIXED = re.compile(r"(?=.{16})(?=.*[0-9])(?=.*[A-Za-z])").match
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_PLACE = np.full(128, 0, np.int64)
_PLACE[[ord(c) for c in ALPHABET]] = np.arange(1, len(ALPHABET) + 1)
STATES = len(ALPHABET) + 1  # 0: before the first character


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the base patterns, sorted."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(out)


def _steps(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Transitions of all strings as state * STATES + state, and where each string's begin."""
    joined = _PLACE[np.frombuffer("\n".join(["", *strings]).encode("ascii"), np.uint8)]  # the line feed is state 0
    starts = np.flatnonzero(joined[:-1] == 0)
    return joined[:-1] * STATES + joined[1:], starts


def drawn(seed: int = 11) -> list[str]:
    rng = random.Random(seed)
    sets = ["0123456789abcdef", "0123456789ABCDEF", ALPHABET[:62], ALPHABET[:64]]
    return ["".join(rng.choice(sets[i % len(sets)]) for _ in range(rng.randint(20, 44))) for i in range(DRAWN)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Transitions of caught and of ordinary strings of the sampled documents."""
    total = np.zeros((2, STATES * STATES), np.int64)
    for batch in batches:
        for text in batch.column("text").to_pylist():
            spans = base_spans(text)
            caught = [text[s:e] for s, k, e in spans if k] + [m.group(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
            hidden = list(text)
            for s, _, e in spans:
                hidden[s:e] = "\n" * (e - s)
            for row, strings in ((0, [x for c in caught for x in _WORDS.findall(c)]), (1, [x for x in _WORDS.findall("".join(hidden)) if not _MIXED(x)])):
                if strings:
                    total[row] += np.bincount(_steps(strings)[0], minlength=STATES * STATES)
    some = np.flatnonzero(total.ravel())
    yield pa.RecordBatch.from_arrays([pa.array(some // STATES**2, pa.int32()), pa.array(some % STATES**2, pa.int32()), pa.array(total.ravel()[some])], ["cls", "step", "n"])


def train(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of every transition, random over ordinary. At most 2 * STATES ** 2 counts reach the driver."""
    sample = sampled(docs.select("doc_id", whole("text").alias("text")), SAMPLE)
    rows = sample.select("text").mapInArrow(_count, "cls int, step int, n long").groupBy("cls", "step").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((2, STATES * STATES))
    for r in rows:
        counts[r.cls, r.step] += r.n
    counts[0] += np.bincount(_steps(drawn())[0], minlength=STATES * STATES)
    counts = counts.reshape(2, STATES, STATES)[:, :, 1:]
    share = counts.sum(1, keepdims=True) + 1  # back off to how often each character comes at all
    prior = share / share.sum(2, keepdims=True)
    p = (counts + 20 * prior) / (counts.sum(2, keepdims=True) + 20)
    out = np.zeros((STATES, STATES))
    out[:, 1:] = np.log(p[0]) - np.log(p[1])
    return out.ravel()


def pieces(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """What the base spans leave of the runs, where it is long enough."""
    for m in RUN.finditer(text):
        at, end = m.span()
        for s, _, e in base:
            if s >= end:
                break
            if e > at:
                if s - at >= LEAST:
                    yield at, s
                at = max(at, e)
        if end - at >= LEAST:
            yield at, end


def best_stretch(ratios: list[float]) -> tuple[float, int, int]:
    """The highest sum of neighbours and where it lies; the first of equal ones."""
    best, at, to = 0.0, 0, 0
    total, start = 0.0, 0
    for i, x in enumerate(ratios):
        if total <= 0:
            total, start = 0.0, i
        total += x
        if total > best:
            best, at, to = total, start, i + 1
    return best, at, to


def _random_stretches(string: str, ratios: list[float]) -> Iterator[tuple[int, int]]:
    """Places of the secrets of one piece."""
    open_parts = [(0, len(string))]
    while open_parts:
        a, b = open_parts.pop()
        if b - a < LEAST:
            continue
        best, s, e = best_stretch(ratios[a:b])
        if best < RATIO:
            continue
        s, e = s + a, e + a
        while s > a and string[s - 1] not in "/_=-":
            s -= 1
        while e < b and string[e] not in "/_=-":
            e += 1
        open_parts += [(a, s), (e, b)]
        for x, y in _without_names(string, ratios, s, e):
            if y - x >= LEAST and any("A" <= c <= "z" and c != "_" for c in string[x:y]):
                yield x, y


def _without_names(string: str, ratios: list[float], s: int, e: int) -> list[tuple[int, int]]:
    """A stretch without the parts that speak for ordinary names: those at its edges, and neighbours inside it with a sum of ``-RATIO`` or
    less, which divide it. ``=`` stays at its end."""
    out: list[list[float]] = []
    gap = 0.0
    for m in _PART.finditer(string, s, e):
        own = sum(ratios[m.start():m.end()])
        if own <= 0:
            gap += own
            continue
        if out and gap > -RATIO:
            out[-1][1:] = [m.end(), out[-1][2] + gap + own]
        else:
            out.append([m.start(), m.end(), own])
        gap = 0.0
    while out and out[-1][1] < e and string[out[-1][1]] == "=" and not string[out[-1][1]:e].strip("="):
        out[-1][1] += 1
    return [(a, b) for a, b, total in out if total >= RATIO]


def markov_spans(texts: list[str], base: list[list[tuple[int, int, int]]], ratios: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The stretches that are more likely random, outside the base spans, for each text."""
    owner, starts, strings = [], [], []
    for i, text in enumerate(texts):
        for s, e in pieces(text, base[i]):
            owner.append(i)
            starts.append(s)
            strings.append(text[s:e])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not strings:
        return out
    steps, first = _steps(strings)
    single = ratios[steps]
    for at in np.flatnonzero(np.add.reduceat(np.maximum(single, 0), first) >= RATIO):  # no stretch can have more
        own = single[first[at]:first[at] + len(strings[at])].tolist()
        out[owner[at]] += [(starts[at] + s, 3, starts[at] + e) for s, e in _random_stretches(strings[at], own)]
    return out


def _line(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(ratios: np.ndarray, with_text: bool):
    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                texts = part.column(part.num_columns - 1).to_pylist()
                base = [base_spans(t) for t in texts]
                both = [sorted(a + b) for a, b in zip(base, markov_spans(texts, base, ratios), strict=True)]
                if with_text:
                    masked = pa.array([_masked(t, s) for t, s in zip(texts, both, strict=True)], pa.string())
                    yield pa.RecordBatch.from_arrays([part.column(0), masked], ["row", "masked"])
                    continue
                kinds = [[k for _, k, _ in b] for b in base]
                lines = [_line(b) for b in base]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), *[pa.array([k.count(i) for k in kinds], pa.int64()) for i in range(3)],
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in lines]), pa.array([_line(b) for b in both])],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return use


def _masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, or chain of overlapping spans, as one mark; of an assignment the key stays."""
    out, at = [], 0
    for s, k, e in spans:
        if k == 0:
            s = ASSIGN.match(text, s).start(2)
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], "[SECRET]"]
        at = e
    return "".join([*out, text[at:]])


def scan(docs: DataFrame) -> DataFrame:
    """Query form: counts and spans of every document."""
    rows = docs.select("doc_id", whole("text").alias("text"))
    schema = rows.drop("text").schema.add("n_assign", "long").add("n_access", "long").add("n_hex", "long").add("base_sha256", "string").add("spans", "string")
    return rows.mapInArrow(_scan(train(docs), False), schema)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced; rows and columns stay, n_chars follows the text, a null text stays null.

    Rows travel as one struct, so columns of any name pass."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), whole("text").alias("masked"))
    done = rows.mapInArrow(_scan(train(docs), True), rows.schema)
    changed = F.col("masked") != whole(F.col("row.text"))

    def column(field):
        own = F.col("row").getField(field.name)
        if field.name.lower() == "text":
            return F.when(own.isNotNull(), F.col("masked"))
        if field.name.lower() == "n_chars":
            return F.when(changed, F.length("masked").cast(field.dataType)).otherwise(own)
        return own

    return done.select(*[column(f).alias(f.name) for f in docs.schema.fields])
