"""Byte-level BPE encoding and decoding with a pair occurrence index.

The distinct pieces of a batch of texts are laid end to end; every pair of neighbouring symbols that some merge names is
mapped to all its positions there. The lowest active rank is taken, the pair is merged at all its positions from left to
right, and the lists of the pairs that this makes at either side are extended; positions that a merge has used up fail a
check of their two symbols. As every piece always takes its lowest rank first, this gives the merges of one piece at a time.
Pieces met before are kept in a table of bounded size for each task. The vocabulary comes from a tokenizers file
whose path is a parameter; the driver reads it and it is broadcast (the file bounds its size).

Null texts are empty ones: no ids, decoded to an empty text. Null ids lists decode to an empty text too. Very long texts are
handled piece by piece; a piece without white space may be as long as the text. Other columns pass through; columns with
the names of the results are replaced. Empty tables give empty results.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import only, with_columns

#: Fixed value: how byte-level tokenizers of this kind split a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts without characters from U+0250 on, with letters, digits and white space written out.
LETTERS, DIGITS, SPACES = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "\\t-\\r \u0085\u00a0"
LATIN_PIECES = f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^{SPACES}{LETTERS}{DIGITS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
#: Code points that the splitting of the tokenizers library does not hold for letters or digits, as it knows an older Unicode.
NO_LETTERS = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 "
    "11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 "
    "1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD "
    "323B0-33479 3D000-3FC3F"
).split()
#: Pieces laid out at once, pieces after which a worker forgets those that its last batch did not hold, and characters of text in a batch of results.
CHUNK, REMEMBERED, BATCH_CHARS = 60_000, 500_000, 2_000_000
#: A list of so many positions is long.
MANY = 40


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the file: itself if it is printable, else the next one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Vocabulary:
    """What a tokenizers file says, as numbers."""

    def __init__(self, spec: dict):
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer") or model.get("byte_fallback"):
            raise ValueError("only byte-level BPE without a normalizer is handled")
        letters = byte_letters()
        of = {v: k for k, v in letters.items()}
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.first = [ids[letters[b]] for b in range(256)]
        self.size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes = [b""] * self.size
        for token, i in ids.items():
            self.bytes[i] = bytes(of[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.left = [ids[a] for a, _ in merges]
        self.right = [ids[b] for _, b in merges]
        self.made = [ids[a + b] for a, b in merges]
        self.rank: dict[int, int] = {}
        for r, (a, b) in enumerate(zip(self.left, self.right, strict=True)):
            self.rank.setdefault(a * self.size + b, r)
        self.first = np.array(self.first, np.int64)
        self.pairs = np.array(sorted(self.rank), np.int64)
        self.pair_ranks = np.array([self.rank[p] for p in self.pairs.tolist()], np.int64)

    def ranks(self, pairs: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where no merge names it."""
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.pair_ranks[at], -1) if len(self.pairs) else np.full(len(pairs), -1)

    @staticmethod
    def read(path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            return Vocabulary(json.load(f))


def _group(ranks: np.ndarray, positions: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """Positions by rank; negative ranks are left out."""
    some = np.flatnonzero(ranks >= 0)
    order = some[np.argsort(ranks[some], kind="stable")]
    ranks, positions = ranks[order], positions[order]
    at = np.flatnonzero(np.diff(ranks, prepend=-1))
    values = positions.tolist()
    bounds = [*at.tolist(), len(values)]
    for r, x, y in zip(ranks[at].tolist(), bounds, bounds[1:], strict=False):
        yield r, values[x:y]


def merge_pieces(pieces: list[str], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all pieces in order, and how many each piece has, by the pair occurrence index.

    A long list of positions is merged by array operations, a short one position by position, over the same three arrays.
    """
    size, rank_of = v.size, v.rank.get
    coded = [p.encode("utf-8") for p in pieces]
    lengths = np.fromiter(map(len, coded), np.int64, len(coded)) + 1
    ends = np.cumsum(lengths)
    n = int(ends[-1]) if len(ends) else 0
    own = np.ones(n, bool)
    own[ends - 1] = False
    symbols = np.full(n, -size, np.int64)  # -size: ends a piece or is used up; no pair holds it
    symbols[own] = v.first[np.frombuffer(b"".join(coded), np.uint8)]
    symbol = array("q", symbols.tobytes())
    follow, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
    symbols, follows, befores = (np.frombuffer(x, np.int64) for x in (symbol, follow, before))
    places = dict(_group(v.ranks(symbols[:-1] * size + symbols[1:]), np.arange(n - 1)))
    listed = places.get
    active = list(places)
    heapq.heapify(active)
    push, pop = heapq.heappush, heapq.heappop
    while active:
        r = pop(active)
        a, b, new = v.left[r], v.right[r], v.made[r]
        there = places.pop(r)
        if len(there) >= MANY and a != b:
            i = np.unique(np.array(there))
            i = i[symbols[i] == a]
            j = follows[i]
            fits = symbols[j] == b
            i, j = i[fits], j[fits]
            symbols[i], symbols[j] = new, -size
            k = follows[j]
            follows[i], befores[k] = k, i
            p = befores[i]
            p, x = p[p >= 0], i[p >= 0]
            made = np.concatenate([v.ranks(new * size + symbols[k]), v.ranks(symbols[p] * size + symbols[x])])
            for q, more in _group(made, np.concatenate([i, p])):
                at = listed(q)
                if at is None:
                    places[q] = more
                    push(active, q)
                else:
                    at += more
            continue
        there.sort()
        ahead = new * size
        for i in there:
            j = follow[i]
            if symbol[i] != a or symbol[j] != b:
                continue
            symbol[i] = new
            symbol[j] = -size
            k = follow[i] = follow[j]
            before[k] = i
            q = rank_of(ahead + symbol[k])
            if q is not None:
                at = listed(q)
                if at is None:
                    places[q] = [i]
                    push(active, q)
                else:
                    at.append(i)
            p = before[i]
            if p >= 0:
                q = rank_of(symbol[p] * size + new)
                if q is not None:
                    at = listed(q)
                    if at is None:
                        places[q] = [p]
                        push(active, q)
                    else:
                        at.append(p)
    left = symbols >= 0
    upto = np.cumsum(left)[ends - 1] if n else np.zeros(0, np.int64)
    return symbols[left].astype(np.int32), np.diff(upto, prepend=0)


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of runs of these starts and lengths, run after run."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total)
    at += np.repeat(starts - (ends - lengths), lengths)
    return at


class _Numbers(dict):
    """Numbers pieces as they are asked for; ``new`` lists those without ids yet."""

    def __init__(self, *given):
        super().__init__(*given)
        self.new: list = []

    def __missing__(self, piece) -> int:
        self[piece] = n = len(self)
        self.new.append(piece)
        return n


class _Table:
    """Pieces and their ids, numbered as they come."""

    def __init__(self):
        self.number = _Numbers()
        self.ids, self.starts, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def fill(self, v: Vocabulary) -> None:
        """Gives ids to the pieces numbered since the last call. Special tokens, tuples of one, are laid behind the others."""
        new, self.number.new = self.number.new, []
        plain = [p for p in new if type(p) is str]
        parts = [merge_pieces(plain[at:at + CHUNK], v) for at in range(0, len(plain), CHUNK)]
        marks = np.array([v.special[p[0]] for p in new if type(p) is tuple], np.int32)
        lengths = np.concatenate([*(part[1] for part in parts), np.ones(len(marks), np.int64)])
        order = np.argsort(np.fromiter((type(p) is tuple for p in new), bool, len(new)), kind="stable")
        placed = np.zeros((2, len(new)), np.int32)
        placed[:, order] = len(self.ids) + np.cumsum(lengths) - lengths, lengths
        self.starts, self.lengths = np.concatenate([self.starts, placed[0]]), np.concatenate([self.lengths, placed[1]])
        self.ids = np.concatenate([self.ids, *(part[0] for part in parts), marks])

    def only(self, numbers: np.ndarray) -> _Table:
        """The pieces of these ascending numbers."""
        pieces, out = list(self.number), _Table()
        out.number = _Numbers(zip(map(pieces.__getitem__, numbers.tolist()), range(len(numbers))))
        out.lengths = self.lengths[numbers]
        out.ids = self.ids[_runs(self.starts[numbers], out.lengths)]
        out.starts = (np.cumsum(out.lengths) - out.lengths).astype(np.int32)
        return out


class Coder:
    """Encodes and decodes texts; remembers the pieces it met last, up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        spans = "".join("-".join(rf"\U{int(x, 16):08x}" for x in span.split("-")) for span in NO_LETTERS)
        self.new, self.split_new = re.compile(f"[{spans}]").search, regex.compile(PIECES.replace(r"\p{L}", f"[\\p{{L}}--[{spans}]]").replace(r"\p{N}", f"[\\p{{N}}--[{spans}]]").replace(
            f"[^\\s[\\p{{L}}--[{spans}]][\\p{{N}}--[{spans}]]]", f"[^\\s[\\p{{L}}\\p{{N}}--[{spans}]]]"), regex.V1).findall
        self.wide, self.split_latin, self.split_any = re.compile("[\u0250-\U0010ffff]").search, re.compile(LATIN_PIECES).findall, regex.compile(PIECES).findall
        self.table = _Table()
        self.byte_lengths = np.fromiter(map(len, vocabulary.bytes), np.int64, vocabulary.size)
        self.byte_starts = np.cumsum(self.byte_lengths) - self.byte_lengths
        self.all_bytes = np.frombuffer(b"".join(vocabulary.bytes), np.uint8)
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def split(self, text: str) -> list[str]:
        if not self.wide(text):
            return self.split_latin(text)
        return self.split_new(text) if self.new(text) else self.split_any(text)

    def _pieces(self, text: str) -> list:
        """Special tokens stand in the list as themselves, in a tuple of one."""
        if not self.marks or not self.marks.search(text):
            return self.split(text)
        out: list = []
        for part in self.marks.split(text):
            out.extend([(part,)] if part in self.v.special else self.split(part))
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and how many each text has. A text's pieces go once they are numbered."""
        table = self.table
        numbers = [np.fromiter(map(table.number.__getitem__, pieces), np.int32, len(pieces)) for pieces in map(self._pieces, texts)]
        table.fill(self.v)
        at = np.concatenate([np.zeros(0, np.int32), *numbers])
        lengths = table.lengths[at]
        upto = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        ends = np.cumsum(np.fromiter(map(len, numbers), np.int64, len(numbers)))
        counts = np.diff(upto[ends], prepend=0)
        ids = table.ids[_runs(table.starts[at], lengths)]
        if len(table.number) > REMEMBERED:
            self.table = table.only(np.unique(at))
        return ids, counts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each list of ids; bytes that are no UTF-8 become U+FFFD."""
        lengths = self.byte_lengths[ids]
        held = self.all_bytes[_runs(self.byte_starts[ids], lengths)].tobytes()
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(counts)
        return [held[x:y].decode("utf-8", "replace") for x, y in zip(upto[ends - counts].tolist(), upto[ends].tolist(), strict=True)]


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids, pa.int32()))


_CODERS: dict[int, Coder] = {}


def _coder(vocabulary) -> Coder:
    """One for each Python worker, which serves many tasks: what it remembers does not change any result."""
    own = vocabulary.value
    if id(own) not in _CODERS:
        _CODERS.clear()
        _CODERS[id(own)] = Coder(own)
    return _CODERS[id(own)]


def _portions(column: pa.Array) -> Iterator[list[str]]:
    """The texts in lists of about BATCH_CHARS characters; null texts are empty ones."""
    held, size = [], 0
    for text in column:
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= BATCH_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _task(vocabulary, work, text: int, kept: int):
    """Adds what ``work`` makes of the texts in column ``text`` to the first ``kept`` columns."""

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here makes cycles, and the tables of pieces are slow to walk
        coder = _coder(vocabulary)
        for batch in batches:
            at = 0
            for texts in _portions(batch.column(text)):
                part = batch.slice(at, len(texts))
                at += len(texts)
                made = work(coder, texts)
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], *made.values()], [*part.schema.names[:kept], *made])

    return use


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids", decoded: str | None = None, keep_text: bool = True) -> DataFrame:
    """Adds the ids of every whole text and, where a name for it is given, the text that these ids decode to.

    A text that stays goes to the workers and back as one column; without ``keep_text`` it does not come back.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(path))

    def work(coder: Coder, texts: list[str]) -> dict[str, pa.Array]:
        flat, counts = coder.encode(texts)
        out = {ids: _lists(flat, counts)}
        return out | ({decoded: pa.array(coder.decode(flat, counts), pa.string())} if decoded else {})

    taken = {ids.lower(), (decoded or ids).lower()} | (set() if keep_text else {text.lower()})
    kept = [c for c in docs.columns if c.lower() not in taken]
    at = next((i for i, c in enumerate(kept) if c.lower() == text.lower()), len(kept))
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], *([F.col(text).alias("__text")] if at == len(kept) else []))
    schema = T.StructType(rows.schema.fields[:len(kept)]).add(ids, T.ArrayType(T.IntegerType()))
    return rows.mapInArrow(_task(vocabulary, work, at, len(kept)), schema.add(decoded, "string") if decoded else schema)


def decode(docs: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """Adds the text of every list of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(path))

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary)
        for batch in batches:
            lists = batch.column("__ids")
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = coder.decode(lists.flatten().to_numpy(zero_copy_only=False), counts)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*batch.schema.names[:-1], text])

    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != text.lower()], F.col(f"`{ids}`").alias("__ids"))
    return rows.mapInArrow(use, rows.drop("__ids").schema.add(text, "string"))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Query form: per document the number of ids, and hashes of the ids and of the text that they decode to."""
    coded = encode(only(docs, ["doc_id", "text"]), path, decoded="decoded", keep_text=False)
    return coded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def with_tokens(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with token_ids and n_tokens."""
    coded = encode(docs, path)
    return with_columns(coded, n_tokens=F.size("token_ids").cast("long"))
