"""Interpolated modified Kneser-Ney n-gram model, counted in Spark, kept as sorted hash arrays that workers map into memory.

Tasks count the n-grams of their training texts and send each shard of the hash space one compressed block of (words, count). The
task of a shard merges its blocks, writes its n-grams as sorted arrays into the shared folder and passes on what the next
shorter grams need: how often one occurs, behind how many different words, and, as a context, the sum of what follows it and how much of
that has the value one, two or more. These meet by gram, again by shards, and are written as sorted arrays too, down to single words. Only
the counts of counts reach the driver: they fix the discounts. Scoring maps the arrays (no copies: the workers of a machine share
the pages, and a map holds no open file), looks up the distinct n-grams of a batch in sorted order, and adds up each text.

``p(w|vu) = (a(vuw) - D(a(vuw))) / a(vu.) + g(vu) p(w|u)`` where the value a is the count for the longest grams and for those that open
with a start mark, and else the number of different words before the gram; below single words lies an even share for every word and
one unknown word. A word first seen while scoring has the unknown share; behind an unseen context the shorter one alone counts.

ORDER is the length of the longest grams, 2 or more. Texts are lower-cased in A-Z; words are runs without space or the controls
from tab to carriage return; every text ends in one end token, and begins after ORDER - 1 start marks that are no tokens. Null and empty
texts have the end token only. Training leaves out ids whose checksum is 0 modulo FOLDS, and null ids, which are not held out. Repeated
rows count each time. Other columns are left out. With an empty training set every token has the chance of the one unknown
word. Words are told apart by 64-bit hashes. The shared folder must be mounted on the workers.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.session import scratch_dir

from .common import id_remainder, staged, whole
from .words import hash_words, mix, portions, split_words, word_codes

FOLDS = 10
#: Length of the longest grams the queries learn.
ORDER = 2
#: Bytes of text that a shard of the model stands for, and bytes of text in one block of counts.
SHARD_BYTES, BLOCK_BYTES = 24 << 20, 10 << 20
#: Bytes of blocks passed on at once.
SENT_BYTES = 4 << 20
#: Parts of a shard's hash space that are merged one after the other.
PARTS = 4
#: Bytes of text scored at once.
SCORED_BYTES = 6 << 20
START, END = np.uint64(1), np.uint64(2)
#: What is kept of a gram shorter than the longest: count, different words before, and as a context the sum of values and how many are 1, 2 and more.
FIELDS = ("c", "before", "total", "n1", "n2", "n3")
_FACTS = np.dtype([("c", "<i8"), ("before", "<i8"), ("total", "<i8"), ("n1", "<f4"), ("n2", "<f4"), ("n3", "<f4")])
_TOP, _NARROW = np.dtype([("c", "<u8")]), np.dtype([("c", "<u4")])


def gram(words: Sequence[np.ndarray]) -> np.ndarray:
    """One hash for each row of word hashes."""
    out = mix(words[0])
    with np.errstate(over="ignore"):
        for w in words[1:]:
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + w)
    return out


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct token hashes, place of each token in them, tokens of each text): all tokens in order, every text's end last."""
    flat, lengths = split_words(texts)
    if len(flat):
        codes, distinct = word_codes(flat)
        hashes = np.maximum(hash_words(distinct, 9), np.uint64(16))  # below are marks
    else:
        codes, hashes = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = np.append(hashes, END)
    counts = lengths + 1
    ends = np.cumsum(counts) - 1
    places = np.full(int(counts.sum()), len(hashes) - 1)
    mask = np.ones(len(places), bool)
    mask[ends] = False
    places[mask] = codes
    return hashes, places, counts


def _steps(hashes: np.ndarray, places: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Hashes with the start mark added, and for every token the places of the words of the gram that ends in it."""
    hashes = np.append(hashes, START)
    columns, starts = [places], np.cumsum(counts) - counts
    for _ in range(order - 1):
        before = np.empty_like(places)
        before[1:] = columns[0][:-1]
        before[starts] = len(hashes) - 1
        columns.insert(0, before)
    return hashes, columns


def _distinct(columns: list[np.ndarray], base: int, inverse: bool = False) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of places below ``base``, by their first word, with their numbers or with each row's place among them."""
    code, levels = columns[0], []
    for c in columns[1:-1]:
        seen, code = np.unique(code * base + c, return_inverse=True)
        levels.append(seen)
    code, extra = np.unique(code * base + columns[-1], **({"return_inverse": True} if inverse else {"return_counts": True}))
    out = [code % base]
    code = code // base
    for seen in reversed(levels):
        out.insert(0, seen[code] % base)
        code = seen[code] // base
    return [code, *out], extra


def _merged(columns: Sequence[np.ndarray], values: Sequence[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Equal rows of word hashes with their values added up: keys in order, words, values."""
    key = gram(columns)
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.diff(key, prepend=key[:1] ^ np.uint64(1))) if len(key) else np.zeros(0, int)
    return key[starts], [c[order[starts]] for c in columns], [np.add.reduceat(v[order], starts) if len(starts) else v[order] for v in values]


def _lowered(texts: pa.Array) -> pa.Array:
    """A-Z as a-z; other letters stay."""
    return pc.ascii_lower(texts)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
    """The texts in arrays of about BLOCK_BYTES."""
    for batch in batches:
        texts = batch.column("text")
        for a, b in portions(texts, BLOCK_BYTES):
            yield texts.slice(a, b - a)
        pa.default_memory_pool().release_unused()


def _pieces(table: np.ndarray, places: Sequence[np.ndarray], values: Sequence[np.ndarray], shards: int) -> Iterator[tuple[int, bytes]]:
    """The rows of each shard as a compressed block of its words, the places of the rows' words in them and the values. Rows come by their first place."""
    # By hash of all words: the followers of a frequent word spread over all shards.
    shard = (gram([table[p] for p in places]) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    for k in np.flatnonzero(np.diff(bounds)):
        own = order[bounds[k]:bounds[k + 1]]
        used, at = np.unique(np.concatenate([p[own] for p in places]), return_inverse=True)
        at = at.reshape(len(places), len(own)).astype(np.uint32)
        at[0, 1:] -= at[0, :-1].copy()
        kept = [v[own] for v in values]
        wide = np.dtype(np.uint32 if max(int(v.max()) for v in kept) < 2**32 else np.uint64)
        head = np.array([len(used), len(own), wide.itemsize], np.int64)
        yield int(k), b"G" + zstandard.compress(b"".join([head.tobytes(), table[used].tobytes(), at.tobytes(), *(v.astype(wide).tobytes() for v in kept)]), 1)


def _unpack(block: bytes, length: int, fields: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    raw = zstandard.decompress(memoryview(block)[1:])
    words, n, wide = (int(x) for x in np.frombuffer(raw, np.int64, 3))
    hashes = np.frombuffer(raw, np.uint64, words, 24)
    at = np.frombuffer(raw, np.uint32, length * n, 24 + 8 * words).reshape(length, n)
    values = np.frombuffer(raw, np.dtype(f"<u{wide}"), fields * n, 24 + 8 * words + 4 * length * n).reshape(fields, n)
    return [hashes[np.cumsum(at[0], dtype=np.uint32)], *(hashes[a] for a in at[1:])], [v.astype(np.int64) for v in values]


_BLOCK = "shard int, block binary"


def _rows(rows: Iterable[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Batches of about SENT_BYTES, so that neither side holds all pieces of a block at once."""
    batch = lambda: pa.RecordBatch.from_arrays([pa.array([r[0] for r in held], pa.int32()), pa.array([r[1] for r in held], pa.binary())], ["shard", "block"])
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1])
        if size >= SENT_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _count(order: int, shards: int):
    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _blocks(batches):
            hashes, places, counts = tokens(_lowered(texts))
            hashes, columns = _steps(hashes, places, counts, order)
            columns, n = _distinct(columns, len(hashes))
            yield from _rows(_pieces(hashes, columns, [n], shards))

    return use


def _merge_part(blocks: list[bytes], part: int, length: int, fields: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """The grams of one part of the key space, in order."""
    low, high = part * (2**64 // PARTS), (part + 1) * (2**64 // PARTS) - 1 if part + 1 < PARTS else 2**64 - 1
    found = [([np.zeros(0, np.uint64)] * length, [np.zeros(0, np.int64)] * fields)]
    for block in blocks:
        columns, values = _unpack(block, length, fields)
        key = gram(columns)
        own = (key >= np.uint64(low)) & (key <= np.uint64(high))
        found.append(([c[own] for c in columns], [v[own] for v in values]))
    return _merged([np.concatenate(c) for c in zip(*(f[0] for f in found), strict=True)], [np.concatenate(v) for v in zip(*(f[1] for f in found), strict=True)])


def _shorter(columns: list[np.ndarray], c: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """What grams say of those one word shorter: of their ends, and of their beginnings as contexts."""
    real = value > 0  # rows of start marks alone are contexts only
    columns, c, value = [w[real] for w in columns], c[real], value[real]
    zero = np.zeros(len(c), np.int64)
    context = lambda seen: np.concatenate([zero, seen.astype(np.int64)])
    both = [np.concatenate([end, opening]) for end, opening in zip(columns[1:], columns[:-1], strict=True)]
    return _merged(both, [np.concatenate([c, zero]), np.concatenate([zero + 1, zero]), context(value), context(value == 1), context(value == 2), context(value >= 3)])


def _save(folder: str, name: str, rows: np.ndarray) -> None:
    """Whole or not at all: a second attempt writes the same."""
    part = os.path.join(folder, f".{name}.{os.getpid()}.{os.urandom(4).hex()}")
    with open(part, "wb") as f:
        np.save(f, rows)
    os.replace(part, os.path.join(folder, name))


def _shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Blocks of each shard of a partition, which is sorted by shard."""
    shard, held = None, []
    for batch in batches:
        for k, block in zip(batch.column("shard").to_pylist(), batch.column("block"), strict=True):
            if k != shard and held:
                yield shard, held
                held = []
            shard = k
            held.append(block.as_py())
    if held:
        yield shard, held


def _write_grams(folder: str, length: int, order: int, below: int):
    """Writes the arrays of a shard's grams of this length; passes on what the next shorter ones need, or from single words the totals."""
    dtype = _TOP if length == order else _FACTS

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, held in _shards_of(batches):
            blocks, rows = [b for b in held if b[:1] == b"G"], [(0, b) for b in held if b[:1] == b"T"]
            keys, facts, shorter, totals = [], [], [], {}
            for part in range(PARTS):
                key, columns, values = _merge_part(blocks, part, length, len(dtype.names))
                out = np.empty(len(key), dtype)
                for name, v in zip(dtype.names, values, strict=True):
                    out[name] = v
                value = values[0] if length == order else np.where(columns[0] == START, values[0], values[1])
                for k in (1, 2, 3, 4):
                    totals[f"{length}:{k}"] = totals.get(f"{length}:{k}", 0) + int((value == k).sum())
                if length == 1:
                    for name, v in (("tokens", values[0].sum()), ("words", (values[0] > 0).sum()), ("before", value.sum()), ("more", (value >= 3).sum())):
                        totals[name] = totals.get(name, 0) + int(v)
                else:
                    shorter.append(_shorter(columns, values[0], value)[1:])
                keys.append(key)
                facts.append(out)
            if blocks:
                kept = np.concatenate(facts)
                if length == order and kept["c"].max(initial=0) < 2**32:
                    kept = kept.astype(_NARROW)
                _save(folder, f"facts{length}-{shard:06d}.npy", kept)
                _save(folder, f"keys{length}-{shard:06d}.npy", np.concatenate(keys))
            rows += [(0, f"T{name}={n}".encode()) for name, n in totals.items()]
            if length > 1 and blocks:
                words, values = ([np.concatenate(c) for c in zip(*(s[i] for s in shorter), strict=True)] for i in (0, 1))
                _, words, values = _merged(words, values)
                table, at = np.unique(np.concatenate(words), return_inverse=True)
                at = at.reshape(len(words), len(words[0]))
                by_first = np.argsort(at[0], kind="stable")
                rows += _pieces(table, [a[by_first] for a in at], [v[by_first] for v in values], below)
            yield from _rows(rows)

    return use


def _read_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = [b.as_py()[1:].decode().split("=") for b in batch.column("block")]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([int(p[1]) for p in pairs], pa.int64())], ["name", "n"])


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of one, two and more; fixed ones where the counts of counts give none."""
    if not (n1 and n2 and n3):
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    raw = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw))


def mapped(path: str) -> np.ndarray:
    """The array in a file, mapped: the map stays while the array lives, the file is closed at once."""
    with pa.memory_map(path) as f:
        raw = f.read_buffer()
    head = pa.BufferReader(raw)
    version = np.lib.format.read_magic(head)
    shape, _, dtype = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(head)
    return np.frombuffer(raw, dtype, shape[0], head.tell())


class Model:
    """The arrays in a folder, mapped into memory."""

    def __init__(self, folder: str, facts: dict):
        self.facts, self.order = facts, facts["order"]
        names = sorted(os.listdir(folder))
        files = lambda kind: {int(m[1]): mapped(os.path.join(folder, n)) for n in names if (m := re.fullmatch(kind + r"-(\d+)\.npy", n))}
        self.keys = {k: files(f"keys{k}") for k in range(1, self.order + 1)}
        self.rows = {k: files(f"facts{k}") for k in range(1, self.order + 1)}

    def look_up(self, words: Sequence[np.ndarray]) -> np.ndarray:
        """What is kept of these grams, zeros where one is unknown."""
        length = len(words)
        key, out = gram(words), np.zeros(len(words[0]), _TOP if length == self.order else _FACTS)
        shard = key % np.uint64(self.facts["shards"][length])
        order = np.lexsort((key, shard))
        bounds = np.searchsorted(shard[order], np.arange(self.facts["shards"][length] + 1, dtype=np.uint64))
        for k, keys in self.keys[length].items():
            own = order[bounds[k]:bounds[k + 1]]
            if len(own) and len(keys):
                at = np.minimum(np.searchsorted(keys, key[own]), len(keys) - 1)
                found = keys[at] == key[own]
                out[own[found]] = self.rows[length][k][at[found]]
        return out

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, known tokens, base score and the model's log10 probability of each text."""
        f = self.facts
        hashes, places, counts = tokens(_lowered(texts))
        hashes, columns = _steps(hashes, places, counts, self.order)
        single = self.look_up([hashes])
        c = single["c"].astype(np.float64)
        base = np.log10((c + 0.1) / (f["tokens"] + 0.1 * (f["words"] + 1)))
        # Single words: chances from the number of different words before.
        b, even = single["before"].astype(np.float64), 1.0 / (f["words"] + 1)
        d = np.array([0.0, *f["d"][1]])
        if f["before"]:
            spare = d[1] * f["1:1"] + d[2] * f["1:2"] + d[3] * f["more"]
            word = np.maximum(b - d[np.minimum(b, 3).astype(np.int64)], 0) / f["before"] + spare / f["before"] * even
        else:
            word = np.full(len(b), even)
        grams, back = _distinct(columns, len(hashes), inverse=True)
        p = word[grams[-1]]
        context = single[grams[-2]]
        for length in range(2, self.order + 1):
            own = [hashes[g] for g in grams[-length:]]
            row = self.look_up(own)
            value = (row["c"] if length == self.order else np.where(own[0] == START, row["c"], row["before"])).astype(np.float64)
            d = np.array([0.0, *f["d"][length]])
            total = np.maximum(context["total"], 1)
            weight = np.where(context["total"] > 0, (d[1] * context["n1"] + d[2] * context["n2"] + d[3] * context["n3"]) / total, 1.0)
            p = np.maximum(value - d[np.minimum(value, 3).astype(np.int64)], 0) / total * (context["total"] > 0) + weight * p
            if length < self.order:
                context = self.look_up([hashes[g] for g in grams[-length - 1:-1]])
        p = np.log10(p)
        starts = np.cumsum(counts) - counts
        add = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0)
        return counts, add((c > 0)[places].astype(np.int64)), add(base[places]), add(p[back])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in portions(batch.column("text"), SCORED_BYTES):
            yield batch.slice(a, b - a)
        pa.default_memory_pool().release_unused()


def local_path(path: str) -> str:
    """The shared folder as the workers see it."""
    if path.startswith("file:"):
        path = re.sub("^file:/*", "/", path)
    if "://" in path:
        raise ValueError(f"{path}: the model's arrays are mapped into memory, so spark.checkpoint.dir must be a folder mounted on the workers")
    return path


def train(docs: DataFrame, order: int = ORDER) -> tuple[str, dict]:
    """Counts the training documents; returns the folder of the arrays and the model's few totals."""
    if order < 2:
        raise ValueError("the longest grams have two words or more")
    spark = docs.sparkSession
    folder = local_path(scratch_dir(spark, "ngrams"))
    os.makedirs(folder, exist_ok=True)
    taught = docs.filter(id_remainder("doc_id", FOLDS) != 0).select(whole("text").alias("text"))
    size = taught.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wide = max(4, -(-int(size) // SHARD_BYTES))
    shards = {k: wide for k in range(2, order + 1)} | {1: max(2, wide // 4)}
    rows = taught.mapInArrow(_count(order, wide), _BLOCK)
    # A task that runs again writes the same files again, so nothing between is kept. Each shard is a partition of its own.
    for length in range(order, 0, -1):
        rows = rows.repartitionById(shards[length], "shard").sortWithinPartitions("shard")
        rows = rows.mapInArrow(_write_grams(folder, length, order, shards.get(length - 1, 0)), _BLOCK)
    made = staged(rows.mapInArrow(_read_totals, "name string, n long"), "ngram-totals")
    names = ["tokens", "words", "before", "more", *(f"{length}:{k}" for length in range(1, order + 1) for k in (1, 2, 3, 4))]
    facts = dict.fromkeys(names, 0) | {r["name"]: int(r["n"]) for r in made.groupBy("name").agg(F.sum("n").alias("n")).collect()}
    return folder, facts | {"order": order, "shards": shards, "d": {k: discounts(*(facts[f"{k}:{j}"] for j in (1, 2, 3, 4))) for k in range(1, order + 1)}}


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Query form: base score and model score of every document."""
    folder, facts = train(docs, order)

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(folder, facts)
        for part in _parts(batches):
            n, known, base, own = model.score(part.column("text"))
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("held_out"), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(np.full(len(n), facts["tokens"]), pa.int64()), pa.array(base, pa.float64()), pa.array(own, pa.float64())],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    rows = docs.select("doc_id", F.coalesce(id_remainder("doc_id", FOLDS) == 0, F.lit(False)).alias("held_out"), whole("text").alias("text"))
    schema = rows.drop("text").schema.add("n_tokens", "long").add("n_known", "long").add("train_tokens", "long").add("base_score", "double").add("score", "double")
    return rows.mapInArrow(use, schema)
