"""N-gram Jaccard join by chosen paths: which texts share at least ``THRESHOLD`` of their runs of five words.

Every distinct text gets ``COORDINATES`` min-wise hashes of its shingles; pairs (coordinate, hash) are the tokens of a set
of fixed size. A run puts each set under the tokens it samples with a probability that leaves 1 / THRESHOLD of them on
average; the sampling depends on run and path alone, so similar sets take the same paths. Buckets of more than
``BUCKET`` sets are split again by further sampled tokens, down to ``DEPTH``; then all sets of a bucket are compared by
their hashes. The task of a bucket of up to ``IN_MEMORY`` sets splits it itself; a larger one is split by another round over
the cluster. ``runs()`` gives how many runs reach the target recall for a pair just at the threshold at the last depth;
pairs that part earlier, or are more alike, are found more surely. What the comparison holds possible (below the threshold
by five standard errors of the estimate) is grouped, and within groups every pair is counted exactly on whole shingle
sets, in blocks of bounded size. Links are therefore exact; only a pair that no run brought together can be missed.

Rows: equal texts collapse first, a null text counts as empty. A text of one to four words has one shingle of all its
words; a text without words has none and is linked to its own copies only. Repeated rows and null ids are copies like any
other; a class whose ids are all null has a null class_id. Other columns do not matter. Ties do not arise: a class takes the
least id in it. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import digest, only, staged, whole
from .components import components
from .words import mix, portions, shingles

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
COORDINATES = 128
BUCKET = 400
IN_MEMORY = 40_000
DEPTH = 4
#: Texts of one block when links are counted.
BLOCK = 512
_SEEN = 64


def runs(recall: float = RECALL, depth: int = DEPTH) -> int:
    """A pair at the threshold shares one sampled token a node on average, so it gets through with chance 1 - exp(-chance below)."""
    chance = 1.0
    for _ in range(depth):
        chance = 1 - math.exp(-chance)
    return math.ceil(math.log(1 - recall) / math.log(1 - chance))


def possible(threshold: float = THRESHOLD) -> int:
    """Equal coordinates from which a pair is looked at exactly."""
    return math.floor(COORDINATES * threshold - 5 * math.sqrt(COORDINATES * threshold * (1 - threshold)))


def around(threshold: float = THRESHOLD) -> int:
    """Equal coordinates that whatever is linked to a set alike to a pivot has with that pivot at least, by the triangle inequality."""
    far = max(0.0, 1 - 2 * (1 - threshold))
    return max(1, math.floor(COORDINATES * far - 5 * math.sqrt(COORDINATES * 0.25)))


def _draw(path: np.ndarray, threshold: float) -> np.ndarray:
    """For every path, the coordinates sampled below it as a boolean matrix."""
    with np.errstate(over="ignore"):
        seeds = np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix(path[:, None] ^ seeds[None, :]) < np.uint64(int(2**64 / (threshold * COORDINATES)))


def _child(path: np.ndarray, coordinate: np.ndarray, value: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(path + mix(coordinate.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + value.astype(np.uint64) + np.uint64(1)))


def _signatures(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Min-wise hashes, one row for each set with shingles."""
    rng = np.random.default_rng(20240501)
    factors = rng.integers(1, 2**32, COORDINATES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    shifts = rng.integers(0, 2**32, COORDINATES, dtype=np.uint64).astype(np.uint32)
    some = sizes > 0
    starts = (np.cumsum(sizes) - sizes)[some]
    x = (mix(flat) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((int(some.sum()), COORDINATES), np.uint32)
    with np.errstate(over="ignore"):
        for i in range(COORDINATES):
            y = x * factors[i] + shifts[i]
            # A multiply keeps low bits low: fold the high half in before taking the least.
            y ^= y >> np.uint32(15)
            y *= np.uint32(0x2C1B3C6D)
            out[:, i] = np.minimum.reduceat(y, starts)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        for a, b in portions(texts):
            flat, sizes = shingles(texts.slice(a, b - a), SHINGLE)
            rows, short = [None] * (b - a), [None] * (b - a)
            if len(flat):
                for at, row in zip(np.flatnonzero(sizes), _signatures(flat, sizes), strict=True):
                    rows[at], short[at] = row.tobytes(), row.astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest").slice(a, b - a), batch.column("doc_id").slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(rows, pa.binary()), pa.array(short, pa.binary())],
                ["digest", "doc_id", "size", "signature", "sketch"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), COORDINATES)


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), COORDINATES)


def _first_paths(n_runs: int, threshold: float):
    """Every set under the tokens that each run samples at its root."""

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = mix(np.arange(1, n_runs + 1, dtype=np.uint64))
        run, coordinate = np.nonzero(_draw(roots, threshold))
        for batch in batches:
            ids, sig = batch.column("id").to_numpy(), _matrix(batch.column("signature"))
            path = _child(roots[run][None, :], coordinate[None, :], sig[:, coordinate])
            yield pa.RecordBatch.from_arrays([pa.array(path.ravel().view(np.int64)), pa.array(np.repeat(ids, len(run)))], ["path", "id"])

    return use


def _next_paths(threshold: float):
    """Every set of a large bucket under the tokens that are sampled below it."""

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, ids, sig = batch.column("path").to_numpy().view(np.uint64), batch.column("id").to_numpy(), _matrix(batch.column("signature"))
            row, coordinate = np.nonzero(_draw(path, threshold))
            child = _child(path[row], coordinate, sig[row, coordinate])
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(ids[row])], ["path", "id"])

    return use


def _to_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal coordinates of each set and the pivot of its bucket."""
    for batch in batches:
        same = (_bytes(batch.column("sketch")) == _bytes(batch.column("pivot_sketch"))).sum(1)
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("id"), batch.column("pivot"), pa.array(same, pa.int32())], ["path", "id", "pivot", "same"])


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int) -> Iterator[pa.Table]:
    """Tables of whole groups; rows come sorted by ``keys``, and a table has about ``most`` rows or one group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(len(b) for b in held) < most:
            continue
        full = pa.Table.from_batches(held)
        last = [full.column(k)[len(full) - 1] for k in keys]
        cut = len(full)
        same = np.ones(len(full), bool)
        for k, v in zip(keys, last, strict=True):
            same &= full.column(k).to_numpy() == v.as_py()
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield full.slice(0, cut)
        held = full.slice(cut).to_batches()
    if held and sum(len(b) for b in held):
        yield pa.Table.from_batches(held)


def _starts(*keys: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(keys[0]), bool)
    fresh[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(fresh)


def _pairs_within(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places i < j inside runs of these sizes."""
    places = np.arange(int(sizes.sum()))
    later = np.repeat(np.cumsum(sizes), sizes) - 1 - places
    left = np.repeat(places, later)
    return left, left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(later) - later, later)


def _least_labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _alike(a: np.ndarray, b: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two small matrices with ``least`` equal coordinates or more."""
    equal = np.zeros((len(a), len(b)), np.uint8)
    for i in range(a.shape[1]):
        equal += a[:, i][:, None] == b[:, i][None, :]
    return np.nonzero(equal >= least)


class _Bucket:
    """The splitting of one bucket inside a task: collects pairs of places that are held alike."""

    def __init__(self, sig: np.ndarray, threshold: float):
        self.sig, self.sketch, self.threshold = sig, sig.astype(np.uint8), threshold
        self.left: list[np.ndarray] = []
        self.right: list[np.ndarray] = []

    def all_pairs(self, places: np.ndarray) -> None:
        for k in range(0, len(places), 256):
            x, y = _alike(self.sketch[places[k:k + 256]], self.sketch[places], possible(self.threshold))
            x, y = places[k + x], places[y]
            self.left.append(x[x < y])
            self.right.append(y[x < y])

    def split(self, path: np.uint64, places: np.ndarray, depth: int) -> None:
        if len(places) > BUCKET:
            # What is alike to one of them, the pivot, is joined to it and needs no other comparison; see _with_pivots.
            same = (self.sketch[places] == self.sketch[places[0]]).sum(1)
            near = places[same >= around(self.threshold)]
            self.left.append(np.full(len(near), places[0]))
            self.right.append(near)
            places = places[same < self.threshold * COORDINATES]
        if len(places) <= BUCKET or depth == DEPTH:
            self.all_pairs(places)
            return
        for c in np.flatnonzero(_draw(np.array([path]), self.threshold)[0]):
            order = places[np.argsort(self.sig[places, c], kind="stable")]
            values = self.sig[order, c]
            starts = _starts(values)
            sizes = np.diff(np.append(starts, len(values)))
            few = order[np.repeat((sizes > 1) & (sizes <= _SEEN), sizes)]
            i, j = _pairs_within(sizes[(sizes > 1) & (sizes <= _SEEN)])
            x, y = few[i], few[j]
            good = _same(self.sketch, x, y) >= possible(self.threshold)
            self.left.append(x[good])
            self.right.append(y[good])
            for s, n in zip(starts[sizes > _SEEN], sizes[sizes > _SEEN], strict=True):
                child = _child(np.array([path]), np.array([c]), values[s:s + 1])[0]
                self.split(child, np.sort(order[s:s + n]), depth + 1)


def _same(sketch: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int64)
    for k in range(0, len(x), 100_000):
        out[k:k + 100_000] = (sketch[x[k:k + 100_000]] == sketch[y[k:k + 100_000]]).sum(1)
    return out


def _edges(ids: np.ndarray, left: list[np.ndarray], right: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each id that is linked to a lesser place, and the id at the least place it is linked to."""
    left, right = (np.concatenate(v) if v else np.zeros(0, int) for v in (left, right))
    label = _least_labels(len(ids), left, right)
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return ids[moved], ids[label[moved]]


def _split_in_memory(threshold: float, depth: int):
    """Splits whole buckets and compares what stays together."""

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, ["path"], 1):
            path, ids = t.column("path").to_numpy(), t.column("id").to_numpy()
            sig = _matrix(t.column("signature").combine_chunks())
            starts = _starts(path)
            for s, n in zip(starts, np.diff(np.append(starts, len(path))), strict=True):
                bucket = _Bucket(sig[s:s + n], threshold)
                bucket.split(path[s:s + 1].view(np.uint64)[0], np.arange(n), depth)
                u, v = _edges(ids[s:s + n], bucket.left, bucket.right)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return use


def _compare(least: int):
    """Brute force inside buckets: links each set to the least one that it is held alike to, through others of its bucket."""

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, ["path", "bi", "bj"], 20_000):
            path, bi, bj, half = (t.column(c).to_numpy() for c in ("path", "bi", "bj", "half"))
            ids, sig = t.column("id").to_numpy(), _bytes(t.column("sketch").combine_chunks())
            starts = _starts(path, bi, bj)
            sizes = np.diff(np.append(starts, len(path)))
            where = np.flatnonzero(np.repeat(sizes <= _SEEN, sizes))
            i, j = _pairs_within(sizes[sizes <= _SEEN])
            x, y = where[i], where[j]
            good = _same(sig, x, y) >= least
            left, right = [x[good]], [y[good]]
            for s, n in zip(starts[sizes > _SEEN], sizes[sizes > _SEEN], strict=True):
                own = np.arange(s, s + n)
                a, b = (own[half[own] == 0], own[half[own] == 1]) if bi[s] != bj[s] else (own, own)
                for k in range(0, len(a), 256):
                    x, y = _alike(sig[a[k:k + 256]], sig[b], least)
                    x, y = a[k + x], b[y]
                    left.append(x[x != y])
                    right.append(y[x != y])
            u, v = _edges(ids, left, right)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return use


def _in_blocks(rows: DataFrame, key: str, n: str, block: int) -> DataFrame:
    """Each row once for every pair of blocks of its group that it is part of: (bi, bj, half); small groups are one block."""
    blocks = F.ceil(F.col(n) / block).cast("int")
    own = F.pmod(F.xxhash64("id", F.lit(7)), blocks).cast("int")
    entry = F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(
        F.least(k, own).alias("bi"), F.greatest(k, own).alias("bj"), (own > k).cast("int").alias("half")))
    return rows.withColumn("__e", F.explode(entry)).select(*[c for c in rows.columns if c != n], "__e.*")


def _candidates(sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (u, v) that join all texts which any run holds alike; at most one pair for each text and bucket."""
    signed, sketched = sets.filter("size > 0").select("id", "signature"), sets.filter("size > 0").select("id", "sketch")
    paths = staged(signed.mapInArrow(_first_paths(runs(), threshold), "path long, id long"), "paths")
    found = []
    for depth in range(1, DEPTH + 1):
        counted = staged(_sized(paths).filter("n > 1"), "buckets")
        large = counted.filter(F.col("n") > IN_MEMORY)
        leaves, middle = counted.filter(F.col("n") <= BUCKET), counted.filter((F.col("n") > BUCKET) & (F.col("n") <= IN_MEMORY))
        split = None
        if not large.isEmpty():
            near = staged(_with_pivots(large.select("path", "id"), sketched), "pivots")
            found.append(near.filter(F.col("same") >= around(threshold)).select(F.col("id").alias("u"), F.col("pivot").alias("v")))
            rest = staged(_sized(near.filter(F.col("same") < threshold * COORDINATES).select("path", "id")).filter("n > 1"), "buckets")
            fits = F.lit(True) if depth == DEPTH else F.col("n") <= BUCKET
            leaves, split = leaves.union(rest.filter(fits)), rest.filter(~fits)
        rows = _in_blocks(leaves, "path", "n", BUCKET).join(sketched, "id")
        parts = rows.repartition("path", "bi", "bj").sortWithinPartitions("path", "bi", "bj")
        pairs = parts.select("path", "bi", "bj", "half", "id", "sketch").mapInArrow(_compare(possible(threshold)), "u long, v long")
        whole_ones = middle.select("path", "id").join(signed, "id").repartition("path").sortWithinPartitions("path", "id").select("path", "id", "signature")
        pairs = pairs.union(whole_ones.mapInArrow(_split_in_memory(threshold, depth), "u long, v long"))
        found.append(staged(pairs.distinct(), "candidates"))
        if split is None or split.isEmpty():
            break
        paths = staged(split.select("path", "id").join(signed, "id").select("path", "id", "signature").mapInArrow(_next_paths(threshold), "path long, id long"), "paths")
    return reduce(DataFrame.union, found)


def _sized(paths: DataFrame) -> DataFrame:
    return paths.join(paths.groupBy("path").agg(F.count("*").alias("n")), "path")


def _with_pivots(large: DataFrame, sketched: DataFrame) -> DataFrame:
    """Each set of a large bucket beside one set of it, the pivot.

    What is alike to the pivot needs no comparison with others of the bucket: whatever it is linked to lies near the pivot
    too, and is joined to it. So a large group of near copies costs one comparison a member, not one a pair.
    """
    chosen = large.groupBy("path").agg(F.min(F.struct(F.xxhash64("id").alias("h"), F.col("id"))).alias("p")).select("path", F.col("p.id").alias("pivot"))
    chosen = chosen.join(sketched.select(F.col("id").alias("pivot"), F.col("sketch").alias("pivot_sketch")), "pivot")
    both = large.join(sketched, "id").join(chosen, "path").select("path", "id", "sketch", "pivot", "pivot_sketch")
    return both.mapInArrow(_to_pivot, "path long, id long, pivot long, same int")


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        for a, b in portions(texts):
            flat, sizes = shingles(texts.slice(a, b - a), SHINGLE)
            ends = np.cumsum(sizes)
            sets = [flat[e - n:e].tobytes() for e, n in zip(ends, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), pa.array(sets, pa.binary())], ["id", "shingles"])


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Common elements of every two of up to two blocks of sets, by products of incidence matrices over slices of the vocabulary."""
    n = len(sets)
    if n == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), common], [common, len(sets[1])]])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    starts = _starts(flat)
    often = np.diff(np.append(starts, len(flat))) > 1
    column = np.repeat(np.where(often, np.cumsum(often) - 1, -1), np.diff(np.append(starts, len(flat))))
    owner, column = owner[column >= 0], column[column >= 0]
    out = np.zeros((n, n), np.float64)
    for at in range(0, int(often.sum()), 8192):
        a, b = np.searchsorted(column, [at, at + 8192])
        m = np.zeros((n, min(8192, int(often.sum()) - at)), np.float32)
        m[owner[a:b], column[a:b] - at] = 1
        out += m @ m.T
    return out


def _count_links(threshold: float):
    """Exact links inside a pair of blocks: for every text with any, how many texts and documents, and the least text of its class here."""

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, ["root", "bi", "bj"], 2_000):
            root, bi, bj, half, ids, copies = (t.column(c).to_numpy() for c in ("root", "bi", "bj", "half", "id", "copies"))
            sets = [np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()]
            starts = _starts(root, bi, bj)
            rows: list[list[np.ndarray]] = [[], [], [], []]
            for s, n in zip(starts, np.diff(np.append(starts, len(root))), strict=True):
                if n < 2:
                    continue
                own = slice(s, s + n)
                sizes = np.array([len(x) for x in sets[own]])
                common = _overlaps(sets[own])
                linked = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9
                np.fill_diagonal(linked, False)
                if bi[s] != bj[s]:
                    linked &= half[own][:, None] != half[own][None, :]
                label = _least_labels(n, *np.nonzero(linked))
                some = np.flatnonzero(linked.any(1))
                for column, v in zip(rows, (ids[own][some], linked.sum(1)[some], (linked * copies[own][None, :]).sum(1)[some], ids[own][label[some]]), strict=True):
                    column.append(v)
            if rows[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in rows], ["id", "texts", "docs", "least"])

    return use


def join_texts(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Returns (texts, documents).

    ``texts``: one row per distinct text with digest, copies, first_id, class_id, is_head, n_text_links and n_links.
    ``documents``: digest and doc_id of every row of ``docs``.
    """
    plain = docs.select(digest("text").alias("digest"), F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    signed = staged(plain.mapInArrow(_sign, "digest binary, doc_id long, size long, signature binary, sketch binary"), "signatures")
    documents = signed.select("digest", "doc_id")
    same = lambda c: F.first(c).alias(c)  # noqa: E731  equal texts have equal ones
    heads = signed.groupBy("digest").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"), same("size"), same("signature"), same("sketch"))
    sets = staged(heads.withColumn("id", F.monotonically_increasing_id()), "sets")
    near = staged(components(_candidates(sets, threshold)), "near")
    sized = near.join(near.groupBy("root").agg(F.count("*").alias("n")), "root")
    wanted = staged(sized.join(sets.select("id", "digest", "copies", "first_id"), "id"), "wanted")
    heads = wanted.select("id", F.col("digest").alias("__digest"), "first_id")
    # By id too, so that the copies of a text do not meet in one task; by sorting at every size, as the list of texts grows with the input.
    texts = plain.join(heads.hint("merge"), (F.col("digest") == F.col("__digest")) & F.col("doc_id").eqNullSafe(F.col("first_id"))).select("id", "text").dropDuplicates(["id"])
    shingled = staged(texts.mapInArrow(_shingle_sets, "id long, shingles binary"), "shingles")
    rows = _in_blocks(wanted.select("root", "id", "copies", "n"), "root", "n", BLOCK).join(shingled, "id")
    parts = rows.repartition("root", "bi", "bj").sortWithinPartitions("root", "bi", "bj").select("root", "bi", "bj", "half", "id", "copies", "shingles")
    links = staged(parts.mapInArrow(_count_links(threshold), "id long, texts long, docs long, least long"), "links")
    classes = components(links.select(F.col("id").alias("u"), F.col("least").alias("v")))
    totals = links.groupBy("id").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    full = sets.select("id", "digest", "copies", "first_id").join(classes, "id", "left").join(totals, "id", "left").withColumn("root", F.coalesce("root", "id"))
    head = F.min(F.struct(F.col("first_id").isNull().alias("none"), F.col("first_id"), F.col("digest"))).alias("h")
    out = full.join(full.groupBy("root").agg(head), "root").select(
        "digest", "copies", "first_id", F.col("h.first_id").alias("class_id"), (F.col("h.digest") == F.col("digest")).alias("is_head"),
        F.coalesce("texts", F.lit(0)).alias("n_text_links"), (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return staged(out, "classes"), documents


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Query form: one row per document with its class and its number of links to other documents and other texts."""
    texts, documents = join_texts(docs, threshold)
    return documents.join(texts, "digest").select("doc_id", "class_id", "n_links", "n_text_links", (F.col("copies") - 1).alias("n_copies"))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: the one with the least id; one row of repeated rows."""
    texts, _ = join_texts(docs)
    heads = texts.filter("is_head").select(F.col("digest").alias("__digest"), F.col("first_id").alias("__id"))
    keyed = docs.withColumn("__key", digest("text"))
    kept = keyed.join(heads, (F.col("__key") == F.col("__digest")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    return only(kept.dropDuplicates(["__key"]), docs.columns)
