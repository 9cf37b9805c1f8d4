"""Conversation prefix trie: every distinct sequence of first turns is a node, with its members and what sharing it saves.

Each conversation becomes one key, 16 bytes of hash for each turn, and keys are dealt by ranges to sorted parts. In a part the
lengths of the common prefixes of neighbours are edges; a union-find over the edges, deepest first, makes a branching node of every
merge, and chains between branching nodes are unrolled at the end. Only the nodes on the way to a part's first and last key
may go on in the parts beside it. These spines are what is left of a part's forest, contracted to one row a node; forests of
neighbouring parts are merged, ``FAN`` at a time, until one is left, and every node inside the range is finished on the way.

Copies are no special case: equal keys are dealt on by conversation id, so a group of copies spreads over parts. The one thing that runs
over all of a group's ids in one place is its SHA-256, as that hash must be fed in order; it gets text written out by the parts.
A conversation is one row, as a document's text is: 20 bytes a turn.

Turns are ordered by turn (nulls first), equal ones by role and text hashes, so repeated rows are repeated turns. Null roles and texts
are empty. Rows without a conversation id belong to none and are left out. Other columns are not used. An empty table has no
node, not even a root.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, whole

CODE = 16
#: Bytes of keys in a part.
PART_BYTES = 8 << 20
#: Neighbouring forests merged in one task.
FAN = 32
#: Ids are written out for hashing in strings of so many.
IDS_A_PIECE = 50_000
NO_ID = hashlib.sha256(b"").hexdigest()

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: A finished node (kind n), with the name of its parent (up) if that is on a spine; a spine node (s), on the way to the first or last
#: key; or ids for hashing (i). For spine nodes n_children, n_leaves and saved_tokens tell of finished children only.
ENTRY = f"kind string, part long, piece long, name binary, up binary, first boolean, last boolean, {NODE}, chars long, ends binary, ids binary"
TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
ARROW_ENTRY = pa.schema([(name, TYPES[kind]) for name, kind in (f.split() for f in ENTRY.split(","))])


def sequences(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, codes, chars): the turns of each conversation in order, as hashes and code points of the text."""
    c = lambda x: F.col(f"`{x}`")
    said = F.concat(F.md5(whole(c(role))), F.md5(whole(c(text))))
    rows = turns.filter(c(conv_id).isNotNull()).select(c(conv_id).alias("conv_id"), F.struct(c(turn).alias("turn"), F.md5(said).alias("code"), F.length(whole(c(text))).alias("chars")).alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.col("t.code").alias("codes"), F.col("t.chars").alias("chars"))


def rebuilt(convs: DataFrame, block: int = 100, heads: int = 6) -> DataFrame:
    """Every conversation with its first h turns taken from the first one of its block; h = crc32(id) % ``heads``."""
    base = F.col("conv_id") - F.col("conv_id") % block
    first = lambda c, n: F.slice(c, F.lit(1), n)
    given = convs.filter(F.col("conv_id") == base).select(F.col("conv_id").alias("base"), first("codes", F.lit(heads)).alias("b_codes"), first("chars", F.lit(heads)).alias("b_chars"))
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    rows = convs.withColumn("base", base).withColumn("h", h).join(given, "base", "left")
    glued = lambda own, head: F.concat(F.coalesce(first(head, F.col("h")), first(own, F.lit(0))), F.slice(own, F.col("h") + 1, F.size(own)))
    return rows.select("conv_id", glued("codes", "b_codes").alias("codes"), glued("chars", "b_chars").alias("chars"))


def _names(key: bytes) -> list[bytes]:
    """What the prefixes of a key are known by in every part: depth and a hash of the whole prefix, made in one pass."""
    h, out = hashlib.md5(), []
    for d in range(len(key) // CODE + 1):
        out.append(d.to_bytes(8, "big") + h.digest())
        h.update(key[CODE * d: CODE * (d + 1)])
    return out


def _common(keys: list[bytes]) -> list[int]:
    """How many turns each key shares with the next one, compared for all pairs at once."""
    n = np.fromiter((len(k) // CODE for k in keys), np.int64, len(keys))
    starts = np.cumsum(n) - n
    codes = np.frombuffer(b"".join(keys), np.dtype((np.void, CODE))).view(np.uint64).reshape(-1, 2)
    shorter = np.minimum(n[:-1], n[1:])
    pair = np.repeat(np.arange(len(shorter)), shorter)
    at = np.arange(len(pair)) - np.repeat(np.cumsum(shorter) - shorter, shorter)
    differ = np.flatnonzero((codes[starts[pair] + at] != codes[starts[pair + 1] + at]).any(1))
    out = shorter.copy()
    np.minimum.at(out, pair[differ], at[differ])
    return out.tolist()


class _Forest:
    """The compressed trie over sorted distinct keys. A node reaches from ``top`` down to ``depth`` in a chain."""

    def __init__(self, depths: list[int], counts: list[int], least: list[int], sums: list[list[int]], common: list[int]):
        n = len(depths)
        self.depth, self.top, self.n, self.least = depths, [0] * n, counts, least
        self.sums = sums  # of every key: code points up to each depth
        self.key, self.parent, self.children, self.leaves, self.saved = list(range(n)), [-1] * n, [0] * n, [0] * n, [0] * n
        self._merge(common)

    def _merge(self, common: list[int]) -> None:
        group, node = list(range(len(common) + 1)), list(range(len(common) + 1))

        def find(i: int) -> int:
            while group[i] != i:
                group[i] = group[group[i]]
                i = group[i]
            return i

        # Deepest edges first, equal ones from left to right, so the left side of an edge may already branch there.
        for e in sorted(range(len(common)), key=lambda e: -common[e]):
            d, left, right = common[e], find(e), find(e + 1)
            a, b = node[left], node[right]
            if self.depth[a] > d:
                a = self._over(a, d)
            self._attach(b, a)
            group[right], node[left] = left, a
        if self.depth[node[find(0)]] > 0:
            self._over(node[find(0)], 0)

    def _over(self, child: int, depth: int) -> int:
        """A new node above ``child``."""
        new = len(self.depth)
        for column, value in ((self.depth, depth), (self.top, depth), (self.n, 0), (self.least, self.least[child]), (self.key, self.key[child]), (self.parent, -1), (self.children, 0), (self.leaves, 0), (self.saved, 0)):
            column.append(value)
        self._attach(child, new)
        return new

    def _attach(self, child: int, parent: int) -> None:
        self.parent[child], self.top[child] = parent, self.depth[parent] + 1
        self.n[parent] += self.n[child]
        self.least[parent] = min(self.least[parent], self.least[child])
        self.children[parent] += 1
        self.leaves[parent] += max(1, self.leaves[child])
        self.saved[parent] += self.saved[child] + self.chain(child)

    def chain(self, x: int) -> int:
        """What sharing saves on the chain of a node that has a parent."""
        sums = self.sums[self.key[x]]
        return (self.n[x] - 1) * (sums[self.depth[x]] - sums[self.top[x] - 1])

    def way_up(self, x: int) -> Iterator[int]:
        while x >= 0:
            yield x
            x = self.parent[x]


def _part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of one sorted part: finished nodes, the spine, and ids for hashing of the keys that end on it."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    rows = pa.Table.from_batches(rows)
    part, ids, raw = rows["part"][0].as_py(), rows["conv_id"].to_pylist(), rows["key"].to_pylist()
    begins = [0, *[i for i in range(1, len(raw)) if raw[i] != raw[i - 1]]]
    spans, keys = list(zip(begins, [*begins[1:], len(raw)])), [raw[i] for i in begins]
    sums = [list(itertools.accumulate(c, initial=0)) for c in rows["chars"].take(begins).to_pylist()]
    f = _Forest([len(k) // CODE for k in keys], [b - a for a, b in spans], [ids[a] for a, _ in spans], sums, _common(keys))
    written = lambda a, b: ",".join(map(str, ids[a:b])).encode()
    ways = {side: set(f.way_up(side)) for side in (0, len(keys) - 1)}
    names = {side: _names(keys[side]) for side in ways}
    on_spine = {x: side for side, way in ways.items() for x in way}
    below = {x: [0, 0, 0] for x in on_spine}  # what hangs there and is finished: children, leaves, saved
    out = _Rows()
    for x in range(len(f.depth)):
        if x in on_spine:
            continue
        parent = f.parent[x]
        up = None
        if parent in on_spine:
            up, hung = names[on_spine[parent]][f.depth[parent]], below[parent]
            hung[0] += 1
            hung[1] += max(1, f.leaves[x])
            hung[2] += f.saved[x] + f.chain(x)
        out.chain(f, x, up, hashlib.sha256(written(*spans[x])).hexdigest() if x < len(keys) else NO_ID)
    for x, side in on_spine.items():
        flags = {"first": x in ways[0], "last": x in ways[len(keys) - 1]}
        for d in range(f.top[x], f.depth[x] + 1):
            hung = below[x] if d == f.depth[x] else (0, 0, 0)
            out.add(kind="s", part=part, name=names[side][d], up=names[side][d - 1] if d else None, **flags, conv_id=f.least[x], depth=d, n_convs=f.n[x], n_children=hung[0], n_leaves=hung[1], saved_tokens=hung[2],
                    chars=sums[side][d] - sums[side][d - 1] if d else 0, ends=hashlib.md5(keys[x]).digest() if d == f.depth[x] and x < len(keys) else None)
    for x in sorted(x for x in on_spine if x < len(keys)):
        for piece, i in enumerate(range(*spans[x], IDS_A_PIECE)):
            out.add(kind="i", part=part, piece=piece, ends=hashlib.md5(keys[x]).digest(), ids=written(i, min(spans[x][1], i + IDS_A_PIECE)))
    yield from out.batches()


class _Rows:
    """Rows of ENTRY, gathered by column."""

    def __init__(self):
        self.columns = {c: [] for c in ARROW_ENTRY.names}

    def add(self, **values) -> None:
        for c, column in self.columns.items():
            column.append(values.get(c))

    def chain(self, f: _Forest, x: int, up: bytes | None, digest: str) -> None:
        """All nodes of a finished chain, from its end up."""
        depth, top, n, least, sums = f.depth[x], f.top[x], f.n[x], f.least[x], f.sums[f.key[x]]
        saved, leaves = f.saved[x], max(1, f.leaves[x])
        for d in range(depth, top - 1, -1):
            saved += (n - 1) * (sums[d] - sums[d - 1])
            at_top, at_end = d == top, d == depth
            self.add(kind="n", up=up if at_top else None, conv_id=least, depth=d, parent_conv_id=f.least[f.parent[x]] if at_top else least, n_convs=n, n_children=f.children[x] if at_end else 1,
                     n_leaves=leaves, saved_tokens=saved, ends_sha256=digest if at_end else NO_ID)

    def batches(self) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(self.columns["kind"]), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(self.columns[c.name][i:i + 20_000], c.type) for c in ARROW_ENTRY], schema=ARROW_ENTRY)


def _merge_spines(last_round: bool) -> Callable[[pa.Table], pa.Table]:
    """Merges the spines of neighbouring parts. Nodes off the ways to the first and last key of them all are finished."""

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        low, high = min(r["part"] for r in rows), max(r["part"] for r in rows)
        nodes: dict[bytes, dict] = {}
        for r in rows:
            first, last = r["first"] and r["part"] == low, r["last"] and r["part"] == high
            x = nodes.get(r["name"])
            if x is None:
                nodes[r["name"]] = r | {"first": first, "last": last}
                continue
            x["conv_id"], x["ends"] = min(x["conv_id"], r["conv_id"]), x["ends"] or r["ends"]
            x["first"], x["last"] = x["first"] or first, x["last"] or last
            for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                x[c] += r[c]
        out = _Rows()
        for x in sorted(nodes.values(), key=lambda x: -x["depth"]):
            if (x["first"] or x["last"]) and not last_round:
                out.add(**x | {"part": low // FAN})
                continue
            x["kind"], x["n_leaves"] = "n", max(1, x["n_leaves"])
            x["saved_tokens"] += (x["n_convs"] - 1) * x["chars"]
            if x["up"] is not None:
                up = nodes[x["up"]]
                up["n_children"] += 1
                up["n_leaves"] += x["n_leaves"]
                up["saved_tokens"] += x["saved_tokens"]
            out.add(**x)
        return pa.Table.from_batches(list(out.batches()), ARROW_ENTRY)

    return merge


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's ids, from its pieces in order; one piece in memory at a time."""
    key, running = None, None
    done = lambda: pa.RecordBatch.from_pydict({"__ends": pa.array([key], pa.binary()), "__sha": [running.hexdigest()]})
    for b in batches:
        for ends, ids in zip(b["ends"], b["ids"]):
            ends, ids = ends.as_py(), ids.as_py()
            if ends != key:
                if key is not None:
                    yield done()
                key, running = ends, hashlib.sha256(ids)
            else:
                running.update(b"," + ids)
    if key is not None:
        yield done()


def trie(convs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """All nodes of the trie over ``convs`` (conv_id, codes, chars), as ``sequences`` makes them; ids are distinct."""
    narrow = staged(convs.select("conv_id", F.unhex(F.array_join("codes", "")).alias("key"), "chars"), "conversations")
    size = narrow.agg(F.sum(F.octet_length("key") + 4 * F.size("chars") + 16)).first()[0]
    dealt = narrow.repartitionByRange(max(1, -(-int(size or 0) // part_bytes)), "key", "conv_id").sortWithinPartitions("key", "conv_id")
    made = staged(dealt.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(_part, ENTRY), "forests")
    open_nodes = made.filter("kind = 's'")
    forests, spine = (open_nodes.agg(F.max("part")).first()[0] or 0) + 1, None
    while True:
        last_round = forests <= FAN
        merged = staged(open_nodes.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(_merge_spines(last_round), ENTRY), "spines")
        finished = merged.filter("kind = 'n'")
        spine = finished if spine is None else spine.union(finished)
        if last_round:
            break
        open_nodes, forests = merged.filter("kind = 's'"), -(-forests // FAN)
    pieces = made.filter("kind = 'i'").select("ends", "part", "piece", "ids").repartition("ends").sortWithinPartitions("ends", "part", "piece")
    hashed = pieces.mapInArrow(_hash_pieces, "__ends binary, __sha string")
    spine = staged(spine.join(hashed, F.col("ends") == F.col("__ends"), "left").withColumn("ends_sha256", F.coalesce("__sha", F.lit(NO_ID))), "spine")
    columns = [c.split()[0] for c in NODE.split(",")]
    # A parent on a spine is known in full only now.
    inside, names = made.filter("kind = 'n'"), spine.select(F.col("name").alias("__name"), F.col("conv_id").alias("__least"))
    waiting = inside.filter("up is not null").select(*columns, "up").union(spine.select(*columns, "up")).join(names, F.col("up") == F.col("__name"), "left")
    return inside.filter("up is null").select(*columns).union(waiting.withColumn("parent_conv_id", F.col("__least")).select(*columns))


def digest(turns: DataFrame) -> DataFrame:
    """Query form: the trie of all rebuilt conversations."""
    return trie(rebuilt(sequences(turns)))
