"""Trie of conversations by their common beginnings, in double arrays.

A turn becomes a digest and its length; texts are not moved after that. Equal conversations become one
path with a weight. Paths are dealt out in the order of their digests, in
ranges, so a shard holds neighbouring paths and the size of a shard does not depend on how many share a beginning:
a first turn that a third of all conversations have spreads over a third of the shards.

A shard numbers its digests densely, the most frequent first, and packs its trie into two arrays: the child of
node s by number c is at BASE[s] + c, and CHECK there says s. Nodes with many children are placed first
and those with one fill the holes. Each path is then walked through the arrays to count members, and the arrays are traversed from
the deepest node up for sums over subtrees.

Only nodes on a shard's first and last path can be in other shards too. They leave the shard with a key (a digest of all turns
so far) and are merged over all shards. Everything merged is a sum or a minimum: what two neighbouring shards both
counted is exactly the beginning that the last path of one shares with the first path of the next, and is taken off once
for each such border. So no subtree, however large, is gathered anywhere.

Memory: a task holds one shard of about ``SHARD_TURNS`` turns (or one conversation, if longer): some hundred bytes a
turn. A conversation is one row of digests, which its turns meet in; texts never do.
Spark's sample for the ranges has about a hundred paths a shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cyclemart.llm.tables import written

SHARD_TURNS = 200_000
#: Tries at a free place before a node with several children goes behind the last one.
TRIES = 200
#: Ids of members travel in pieces of about so many bytes where they are written out as text.
PIECE_BYTES = 1 << 16

TURNS = "array<struct<digest:string,chars:int>>"
_NODES = (
    "shard int, conv_id {id}, depth long, parent_conv_id {id}, n_convs long, n_children long, n_leaves long, weighted long, chars long, "
    "path string, key string, parent_key string, path_chars long, own_chars long, first boolean, last boolean"
)


def conversation_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's digests and lengths in order of turn, null first, then of digest.

    Null roles and texts count as empty. Rows without a conv_id belong to no conversation and are left
    out; repeated rows are turns of their own. Other columns play no part.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", F.struct("turn", digest.alias("digest"), F.length(text).alias("chars")).alias("turn")
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return ordered.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def _path(turns: str = "turns") -> Column:
    return F.md5(F.encode(F.array_join(F.col(turns)["digest"], ""), "UTF-8"))


class DoubleArray:
    """A trie over dense codes: ``base[s] + c`` is the child of s by code c where ``check`` there is s; the root is slot 0."""

    def __init__(self, paths: list[list[int]]):
        """``paths`` of codes, sorted so that equal beginnings are neighbours."""
        children: list[list[int]] = [[]]
        kids: list[list[int]] = [[]]
        spine, before = [0], []
        for path in paths:
            shared, end = 0, min(len(path), len(before))
            while shared < end and path[shared] == before[shared]:
                shared += 1
            del spine[shared + 1:]
            for code in path[shared:]:
                node = len(children)
                children.append([])
                kids.append([])
                children[spine[-1]].append(code)
                kids[spine[-1]].append(node)
                spine.append(node)
            before = path
        self._pack(children, kids)

    def _pack(self, children: list[list[int]], kids: list[list[int]]) -> None:
        n = len(children)
        self.base = [0] * n
        self.check = [-1] * n
        self.check[0] = 0  # the root's own slot is taken
        slots = [0] * n
        bases = [0] * n
        start, free = 1, 1
        for node in sorted((i for i in range(n) if children[i]), key=lambda i: -len(children[i])):
            codes = children[node]
            least, most = min(codes), max(codes)
            if len(codes) == 1:
                while free < len(self.check) and self.check[free] >= 0:
                    free += 1
                base = max(free, least) - least
                while base + least < len(self.check) and self.check[base + least] >= 0:
                    base += 1
            else:
                base, tried = max(start - least, 0), 0
                while any(base + c < len(self.check) and self.check[base + c] >= 0 for c in codes):
                    base, tried = base + 1, tried + 1
                    if tried == TRIES:  # crowded here: go on from the far end
                        start = base = len(self.check)
            if base + most >= len(self.check):
                longer = base + most + 1 - len(self.check)
                self.check += [-1] * longer
                self.base += [0] * longer
            bases[node] = base
            for code, kid in zip(codes, kids[node], strict=True):
                slots[kid] = base + code
                self.check[base + code] = node  # the parent's slot, once all slots are known
        taken = [(slots[i], i) for i in range(n)]
        for slot, node in taken:
            if node:
                self.check[slot] = slots[self.check[slot]]
            if children[node]:
                self.base[slot] = bases[node]
        #: Slots in use, parents before children.
        self.nodes = [slot for slot, _ in taken]

    def child(self, slot: int, code: int) -> int:
        """The slot of a child, or -1."""
        at = self.base[slot] + code
        return at if 0 < at < len(self.check) and self.check[at] == slot else -1

    def walk(self, path: list[int]) -> Iterator[int]:
        """Slots from the root down the path."""
        slot = 0
        yield slot
        for code in path:
            slot = self.child(slot, code)
            if slot < 0:
                raise KeyError(code)
            yield slot


def _dense(digests: list[list[str]]) -> list[list[int]]:
    """Digests as numbers from 0, the most frequent first."""
    counts: dict[str, int] = {}
    for path in digests:
        for digest in path:
            counts[digest] = counts.get(digest, 0) + 1
    number = {digest: i for i, digest in enumerate(sorted(counts, key=lambda d: (-counts[d], d)))}
    return [[number[digest] for digest in path] for path in digests]


def shard_nodes(shard: int, digests: list[list[str]], chars: list[list[int]], paths: list[str], convs: list, n_convs: list[int]) -> dict[str, list]:
    """Nodes of the trie of some neighbouring paths, by column."""
    codes = _dense(digests)
    trie = DoubleArray(codes)
    size = len(trie.check)
    depth, own, total, members, least, ends = [0] * size, [0] * size, [0] * size, [0] * size, [None] * size, [None] * size
    for i, path in enumerate(codes):
        so_far = 0
        for d, slot in enumerate(trie.walk(path)):
            if members[slot] == 0 and d:
                depth[slot], own[slot] = d, chars[i][d - 1]
            so_far += own[slot]
            total[slot] = so_far
            members[slot] += n_convs[i]
            if least[slot] is None or convs[i] < least[slot]:
                least[slot] = convs[i]
        ends[slot] = paths[i]
    n_children, leaves, weighted, held = [0] * size, [0] * size, [0] * size, [0] * size
    for slot in reversed(trie.nodes):
        leaves[slot] = leaves[slot] or 1
        weighted[slot] += members[slot] * own[slot]
        held[slot] += own[slot]
        if slot:
            up = trie.check[slot]
            n_children[up] += 1
            leaves[up] += leaves[slot]
            weighted[up] += weighted[slot]
            held[up] += held[slot]
    keys: dict[int, str] = {}
    sides = {}
    for side, i in (("first", 0), ("last", len(codes) - 1)):
        running = hashlib.md5()
        for slot, digest in zip(trie.walk(codes[i]), [*digests[i], ""], strict=True):
            keys[slot] = running.hexdigest()
            running.update(digest.encode())
        sides[side] = set(trie.walk(codes[i]))
    nodes = trie.nodes
    up = [trie.check[s] if s else -1 for s in nodes]
    return {
        "shard": [shard] * len(nodes), "conv_id": [least[s] for s in nodes], "depth": [depth[s] for s in nodes],
        "parent_conv_id": [least[u] if s and u not in keys else None for s, u in zip(nodes, up, strict=True)],
        "n_convs": [members[s] for s in nodes], "n_children": [n_children[s] for s in nodes], "n_leaves": [leaves[s] for s in nodes],
        "weighted": [weighted[s] for s in nodes], "chars": [held[s] for s in nodes], "path": [ends[s] for s in nodes],
        "key": [keys.get(s) for s in nodes], "parent_key": [keys.get(u) for u in up], "path_chars": [total[s] for s in nodes],
        "own_chars": [own[s] for s in nodes], "first": [s in sides["first"] for s in nodes], "last": [s in sides["last"] for s in nodes],
    }


def _shard_tries(ranged: DataFrame, kind: str) -> DataFrame:
    id_kind = to_arrow_type(ranged.schema["conv_id"].dataType)
    kinds = {"shard": pa.int32(), "conv_id": id_kind, "parent_conv_id": id_kind, "first": pa.bool_(), "last": pa.bool_()}
    kinds |= dict.fromkeys(("path", "key", "parent_key"), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        digests, chars, paths, convs, weights = [], [], [], [], []
        for batch in batches:
            turns = batch.column(0)
            bounds = turns.offsets.to_numpy()
            one, two = turns.values.field("digest").to_pylist(), turns.values.field("chars").to_pylist()
            digests += [one[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            chars += [two[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            paths += batch.column(1).to_pylist()
            convs += batch.column(2).to_pylist()
            weights += batch.column(3).to_pylist()
        if not paths:
            return
        found = shard_nodes(shard, digests, chars, paths, convs, weights)
        for at in range(0, len(found["shard"]), 20_000):
            yield pa.RecordBatch.from_pydict({n: pa.array(v[at:at + 20_000], kinds.get(n, pa.int64())) for n, v in found.items()})

    return ranged.mapInArrow(run, _NODES.format(id=kind))


def prefix_nodes(sequences: DataFrame) -> DataFrame:
    """Nodes of the trie of ``sequences`` (conv_id, turns as ``conversation_turns`` makes them).

    One row for each distinct beginning of d turns, from the root without turns: conv_id (its smallest member), depth,
    parent_conv_id (of the root: null), n_convs (members), n_children, n_leaves and saved_chars (n_convs - 1 times the length of the last
    turn's text, both summed over its subtree with itself), path (digest of the conversations that end here, else null).
    Every conv_id stands for one sequence; a conversation without turns is a member of the root
    only. Without conversations there is no root.
    """
    kind = sequences.schema["conv_id"].dataType.simpleString()
    grouped = sequences.withColumn("path", _path()).groupBy("path").agg(
        F.any_value("turns").alias("turns"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")
    )
    distinct = written(grouped.select("turns", "path", "conv_id", "n_convs"), "paths")
    n_turns = distinct.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    ranged = distinct.withColumn("digests", F.col("turns")["digest"])
    ranged = ranged.repartitionByRange(max(1, -(-n_turns // SHARD_TURNS)), "digests").sortWithinPartitions("digests").drop("digests")
    nodes = written(_shard_tries(ranged, kind), "trie-nodes")

    inner = nodes.filter("key IS NULL").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("weighted") - F.col("chars")).alias("saved_chars"),
        "path", "parent_key", "shard",
    )
    shared = nodes.filter("key IS NOT NULL")
    merged = written(_merged(shared), "trie-shared")
    up = merged.select(F.col("key").alias("up"), F.col("conv_id").alias("up_conv"))
    outer = merged.join(up, F.col("parent_key") == F.col("up"), "left").select(
        "conv_id", "depth", F.col("up_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_chars", "path"
    )
    # A shared node may have very many children: they look it up by shard, where it has one row each.
    by_shard = shared.select(F.col("key").alias("up"), F.col("shard").alias("up_shard")).join(up, "up").select("up", "up_shard", "up_conv")
    below = inner.join(by_shard, (F.col("parent_key") == F.col("up")) & (F.col("shard") == F.col("up_shard")), "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "up_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_chars", "path"
    )
    return outer.unionByName(below)


def _merged(shared: DataFrame) -> DataFrame:
    """Nodes that may be in several shards, each once."""
    shards = shared.select("shard").distinct()
    following = shards.select(F.col("shard").alias("border"), F.lead("shard").over(Window.orderBy("shard")).alias("next"))
    last = shared.filter("last").join(following, F.col("shard") == F.col("border")).select(
        "border", "next", "key", "depth", "path_chars", "own_chars", (F.col("n_children") == 0).alias("childless")
    )
    first = shared.filter("first").select(F.col("shard").alias("next"), "key")
    common = last.join(first, ["next", "key"])  # the beginning that both sides of a border have
    deepest = common.groupBy("border").agg(
        F.max("depth").alias("end"), F.max("path_chars").alias("end_chars"), F.max_by("childless", "depth").alias("false_leaf")
    )
    twice = common.join(deepest, "border").select(
        "key",
        F.when(F.col("depth") < F.col("end"), -1).otherwise(0).cast("long").alias("n_children"),
        # the last path of one side ends where the other side goes on
        F.when(F.col("false_leaf"), -1).otherwise(0).cast("long").alias("n_leaves"),
        (F.col("path_chars") - F.col("own_chars") - F.col("end_chars")).alias("chars"),
    )
    counted = shared.select("key", "conv_id", "depth", "parent_key", "path", "n_convs", "n_children", "n_leaves", "weighted", "chars")
    empty = {c: F.lit(None).cast(counted.schema[c].dataType) for c in ("conv_id", "depth", "parent_key", "path", "n_convs", "weighted")}
    return counted.unionByName(twice.withColumns(empty)).groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"), F.max("path").alias("path"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        (F.sum("weighted") - F.sum("chars")).alias("saved_chars"),
    )


def member_lists(sequences: DataFrame, digest: str = "ends_sha256") -> DataFrame:
    """(path, digest): SHA-256 of the ids of each path's conversations, ascending, written in decimal and joined by commas.

    The ids of one path may be very many. They are sorted in ranges over the cluster and become pieces of text
    there; only finished pieces of a path meet, in order, and are hashed one after another.
    """
    rows = sequences.select(_path().alias("path"), "conv_id")
    ranges = rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, begin, parts, size = None, None, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([begin], pa.int64()), pa.array([",".join(parts)])], ["path", "begin", "ids"])

        for batch in batches:
            for own, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if parts and (own != path or size >= PIECE_BYTES):
                    yield piece()
                    parts, size = [], 0
                if not parts:
                    path, begin = own, conv
                parts.append(str(conv))
                size += len(parts[-1]) + 1
        if parts:
            yield piece()

    texts = ranges.mapInArrow(pieces, "path string, begin long, ids string")
    ordered = texts.repartition("path").sortWithinPartitions("path", "begin")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, running = None, None
        for batch in batches:
            done: tuple[list, list] = ([], [])
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if own != path:
                    if path is not None:
                        done[0].append(path)
                        done[1].append(running.hexdigest())
                    path, running = own, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            if done[0]:
                yield pa.RecordBatch.from_arrays([pa.array(done[0]), pa.array(done[1])], ["path", digest])
        if path is not None:
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([running.hexdigest()])], ["path", digest])

    return ordered.mapInArrow(hashed, f"path string, {digest} string")
