"""Prefix trie of conversations, its subtree totals by time-forward processing.

A conversation is a sequence of turns (role, text); a node stands for a distinct sequence of first turns. A
turn is carried as two 64-bit hashes and its length, never its text. A node's name is its depth and two
exclusive-ors over the hashes of (position, turn) of its turns, running along each conversation.

Conversations are dealt to shards by blocks of neighbouring ids. A shard holds the nodes of its conversations,
with all their ancestors: a node of many shards has a copy in each, and its own value lies in one of them (that
of its smallest member). Within a shard the nodes are sorted externally by reverse level, deepest first, and each
passes its subtree's totals to its parent through a priority queue in that same order. The queue spills sorted runs to
the disk of its task when it has more than ``QUEUE`` messages. The copies' totals are added across shards then: as
every shard has the whole way from its nodes to the root, the sum over a node's copies is its subtree's total. The
shards of a node shared by many conversations are many, and none of them has more than its own conversations' turns.

Defined cases: rows without a conversation id belong to no conversation; null roles and texts are empty; turns are
ordered with nulls first, equal turns of a conversation by their hash; repeated rows are turns of their own; a
conversation of any length is a stream of narrow rows; a conversation without turns is a member of the root alone; an
empty table has no node; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workpulse.llm.common import cut, text_or_empty

#: Turns of a shard, about.
SHARD_TURNS = 200_000
#: Conversations with neighbouring ids that go to the same shard.
NEIGHBOURS = 100
#: Messages that a queue keeps in memory.
QUEUE = 200_000
#: Ids of a block that is hashed as one piece of text.
BLOCK_IDS = 4096
NODE = ("depth", "w1", "w2")


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos, t1, t2, chars) of every turn: its place from 1, its two hashes and its text's code points."""
    who, what = text_or_empty(conversations[role]), text_or_empty(conversations[text])
    own = conversations.where(conversations[conv_id].isNotNull()).select(
        conversations[conv_id].cast("long").alias("conv_id"),
        conversations[turn].alias("_turn"),
        F.xxhash64(who, what).alias("t1"),
        F.xxhash64(F.lit("turn"), what, who).alias("t2"),
        F.length(what).cast("long").alias("chars"),
    )
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("_turn"), "t1", "t2"))
    return own.select("conv_id", place.alias("pos"), "t1", "t2", "chars")


def with_shared_openings(own: DataFrame, block: int = 100, most: int = 5) -> DataFrame:
    """``turns`` rebuilt: a conversation's first h turns are those of the first conversation of its block of ids.

    h is the crc32 of the decimal id modulo ``most`` + 1. Each conversation also has one row at pos 0, for the root.
    At most ``most`` turns of a block's first conversation go to at most ``block`` others.
    """
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    ids = own.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % block).alias("_first"), taken.alias("_h"))
    opening = own.where((F.col("pos") <= most) & (F.col("conv_id") % block == 0)).withColumnRenamed("conv_id", "_first")
    given = ids.join(opening, "_first").where("pos <= _h").select("conv_id", F.lit(1).alias("_part"), "pos", "t1", "t2", "chars")
    kept = own.where(F.col("pos") > taken).select("conv_id", F.lit(2).alias("_part"), "pos", "t1", "t2", "chars")
    zero = F.lit(0).cast("long")
    roots = ids.select("conv_id", F.lit(0).alias("_part"), F.lit(0).alias("pos"), zero.alias("t1"), zero.alias("t2"), zero.alias("chars"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("_part", "pos")) - 1
    return roots.unionByName(given).unionByName(kept).select("conv_id", place.alias("pos"), "t1", "t2", "chars")


def with_root(own: DataFrame) -> DataFrame:
    """``turns`` as they are, with one row at pos 0 for each conversation."""
    zero = F.lit(0).cast("long")
    ids = own.select("conv_id").distinct()
    return ids.select("conv_id", F.lit(0).alias("pos"), zero.alias("t1"), zero.alias("t2"), zero.alias("chars")).unionByName(own)


def prefixes(placed: DataFrame) -> DataFrame:
    """Each conversation's node at every depth: (conv_id, depth, w1, w2, p1, p2, chars, is_end); p1, p2 name the parent."""
    along = Window.partitionBy("conv_id").orderBy("pos")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    root = F.col("pos") == 0
    h1 = F.when(root, 0).otherwise(F.xxhash64("pos", "t1", "t2"))
    h2 = F.when(root, 0).otherwise(F.xxhash64("t2", "pos", "t1"))
    hashed = placed.select("conv_id", "pos", "chars", h1.cast("long").alias("_h1"), h2.cast("long").alias("_h2"))
    return hashed.select(
        "conv_id",
        F.col("pos").cast("long").alias("depth"),
        F.bit_xor("_h1").over(so_far).alias("w1"),
        F.bit_xor("_h2").over(so_far).alias("w2"),
        F.bit_xor("_h1").over(so_far).bitwiseXOR(F.col("_h1")).alias("p1"),
        F.bit_xor("_h2").over(so_far).bitwiseXOR(F.col("_h2")).alias("p2"),
        "chars",
        F.lead("pos").over(along).isNull().alias("is_end"),
    )


class SpillingQueue:
    """A priority queue of (key, a, b); beyond ``limit`` messages a sorted run goes to the disk of the task."""

    def __init__(self, limit: int = QUEUE):
        self.limit = limit
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # (key, a, b, run) of the runs, a heap too
        self.runs: dict[int, Iterator[tuple]] = {}
        self.made = 0

    def push(self, key: tuple, a: int, b: int) -> None:
        heapq.heappush(self.heap, (key, a, b))
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        if len(self.runs) >= 32:  # few files are open at a time: the runs so far become one
            rows = iter(list(self.heads))
            merged = heapq.merge(((k, a, b) for k, a, b, _ in sorted(rows)), *self.runs.values(), self._drained())
            self.heads, self.runs = [], {}
            self._add(self._written(merged))
        else:
            self._add(self._written(self._drained()))

    def _drained(self) -> Iterator[tuple]:
        self.heap.sort()
        rows, self.heap = self.heap, []
        return iter(rows)

    @staticmethod
    def _written(rows: Iterator[tuple]) -> Iterator[tuple]:
        file = tempfile.TemporaryFile()  # has no name, so nothing is left when the task ends
        block: list[tuple] = []
        for row in rows:
            block.append(row)
            if len(block) == 4096:
                pickle.dump(block, file)
                block = []
        pickle.dump(block, file)
        pickle.dump(None, file)
        file.seek(0)

        def read() -> Iterator[tuple]:
            with file:
                while (found := pickle.load(file)) is not None:
                    yield from found

        return read()

    def _add(self, run: Iterator[tuple]) -> None:
        self.made += 1
        self.runs[self.made] = run
        self._next(self.made)

    def _next(self, run: int) -> None:
        row = next(self.runs[run], None)
        if row is None:
            del self.runs[run]
        else:
            heapq.heappush(self.heads, (*row, run))

    def take(self, key: tuple) -> tuple[int, int]:
        """The sums of all messages for ``key``; no smaller key may be left."""
        a = b = 0
        while self.heap and self.heap[0][0] == key:
            row = heapq.heappop(self.heap)
            a, b = a + row[1], b + row[2]
        while self.heads and self.heads[0][0] == key:
            row = heapq.heappop(self.heads)
            a, b = a + row[1], b + row[2]
            self._next(row[3])
        if (self.heap and self.heap[0][0] < key) or (self.heads and self.heads[0][0] < key):
            raise RuntimeError("a message was not taken: the nodes are not in reverse level order")
        return a, b


def time_forward(limit: int = QUEUE):
    """Rows (shard, depth, w1, w2, p1, p2, leaves, saved) in reverse level order to subtree totals of each node."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queue = SpillingQueue(limit)
        now: tuple | None = None
        parent: tuple = ()
        leaves = saved = 0
        out: list[tuple] = []

        def close() -> None:
            a, b = queue.take(now)
            shard, level, w1, w2 = now
            out.append((-level, w1, w2, leaves + a, saved + b))
            if level:
                queue.push((shard, level + 1, *parent), leaves + a, saved + b)

        for batch in batches:
            for shard, depth, w1, w2, p1, p2, a, b in zip(*(batch[c].tolist() for c in batch.columns), strict=True):
                key = (shard, -depth, w1, w2)
                if key != now:
                    if now is not None:
                        close()
                    now, parent, leaves, saved = key, (p1, p2), 0, 0
                leaves += a
                saved += b
            yield pd.DataFrame(out, columns=["depth", "w1", "w2", "n_leaves", "saved_tokens"], dtype="int64")
            out.clear()
        if now is not None:
            close()
            yield pd.DataFrame(out, columns=["depth", "w1", "w2", "n_leaves", "saved_tokens"], dtype="int64")

    return of


def _id_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (depth, w1, w2, conv_id) in order to blocks (depth, w1, w2, first, ids): runs of a node's ids as text."""
    now, first, ids, out = None, 0, [], []

    def close() -> None:
        out.append((*now, first, ",".join(map(str, ids))))

    for batch in batches:
        for depth, w1, w2, conv in zip(*(batch[c].tolist() for c in ("depth", "w1", "w2", "conv_id")), strict=True):
            key = (depth, w1, w2)
            if key != now or len(ids) == BLOCK_IDS:
                if now is not None:
                    close()
                now, first, ids = key, conv, []
            ids.append(conv)
        yield pd.DataFrame(out, columns=["depth", "w1", "w2", "first", "ids"])
        out.clear()
    if now is not None:
        close()
        yield pd.DataFrame(out, columns=["depth", "w1", "w2", "first", "ids"])


def _hashed_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks in order to (depth, w1, w2, ends_sha256): one running hash, whatever the number of ids."""
    now, digest, out = None, hashlib.sha256(), []
    for batch in batches:
        for *key, _, ids in zip(*(batch[c].tolist() for c in ("depth", "w1", "w2", "first", "ids")), strict=True):
            if key != now:
                if now is not None:
                    out.append((*now, digest.hexdigest()))
                now, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pd.DataFrame(out, columns=["depth", "w1", "w2", "ends_sha256"])
        out.clear()
    if now is not None:
        out.append((*now, digest.hexdigest()))
        yield pd.DataFrame(out, columns=["depth", "w1", "w2", "ends_sha256"])


def ends_hash(ends: DataFrame) -> DataFrame:
    """(depth, w1, w2, ends_sha256) of the conversations (depth, w1, w2, conv_id) that end at a node.

    The ids are sorted by ranges, so that those of one node may lie in many tasks, which join them to blocks
    of text. The hash itself is one stream for each node.
    """
    order = [*NODE, "conv_id"]
    ranged = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = ranged.mapInPandas(_id_blocks, "depth long, w1 long, w2 long, first long, ids string")
    placed = blocks.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return placed.mapInPandas(_hashed_blocks, "depth long, w1 long, w2 long, ends_sha256 string")


def prefix_trie(placed: DataFrame, shard_turns: int = SHARD_TURNS, queue: int = QUEUE) -> DataFrame:
    """One row for each node of the trie of ``placed`` turns (``with_root`` or ``with_shared_openings``).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (over the subtree, each node's members but one times its last text's code points) and
    ``ends_sha256`` (of the comma-joined ids of the conversations that end there).
    """
    each = cut(prefixes(placed))
    shards = max(1, -(-each.count() // shard_turns))
    shard = F.pmod(F.xxhash64(F.floor(F.col("conv_id") / NEIGHBOURS)), F.lit(shards))
    parents = (F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("chars").alias("chars"))
    local = each.groupBy(shard.alias("shard"), *NODE).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), *parents)
    nodes = local.groupBy(*NODE).agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), *parents)
    below = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("w1"), F.col("p2").alias("w2"))
        .agg(F.count("*").alias("n_children"))
    )
    nodes = cut(nodes.join(below, [*NODE], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))

    zero = F.lit(0).cast("long")
    way = (*NODE, "p1", "p2")
    copies = local.select("shard", *way, zero.alias("leaves"), zero.alias("saved"))
    own = nodes.select(
        shard.alias("shard"), *way, (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")
    )
    levels = copies.unionByName(own).repartition(shards, "shard").sortWithinPartitions("shard", F.desc("depth"), "w1", "w2")
    of_shards = levels.mapInPandas(time_forward(queue), "depth long, w1 long, w2 long, n_leaves long, saved_tokens long")

    # what is known of a node from the shards and from its ends, side by side
    ends = ends_hash(each.where("is_end"))
    empty = F.lit(None)
    parts = (
        nodes.select(*NODE, "conv_id", "p1", "p2", "n_convs", "n_children", zero.alias("n_leaves"), zero.alias("saved_tokens"), empty.cast("string").alias("ends_sha256"))
        .unionByName(of_shards, allowMissingColumns=True)
        .unionByName(ends, allowMissingColumns=True)
    )
    once = [F.max(c).alias(c) for c in ("conv_id", "p1", "p2", "n_convs", "n_children", "ends_sha256")]
    whole = parts.groupBy(*NODE).agg(*once, F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    up = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("w1").alias("p1"), F.col("w2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    )
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.join(up, ["depth", "p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
