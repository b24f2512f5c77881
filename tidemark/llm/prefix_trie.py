"""The prefix trie of conversations, from sorted neighbours.

Conversations are sequences of turns, told by 128-bit marks.  In sorted order, the conversations that share a prefix stand
next to each other, so a node of the trie is a stretch of conversations, and the depth at which two neighbours part is their
longest common prefix (LCP).  Conversations are range-sorted into partitions; each builds its forest by union-find over the
edges between neighbours, deepest first: components that an edge joins get a branching node at its depth.

What nodes report is a sum (or least value) over the conversations of their stretch, so forests of neighbouring partitions
need little from each other: the LCP across each boundary.  Nodes above it are shared by both sides.  A partition
sends those (a path to its first and one to its last conversation, contracted to sums) to be added up; all others are complete.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, partitions, release

#: Turns that a partition holds, about.
TURNS = 1 << 20
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, "
        "ends_sha256 string, mark binary, parent_mark binary, ends binary, place bigint")
MEASURES = ("n_convs", "n_children", "n_leaves", "saved_tokens")
OUT = ("conv_id", "depth", "parent_conv_id", *MEASURES, "ends_sha256")


def turn_sequences(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turns): the turns of each conversation in order, as structs of a mark and the code points of the text.

    Null turns come first, turns of one number in the order of their marks; null roles and texts count as empty.  Rows
    without an id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    # the role's length keeps ("ab", "c") and ("a", "bc") apart
    mark = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv"), F.struct(F.col(turn_col).alias("turn"), mark.alias("mark"), F.length(text).alias("chars")).alias("t"))
    listed = turns.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("ts"))  # texts stay behind
    return listed.select("conv", F.transform("ts", lambda t: F.struct(t["mark"].alias("mark"), t["chars"].alias("chars"))).alias("turns"))


def _expanded(first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the numbers first[i], first[i] + 1, ..., counts[i] of them; and i for each."""
    owner = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[owner] + within, owner


def common_prefixes(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The LCP of each sequence with the one before it; the first has none.  ``codes`` has a row for each turn."""
    lengths = np.diff(offsets)
    least = np.minimum(lengths[1:], lengths[:-1])
    here, owner = _expanded(offsets[1:-1], least)
    there = here - offsets[1:-1][owner] + offsets[:-2][owner]
    out = least.copy()
    parts = np.flatnonzero((codes[here] != codes[there]).any(axis=1))
    np.minimum.at(out, owner[parts], here[parts] - offsets[1:-1][owner[parts]])
    return out


class Forest:
    """The trie of sorted sequences, as a contracted tree: nodes where sequences part or end.

    ``lcp[i]`` is that of sequence i and i - 1; ``lcp[0]`` and ``after`` are those across the ends of the stretch, -1 where there
    is nothing.
    """

    def __init__(self, convs: np.ndarray, offsets: np.ndarray, chars: np.ndarray, lcp: np.ndarray, after: int):
        m, lengths = len(convs), np.diff(offsets)
        self.convs, self.lcp, self.after = convs, lcp, after
        self.sums = np.concatenate([[0], np.cumsum(chars)])
        self.offsets = offsets
        # a sequence is a leaf if none after it goes on from it or equals it
        leaf = np.append(lcp[1:], after) < lengths
        # a component's top node: depth, first sequence, number, least id, leaves, saved below, chains, children, those that end there
        self.depth, self.at = lengths.tolist(), list(range(m))
        self.n, self.least, self.leaves = [1] * m, convs.tolist(), leaf.astype(int).tolist()
        self.saved, self.children, self.ends = [0] * m, [[] for _ in range(m)], [1] * m
        up, top = list(range(m)), list(range(m))

        def root(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        deepest_first = np.argsort(-lcp[1:], kind="stable") + 1
        for i, d in zip(deepest_first.tolist(), lcp[deepest_first].tolist()):
            a, b = root(i - 1), root(i)
            joined = self._join(self._raised(top[a], d), self._raised(top[b], d))
            if a > b:
                a, b = b, a
            up[b] = a
            top[a] = joined
        self.root = self._raised(top[root(0)], 0)

    def chars(self, i: int, first: int, last: int) -> int:
        """The code points of turns ``first`` to ``last`` (from 1) of sequence i."""
        o = self.offsets[i]
        return int(self.sums[o + last] - self.sums[o + first - 1]) if last >= first else 0

    def chain(self, v: int, d: int) -> int:
        """What is saved below depth ``d`` by node v and the unbranched nodes over it.

        Nodes that a stretch shares with the one before it are counted there, so here they save all of their sequences.
        """
        out = self.saved[v] + (self.n[v] - 1) * self.chars(self.at[v], d + 1, self.depth[v])
        if self.at[v] == 0 and self.lcp[0] > d:
            out += self.chars(0, d + 1, min(self.depth[v], int(self.lcp[0])))
        return out

    def _raised(self, v: int, d: int) -> int:
        """The node of depth ``d`` over v."""
        if self.depth[v] == d:
            return v
        self.depth.append(d)
        for values in (self.at, self.n, self.least, self.leaves):
            values.append(values[v])
        self.saved.append(self.chain(v, d))
        self.children.append([v])
        self.ends.append(0)
        return len(self.depth) - 1

    def _join(self, a: int, b: int) -> int:
        """One node of two of the same depth, the stretch of a before that of b."""
        self.n[a] += self.n[b]
        self.least[a] = min(self.least[a], self.least[b])
        self.leaves[a] += self.leaves[b]
        self.saved[a] += self.saved[b]
        self.children[a] += self.children[b]
        self.ends[a] += self.ends[b]
        return a

    def rows(self, place: int, marks) -> Iterator[tuple]:
        """All nodes; ``marks(i, d)`` tells the node of depth d of sequence i, for nodes that other stretches share."""
        m = len(self.convs)
        shared_left, shared_right = int(self.lcp[0]), int(self.after)
        stack = [(self.root, -1, None, None)]
        while stack:
            v, above, parent, parent_mark = stack.pop()
            i, n, least, leaves, deep = self.at[v], self.n[v], self.least[v], self.leaves[v], self.depth[v]
            last = i + n - 1
            for d in range(above + 1, deep + 1):
                left, right = i == 0 and d <= shared_left, last == m - 1 and d <= shared_right
                mark = marks(0 if left else m - 1, d) if left or right else None
                own = [int(c) for c in self.convs[i:i + self.ends[v]]] if d == deep else []  # those that end stand first
                told = ",".join(map(str, own)).encode()
                under = len(self.children[v]) if d == deep else 1
                if i == 0 and d < shared_left:
                    under -= 1  # the first child is counted by the stretch before
                # the root has no text
                saved = self.chain(v, d - 1) if d else self.saved[v]
                ends = None if mark is not None else hashlib.sha256(told).hexdigest() if own else EMPTY
                yield (least, d, parent, n, under, leaves, saved, ends, mark,
                       parent_mark if parent is None else None, told if mark is not None and own else None, place)
                parent, parent_mark = (least, None) if mark is None else (None, mark)
            for c in self.children[v]:
                stack.append((c, deep, parent, parent_mark))


def _nodes(batches: Iterator) -> Iterator:
    """The nodes of one partition of sorted sequences."""
    import pyarrow as pa

    convs, lengths, marks, chars, place, before, after = [], [], [], [], None, -1, -1
    for batch in batches:
        if not batch.num_rows:
            continue
        if place is None:
            place, before, after = (batch[c][0].as_py() for c in ("place", "before", "after"))
        seqs, sizes = batch["marks"], batch["chars"]
        convs.append(batch["conv"].to_numpy(zero_copy_only=False))
        lengths.append(np.diff(seqs.offsets.to_numpy()))
        raw = b"".join(seqs.flatten().to_pylist())
        marks.append(np.frombuffer(raw, "V16"))
        chars.append(sizes.flatten().to_numpy(zero_copy_only=False))
    if place is None:
        return
    marks = np.concatenate(marks)
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
    lcp = np.concatenate([[before], common_prefixes(marks.view(np.uint64).reshape(-1, 2), offsets)])
    forest = Forest(np.concatenate(convs), offsets, np.concatenate(chars).astype(np.int64), lcp, after)
    told: dict[int, list[bytes]] = {}

    def mark(i: int, d: int) -> bytes:
        """A mark of the first d turns of sequence i: marks of prefixes are chained."""
        known = told.setdefault(i, [b"\0" * 16])
        while len(known) <= d:
            known.append(hashlib.blake2b(known[-1] + marks[offsets[i] + len(known) - 1].tobytes(), digest_size=16).digest())
        return known[d]

    types = [pa.int64()] * 7 + [pa.string()] + [pa.binary()] * 3 + [pa.int64()]
    names = [*OUT[:7], "ends_sha256", "mark", "parent_mark", "ends", "place"]
    rows = []
    for row in forest.rows(place, mark):
        rows.append(row)
        if len(rows) == 16_384:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _hashed_ends(batches: Iterator) -> Iterator:
    """One row for each mark: the hash of its lists of ids, which come in order.  Holds one list at a time."""
    import pandas as pd

    now, state = None, None
    for batch in batches:
        done = []
        for mark, told in zip(batch["mark"], batch["ends"]):
            mark = bytes(mark)
            if mark == now:
                state.update(b"," + bytes(told))
                continue
            if now is not None:
                done.append((now, state.hexdigest()))
            now, state = mark, hashlib.sha256(bytes(told))
        yield pd.DataFrame(done, columns=["mark", "ends_sha256"])
    if now is not None:
        yield pd.DataFrame([(now, state.hexdigest())], columns=["mark", "ends_sha256"])


def trie(sequences: DataFrame) -> DataFrame:
    """All nodes of the prefix trie of ``sequences`` (conv, turns: structs of ``mark``, 16 bytes, and ``chars``).

    Per node: ``conv_id``, the smallest of the conversations that begin with it; ``depth``; ``parent_conv_id`` (null for the root);
    ``n_convs``, ``n_children``, ``n_leaves``; ``saved_tokens``, summed over its subtree, (n_convs - 1) times the code points of its last
    text; ``ends_sha256`` over the ids that end there, ascending.  Conversations without turns end at the root; no
    conversations give no rows.  A conversation is held whole by a task, as marks; a partition's are held together.
    """
    spark = sequences.sparkSession
    flat = checkpointed(sequences.select("conv", F.col("turns.mark").alias("marks"), F.col("turns.chars").alias("chars")))
    turns = flat.agg(F.sum(F.size("marks")).alias("n")).first()["n"] or 0
    spread = max(partitions(spark), -(-turns // TURNS))
    # the id tells copies apart, so that a large group of them spreads over partitions
    ranged = flat.repartitionByRange(spread, "marks", "conv").sortWithinPartitions("marks", "conv")
    ranged = checkpointed(ranged.withColumn("place", F.spark_partition_id().cast("bigint")))
    both_ends = ranged.groupBy("place").agg(F.min(F.struct("marks", "conv"))["marks"].alias("first"), F.max(F.struct("marks", "conv"))["marks"].alias("last"))
    bounds = checkpointed(_boundaries(both_ends))
    # one row of three numbers for each partition
    placed = ranged.join(F.broadcast(bounds), "place")
    nodes = checkpointed(placed.select("place", "before", "after", "conv", "marks", "chars").mapInArrow(_nodes, NODE))
    release(spark)

    shared = nodes.where("mark IS NOT NULL")
    merged = shared.groupBy("mark").agg(
        F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.first("parent_mark").alias("parent_mark"),
        *[F.sum(c).alias(c) for c in MEASURES])
    lists = shared.where("ends IS NOT NULL").select("mark", "place", "ends")
    lists = lists.repartition("mark").sortWithinPartitions("mark", "place")
    hashed = lists.select("mark", "ends").mapInPandas(_hashed_ends, "mark binary, ends_sha256 string")
    merged = checkpointed(merged.join(hashed, "mark", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))))
    parents = merged.select(F.col("mark").alias("parent_mark"), F.col("conv_id").alias("found"))

    below = nodes.where("mark IS NULL AND parent_mark IS NOT NULL").select(*OUT, "parent_mark")
    open_ = merged.select("conv_id", "depth", F.lit(None).cast("bigint").alias("parent_conv_id"), *MEASURES, "ends_sha256", "parent_mark")
    looked_up = below.unionByName(open_).join(parents, "parent_mark", "left").withColumn("parent_conv_id", F.col("found"))
    return nodes.where("mark IS NULL AND parent_mark IS NULL").select(*OUT).unionByName(looked_up.select(*OUT))


def _boundaries(both_ends: DataFrame) -> DataFrame:
    """(place, before, after): the LCP with the last sequence of the partition before and the first of the next, -1 where none is."""
    in_order = Window.orderBy("place")  # two sequences for each partition
    near = both_ends.select("place", "first", "last", F.lag("last").over(in_order).alias("left"), F.lead("first").over(in_order).alias("right"))

    def lcp(a: Column, b: Column) -> Column:
        pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
        differs = F.transform(pairs, lambda p: F.coalesce(p["a"] != p["b"], F.lit(True)))
        at = F.array_position(differs, True)
        return F.when(a.isNull() | b.isNull(), F.lit(-1)).when(at > 0, at - 1).otherwise(F.size(a)).cast("bigint")

    return near.select("place", lcp(F.col("left"), F.col("first")).alias("before"), lcp(F.col("last"), F.col("right")).alias("after"))


def conversation_trie(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The prefix trie (``trie``) of the conversations of a table of turns (``turn_sequences``); other columns are not read."""
    return trie(turn_sequences(df, id_col, turn_col, role_col, text_col))
