"""Exact top-k search over a bit-sliced index.

Vectors are quantised to integers.  The index cuts them into blocks; in a block each attribute is stored as slices, one bitmap over
the block's rows for each bit of its distance from the block's least (or greatest) value.  A query multiplies and adds
attributes with bitmap arithmetic only: for every set bit of a weight the attribute's slices join a column of bitmaps of
equal worth, and full adders carry from column to column until one slice is left for each bit of the score.  The best
rows are then read from the most significant slice downward; rows of equal score at the boundary go by id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed

#: Rows of a block of the index, and queries that are sent to a block together.
BLOCK_ROWS, BLOCK_QUERIES = 1 << 16, 512

INDEX = "block long, n_rows int, ids binary, least array<long>, bits array<int>, slices array<binary>"


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as long; null if the vector or a component is null or not finite."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(F.coalesce(~bad, F.lit(False)), F.transform(doubles, lambda x: F.floor(x * scale)))


def _build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One block of the index: its rows by id, and the slices of each attribute."""
    rows = rows.sort_values("id", kind="stable")
    ids = rows["id"].to_numpy(np.int64)
    width = max(map(len, rows["vector"]))
    values = np.zeros((len(ids), width), np.int64)
    for i, v in enumerate(rows["vector"]):
        values[i, :len(v)] = v
    least = values.min(axis=0)
    bits, slices = [], []
    for d in range(width):
        above = (values[:, d] - least[d]).astype(np.uint64)
        bits.append(int(above.max()).bit_length())
        slices += [np.packbits((above >> np.uint64(b) & np.uint64(1)).astype(bool)).tobytes() for b in range(bits[-1])]
    return pd.DataFrame({"block": [key[0]], "n_rows": [len(ids)], "ids": [ids.tobytes()], "least": [least], "bits": [np.array(bits, np.int32)], "slices": [slices]})


class Block:
    """A block of the index in memory; bitmaps are padded to whole 64-bit words."""

    def __init__(self, row) -> None:
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.n = len(self.ids)
        self.words = (self.n + 63) // 64
        self.rows = self._bitmap(np.packbits(np.ones(self.n, bool)).tobytes())
        self.least = [int(x) for x in row["least"]]
        slices = iter([self._bitmap(s) for s in row["slices"]])
        self.slices = [[next(slices) for _ in range(b)] for b in row["bits"]]
        self.most = [low + (1 << len(own)) - 1 for low, own in zip(self.least, self.slices)]
        self.unset = [[~x & self.rows for x in own] for own in self.slices]

    def _bitmap(self, raw: bytes) -> np.ndarray:
        padded = np.zeros(self.words * 8, np.uint8)
        padded[:len(raw)] = np.frombuffer(raw, np.uint8)
        return padded.view(np.uint64)

    def scores(self, query: list[int]) -> tuple[list[np.ndarray], int]:
        """The slices of every row's score above a common base, least significant first, and the base.

        A negative weight counts down from an attribute's greatest value, whose distances are the unset bits.
        """
        columns: list[list[np.ndarray]] = []
        base = 0
        for d, weight in enumerate(query[:len(self.slices)]):
            if not weight:
                continue
            base += weight * (self.least[d] if weight > 0 else self.most[d])
            own, weight = (self.slices[d], weight) if weight > 0 else (self.unset[d], -weight)
            for shift in range(weight.bit_length()):
                if weight >> shift & 1:
                    while len(columns) < shift + len(own):
                        columns.append([])
                    for b, bitmap in enumerate(own):
                        columns[shift + b].append(bitmap)
        at = 0
        while at < len(columns):
            column = columns[at]
            if len(column) > 1 and at + 1 == len(columns):
                columns.append([])
            while len(column) > 2:  # full adder
                x, y, z = column.pop(), column.pop(), column.pop()
                either = x ^ y
                columns[at + 1].append((x & y) | (either & z))
                either ^= z
                column.insert(0, either)
            if len(column) == 2:  # half adder
                x, y = column.pop(), column.pop()
                columns[at + 1].append(x & y)
                column.append(x ^ y)
            at += 1
        return [c[0] if c else np.zeros(self.words, np.uint64) for c in columns], base

    def best(self, slices: list[np.ndarray], k: int, own: np.ndarray | None) -> np.ndarray:
        """The rows of the ``k`` highest scores; of equal ones at the boundary those that come first."""
        tied = self.rows.copy() if own is None else self.rows & ~own
        sure, n_sure = np.zeros(self.words, np.uint64), 0
        for bitmap in reversed(slices):
            high = tied & bitmap
            n = n_sure + int(np.bitwise_count(high).sum())
            if n > k:
                tied = high
            else:
                sure |= high
                n_sure = n
                tied &= ~bitmap
                if n == k:
                    break
        else:
            rest = self._places(tied)[:k - n_sure]
            return np.concatenate([self._places(sure), rest])
        return self._places(sure)

    def _places(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), count=self.n))

    def score_at(self, slices: list[np.ndarray], base: int, places: np.ndarray) -> list[int]:
        byte, bit = places // 8, 7 - places % 8
        total = [base] * len(places)
        for worth, bitmap in enumerate(slices):
            for i, one in enumerate(bitmap.view(np.uint8)[byte] >> bit & 1):
                total[i] += int(one) << worth
        return total

    def marked(self, query_id: int) -> np.ndarray | None:
        """A bitmap of the rows with this id."""
        low, high = np.searchsorted(self.ids, [query_id, query_id + 1])
        if low == high:
            return None
        own = np.zeros(self.n, bool)
        own[low:high] = True
        return self._bitmap(np.packbits(own).tobytes())


def _search(k: int):
    def search(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int]] = []
        for _, row in index.iterrows():
            block = Block(row)
            for query_id, vector in zip(queries["query_id"], queries["vector"]):
                slices, base = block.scores([int(x) for x in vector])
                places = block.best(slices, k, block.marked(int(query_id)))
                found += [(int(query_id), int(block.ids[p]), s) for p, s in zip(places, block.score_at(slices, base, places))]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return search


def build_index(rows: DataFrame, blocks: int) -> DataFrame:
    """The index of (id, vector): a row for each of ``blocks`` blocks, to which rows are dealt by a hash of the id."""
    return (
        rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
        .groupBy("block").applyInPandas(_build, INDEX)
    )


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))


def top_k(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, every: int = 100, scale: int = 1024,
          block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` the ``k`` other rows of highest score.

    The score is the inner product of floor(``scale`` * component); components that the shorter vector lacks count as 0.
    Equal scores go to the smaller id.  Rows whose id or vector is null, or whose vector holds a null or non-finite
    component, take no part.  A query gets no row of its own id.  Repeated candidate rows are each a candidate; a
    repeated query is asked once (of different vectors of one id the least).  Fewer candidates than ``k`` give fewer rows, an
    empty table none.  Other columns are not read.

    Every block of the index meets every block of queries in a group of its own, so a group holds one block of either.
    Scores must fit a long.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), quantised(F.col(vector_col), scale).alias("vector"))
    rows = checkpointed(rows.where("id IS NOT NULL AND vector IS NOT NULL"))
    blocks = max(1, -(-rows.count() // block_rows))
    index = checkpointed(build_index(rows, blocks))
    queries = rows.where(F.pmod("id", F.lit(every)) == 0).groupBy(F.col("id").alias("query_id")).agg(F.min("vector").alias("vector"))
    queries = checkpointed(queries)
    parts = max(1, -(-queries.count() // block_queries))
    part = F.pmod(F.xxhash64("query_id"), F.lit(parts)).alias("part")
    asked = queries.select("*", part, _each(blocks).alias("block"))
    offered = index.select("*", _each(parts).alias("part"))
    found = (
        offered.groupBy("block", "part").cogroup(asked.groupBy("block", "part"))
        .applyInPandas(_search(k), "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
