"""Static range asymmetric numeral system over token ids, many lanes at a time.

One table of frequencies, which add up to a power of two, serves all blocks.  A block of up to ``BLOCK`` ids is coded by
``LANES`` interleaved states: lane i holds the ids i, i + LANES, ... of the block.  Coding runs backwards, so that decoding
runs forwards; a state is 64 bits and gives up 32 of them whenever it would outgrow them.  At every ``SEGMENT`` ids the
states and the place in the stream are kept as a checkpoint, where decoding can begin.  Blocks are independent: numpy codes
many of them side by side, and decodes all segments of all blocks side by side.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass
from functools import cached_property

import numpy as np

LANES = 32
SEGMENT = 256 * LANES
BLOCK = 8 * SEGMENT
#: Blocks coded side by side.
BLOCKS_AT_A_TIME = 32
LOW = 31  # a state is 2**31 at least
_MAGIC = b"TDMKTAB1"
_HEAD = struct.Struct("<IIII")  # ids, words, segments, checksum of the ids


@dataclass(frozen=True)
class Table:
    """Frequencies of all ids, 0 where an id never occurs; their sum is 2**bits."""

    bits: int
    frequencies: np.ndarray

    @cached_property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.frequencies)[:-1]]).astype(np.uint64)

    @cached_property
    def wide(self) -> np.ndarray:
        return self.frequencies.astype(np.uint64)

    @cached_property
    def id_at(self) -> np.ndarray:
        """The id of every slot."""
        return np.repeat(np.arange(len(self.frequencies), dtype=np.uint32), self.frequencies)

    def to_bytes(self) -> bytes:
        body = zlib.compress(self.frequencies.astype("<u4").tobytes())
        return _MAGIC + struct.pack("<III", self.bits, len(body), zlib.crc32(body)) + body

    @staticmethod
    def from_bytes(raw: bytes) -> Table:
        bits, size, check = struct.unpack_from("<III", raw, len(_MAGIC))
        body = raw[len(_MAGIC) + 12:]
        if raw[:len(_MAGIC)] != _MAGIC or len(body) != size or zlib.crc32(body) != check:
            raise ValueError("not a whole frequency table")
        return Table(bits, np.frombuffer(zlib.decompress(body), "<u4"))


def table_of(counts: np.ndarray) -> Table:
    """The table of how often each id occurs.  Every id that occurs gets a slot, the others in proportion."""
    counts = np.asarray(counts, np.int64)
    present = int((counts > 0).sum())
    bits = max(12, (max(present, 1) - 1).bit_length() + 4)
    spare = (1 << bits) - present
    total = max(int(counts.sum()), 1)
    share = np.array([int(c) * spare // total for c in counts], np.int64)  # whole numbers: no product is too large
    out = np.where(counts > 0, 1 + share, 0)
    if present:
        out[int(np.argmax(counts))] += (1 << bits) - int(out.sum())
    return Table(bits, out.astype(np.uint32))


def _coded(ids: np.ndarray, n: int, table: Table) -> list[bytes]:
    """Blocks of n ids each, the rows of ``ids``, coded side by side."""
    blocks = len(ids)
    steps = -(-n // LANES)
    padded = np.full((blocks, steps * LANES), ids[0, 0], np.uint32)  # what fills the last step is cut off on decoding
    padded[:, :n] = ids
    turns = np.ascontiguousarray(padded.reshape(blocks, steps, LANES).swapaxes(0, 1)).reshape(steps, -1)
    frequency, start = table.wide[turns], table.starts[turns]
    bits, room, word = np.uint64(table.bits), np.uint64(63 - table.bits), np.uint64(32)
    x = np.full(blocks * LANES, 1 << LOW, np.uint64)
    words = np.empty(turns.shape, np.uint32)
    gives = np.empty(turns.shape, bool)
    per = SEGMENT // LANES
    points = -(-steps // per)
    states = np.empty((points, blocks * LANES), np.uint64)
    for t in range(steps - 1, -1, -1):
        f = frequency[t]
        full = np.greater_equal(x, f << room, out=gives[t])
        words[t] = x.astype(np.uint32)
        x = np.where(full, x >> word, x)
        q = x // f
        x = (q << bits) + (x - q * f) + start[t]
        if t % per == 0:
            states[t // per] = x
    out = []
    gives, words = gives.reshape(steps, blocks, LANES), words.reshape(steps, blocks, LANES)
    for b in range(blocks):
        own = gives[:, b]
        before = np.concatenate([[0], np.cumsum(own.sum(axis=1))])
        stream = words[:, b][own]
        head = _HEAD.pack(n, len(stream), points, zlib.crc32(ids[b].astype("<u4").tobytes()))
        marks = before[np.arange(points) * per].astype("<u4").tobytes() + states[:, b * LANES:(b + 1) * LANES].astype("<u8").tobytes()
        out.append(head + struct.pack("<I", zlib.crc32(marks)) + marks + stream.astype("<u4").tobytes())
    return out


def encode(ids: np.ndarray, table: Table) -> list[bytes]:
    """The blocks of ``ids``, all of ``BLOCK`` ids but the last."""
    whole = len(ids) // BLOCK
    out = []
    for at in range(0, whole, BLOCKS_AT_A_TIME):
        some = ids[at * BLOCK:min(whole, at + BLOCKS_AT_A_TIME) * BLOCK]
        out += _coded(some.reshape(-1, BLOCK), BLOCK, table)
    if len(ids) > whole * BLOCK:
        out += _coded(ids[None, whole * BLOCK:], len(ids) - whole * BLOCK, table)
    return out


class Block:
    """A coded block: its checkpoints and its stream of words."""

    def __init__(self, raw: bytes):
        self.n, words, points, self.check = _HEAD.unpack_from(raw)
        (check,) = struct.unpack_from("<I", raw, _HEAD.size)
        at = _HEAD.size + 4
        marks = raw[at:at + points * (4 + 8 * LANES)]
        if zlib.crc32(marks) != check or len(raw) != at + len(marks) + 4 * words:
            raise ValueError("damaged block")
        self.places = np.frombuffer(marks, "<u4", points)
        self.states = np.frombuffer(marks, "<u8", points * LANES, 4 * points).reshape(points, LANES)
        self.words = np.frombuffer(raw, "<u4", words, at + len(marks))


def decode(blocks: list[Block], table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of ``blocks``, one after the other, all segments decoded side by side.

    Only segments ``first`` to ``last`` (all, counted over the blocks in order; all blocks but the last are full) are read.  A
    block that is read whole is held against its checksum.
    """
    if not blocks:
        return np.empty(0, np.uint32)
    stream = np.concatenate([b.words for b in blocks] + [np.zeros(1, np.uint32)]).astype(np.uint64)
    offsets = np.cumsum([0] + [len(b.words) for b in blocks[:-1]])
    lengths, states, places, cuts = [], [], [], []
    at = 0
    for b, offset in zip(blocks, offsets):
        for s in range(len(b.places)):
            if at >= first and (last is None or at < last):
                lengths.append(min(SEGMENT, b.n - s * SEGMENT))
                states.append(b.states[s])
                places.append(int(b.places[s]) + int(offset))
            at += 1
        cuts.append(at)
    if not lengths:
        return np.empty(0, np.uint32)
    x, place = np.array(states, np.uint64), np.array(places, np.int64)
    lengths = np.array(lengths)
    steps = -(-int(lengths.max()) // LANES)
    out = np.empty((steps, len(x), LANES), np.uint32)
    bits, mask, low = np.uint64(table.bits), np.uint64((1 << table.bits) - 1), np.uint64(1 << LOW)
    for t in range(steps):
        slot = x & mask
        found = table.id_at[slot]
        out[t] = found
        x = table.wide[found] * (x >> bits) + slot - table.starts[found]
        lacks = x < low
        nth = np.cumsum(lacks, axis=1)
        where = np.minimum(place[:, None] + nth - 1, len(stream) - 1)  # a segment that has ended reads what is cut off below
        x = np.where(lacks, x << np.uint64(32) | stream[np.maximum(where, 0)], x)
        place = place + nth[:, -1]
    rows = out.swapaxes(0, 1).reshape(len(x), -1)
    ids = rows.ravel() if (lengths == rows.shape[1]).all() else np.concatenate([r[:m] for r, m in zip(rows, lengths)])
    begin, done = 0, 0
    for b, cut in zip(blocks, cuts):
        if begin >= first and (last is None or cut <= last):
            if zlib.crc32(ids[done:done + b.n].astype("<u4").tobytes()) != b.check:
                raise ValueError("damaged block")
            done += b.n
        else:
            done += int(sum(min(SEGMENT, b.n - (s - begin) * SEGMENT) for s in range(max(first, begin), cut if last is None else min(last, cut))))
        begin = cut
    return ids
