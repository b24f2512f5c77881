"""Token ids of a corpus as compressed files: written in the order of the ids of documents, read in parallel.

Texts become ids once and are kept, compressed, in the shared folder.  Their frequencies over the whole corpus give one static
table for the range asymmetric numeral system of ``rans``, whose size the vocabulary bounds.  The documents are
range-sorted by id, and every partition writes one file:

    magic, blocks, directory (documents, their lengths, where blocks begin), checksum and length of the directory, magic

Only files that the manifest names count.  The manifest is a Parquet table written by Spark, one row for a piece of
a file (documents of some ``PIECE`` ids), so a task that is run twice leaves a file that nobody reads.  Reading deals the
pieces out; a piece is decoded from the checkpoint before its first id on, side by side in all of its segments.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import rans
from tidemark.llm.common import checkpointed, partitions, release, short_batches
from tidemark.plans.storage import new_folder

#: Ids a file has at most, about, and ids a piece has at least, but for a file's last one.
FILE, PIECE = 1 << 26, 1 << 22
#: Ids that are coded or decoded at a time.
AT_A_TIME = rans.BLOCKS_AT_A_TIME * rans.BLOCK
#: Characters of distinct words whose ids a Python worker remembers.
REMEMBERED = 10_000_000
#: Words sent to the tokenizer as one text.
TOGETHER = 512
#: Signs after a word that are no letters, numbers, apostrophes or part of a special token: one pre-token of their own.
ENDS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
#: Letters that end in a mark once they are composed and lowered; it joins the signs after it.
UNSTEADY = "[\u0130\u0958-\u095f\u09dc-\u09df\u0a33\u0a36\u0a59-\u0a5e\u0b5c\u0b5d\u0f43-\u0f69\ufb1d-\ufb4e]"
#: Steps before the pieces that leave words of small letters of Latin-1 as they are, but for their bytes' names.
LOWERED = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
CUT = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

_NOTHING = pa.scalar(b"", pa.large_binary())
_MAGIC = b"TDMKIDS1"
_TAIL = struct.Struct("<QI")  # length and checksum of the directory
_MANIFEST = "file bigint, path string, piece bigint, first_token bigint, n_tokens bigint, first_doc bigint, n_docs bigint"


def _ends_of(words: pa.Array, cores: pa.Array) -> pa.Array:
    """What is left of each word after its core."""
    n = pc.subtract(pc.binary_length(words), pc.binary_length(cores)).to_numpy()
    ends = np.cumsum(n)
    stops = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1)[1:]
    raw = np.frombuffer(words.buffers()[2], np.uint8)[np.repeat(stops - ends, n) + np.arange(ends[-1])]
    return pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(np.concatenate([[0], ends])), pa.py_buffer(raw))


class Words:
    """Ids of texts by a tokenizer whose pieces never cross ASCII white space; ids of words are remembered.

    Holds for tokenizers that drop white space and close the last piece of every pre-token with ``</w>``.  Signs after a word
    of letters are looked up apart from it.  Words of letters are sent many at a time and told apart by their closing pieces;
    if there are not as many as words, one by one.

    Where the tokenizer's steps are ``LOWERED``, letters of ASCII are lowered before words are looked up, but for texts with
    marks, which may join a letter, and with special tokens, which are matched as they are written.  Words of small letters
    of Latin-1 skip those steps and ``CUT``, if these are the tokenizer's.
    """

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = self.plain = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            steps = json.load(file)
        self.as_written = None
        if steps["normalizer"] == LOWERED:
            special = [re.escape(t.content) for t in self.model.get_added_tokens_decoder().values()]
            self.as_written = "(?i)" + "|".join([r"\p{M}", *special])
            if steps["pre_tokenizer"] == CUT:
                self.plain = Tokenizer(self.model.model)
                self.plain.pre_tokenizer = pre_tokenizers.Sequence([
                    pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values()) + 1
        self.type = np.dtype("<u2" if max(size, end + 1) <= 1 << 16 else "<u4")
        self.closes = np.zeros(size, bool)
        self.closes[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.end = np.array([end], self.type).tobytes()
        self.known: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        self.known.clear()
        self.known[""] = b""  # beside white space at an end of a text
        self.held = 0

    def _each(self, words: list[str]) -> None:
        for word, found in zip(words, self.model.encode_batch_fast(words, add_special_tokens=False)):
            self.known[word] = np.array(found.ids, self.type).tobytes()

    def _letters(self, words: list[str], model) -> None:
        groups = [words[i:i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        texts = [" ".join(g) for g in groups]
        for group, found in zip(groups, model.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, self.type)
            cuts = ((np.flatnonzero(self.closes[ids]) + 1) * self.type.itemsize).tolist()
            if len(cuts) != len(group):
                self._each(group)
                continue
            raw = ids.tobytes()
            self.known.update(zip(group, [raw[a:b] for a, b in zip([0, *cuts], cuts)]))

    def _learn(self, words: list[str]) -> None:
        low, letters, others = [], [], []
        for w in words:
            if w.isalpha():
                (low if w.islower() and max(w) <= "\xff" else letters).append(w)
            else:
                others.append(w)
        self._letters(low, self.plain)
        self._letters(letters, self.model)
        self._each(others)
        self.held += sum(map(len, words))

    def _looked_up(self, words: pa.Array) -> pa.Array:
        """The ids of each word, as bytes; distinct ones are looked up once."""
        coded = words.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known.get, words))
        if None in ids:
            new = [i for i, known in enumerate(ids) if known is None]
            self._learn([words[i] for i in new])
            for i in new:
                ids[i] = self.known[words[i]]
        return pa.array(ids, pa.large_binary()).take(coded.indices)

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """The ids of each text and the end id, as little-endian numbers of ``type``."""
        texts = pc.fill_null(texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()), "")
        if self.as_written:
            texts = pc.if_else(pc.match_substring_regex(texts, self.as_written), texts, pc.ascii_lower(texts))
        own = pc.ascii_split_whitespace(texts)
        coded = own.flatten().dictionary_encode()
        words = coded.dictionary
        if len(words):
            cores = pc.utf8_rtrim(words, ENDS)
            cores = pc.if_else(pc.and_not(pc.utf8_is_alpha(cores), pc.match_substring_regex(cores, UNSTEADY)), cores, words)
            words = pc.binary_join_element_wise(self._looked_up(cores), self._looked_up(_ends_of(words, cores)), _NOTHING)
        ids = words.cast(pa.large_binary()).take(coded.indices)
        raw = (ids.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
        cuts = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[own.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(own) + 1)
        if self.held > REMEMBERED:
            self._forget()
        return [raw[a:b] + self.end for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def words_of(path: str, end: int) -> Words:
    return Words(path, end)


def _encoder(path: str, end: int):
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import zstandard

        own, packer = words_of(path, end), zstandard.ZstdCompressor(level=1)
        for texts in batches:
            raw = own.encode(texts)
            size = own.type.itemsize
            yield pa.StructArray.from_arrays([
                pa.array([len(r) // size for r in raw], pa.int64()), pa.array(np.full(len(raw), size, np.int32)),
                pa.array([packer.compress(r) for r in raw], pa.binary())], ["n", "width", "packed"])

    return encoded


def encode_ids(df: DataFrame, path: str, end: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, width, packed) for every row of ``df``: its ids and ``end``, as ``width`` bytes each, packed by zstd.

    A null text counts as empty: the end id alone.  Other columns are not read.
    """
    short_batches(df.sparkSession)
    call = F.arrow_udf(_encoder(path, end), "struct<n:bigint,width:int,packed:binary>")
    return df.select(F.col(id_col).cast("bigint").alias("id"), call(F.col(text_col)).alias("__ids")).select("id", "__ids.*")


def unpacked(widths, packed) -> Iterator[np.ndarray]:
    import zstandard

    unpacker = zstandard.ZstdDecompressor()
    for width, raw in zip(widths, packed):
        yield np.frombuffer(unpacker.decompress(raw), f"<u{width}")


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How often a partition has each of its ids."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        if not len(batch):
            continue
        own = np.bincount(np.concatenate(list(unpacked(batch["width"], batch["packed"]))), minlength=len(total))
        own[:len(total)] += total
        total = own
    found = np.flatnonzero(total)
    yield pd.DataFrame({"token": found, "n": total[found]})


def frequencies(ids: DataFrame) -> np.ndarray:
    """How often each id occurs in all rows.  As long as the vocabulary, which bounds what the driver receives."""
    counted = ids.select("width", "packed").mapInPandas(_counted, "token bigint, n bigint")
    rows = counted.groupBy("token").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r["token"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        out[r["token"]] = r["n"]
    return out


def _place(uri: str):
    """The file system and path of a folder that Spark names."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "file://", 1))


class _Writer:
    """One file: ids go in document by document, blocks come out as they fill up."""

    def __init__(self, folder: str, number: int, table: rans.Table):
        self.name = f"ids-{number:06d}-{uuid.uuid4().hex}.rans"
        files, path = _place(folder)
        self.out = files.open_output_stream(f"{path}/{self.name}")
        self.out.write(_MAGIC)
        self.number, self.table, self.at = number, table, len(_MAGIC)
        self.waiting: list[np.ndarray] = []
        self.held = self.total = 0
        self.blocks: list[int] = []
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.pieces: list[tuple[int, int]] = []  # first id and first document

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        if not self.pieces or self.total - self.pieces[-1][0] >= PIECE:
            self.pieces.append((self.total, len(self.docs)))
        self.docs.append(doc)
        self.lengths.append(len(ids))
        self.total += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= AT_A_TIME:
            self._flush(self.held // rans.BLOCK * rans.BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting).astype(np.uint32)
        self.waiting, self.held = [ids[n:]], len(ids) - n
        for raw in rans.encode(ids[:n], self.table):
            self.out.write(raw)
            self.blocks.append(self.at)
            self.at += len(raw)

    def close(self) -> pd.DataFrame:
        self._flush(self.held)
        known = np.array([d is not None for d in self.docs], bool)
        docs = np.array([0 if d is None else d for d in self.docs], "<i8")
        lengths, blocks = np.array(self.lengths, "<i8"), np.array([*self.blocks, self.at], "<i8")
        parts = [zlib.compress(a.tobytes(), 1) for a in (known, docs, lengths, blocks)]
        body = struct.pack("<4Q", *map(len, parts)) + b"".join(parts)
        self.out.write(body + _TAIL.pack(len(body), zlib.crc32(body)) + _MAGIC)
        self.out.close()
        starts = [*self.pieces, (self.total, len(self.docs))]
        return pd.DataFrame([
            (self.number, self.name, i, t, u - t, d, e - d) for i, ((t, d), (u, e)) in enumerate(zip(starts, starts[1:]))
        ], columns=["file", "path", "piece", "first_token", "n_tokens", "first_doc", "n_docs"])


def _write(folder: str):
    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file = None
        for batch in batches:
            for doc, known, ids in zip(batch["id"].fillna(0).astype("int64"), batch["id"].notna(), unpacked(batch["width"], batch["packed"])):
                if file is None:
                    file = _Writer(folder, TaskContext.get().partitionId(), read_table(folder))
                file.add(int(doc) if known else None, ids)
        if file is not None:
            yield file.close()

    return written


def read_table(folder: str) -> rans.Table:
    files, path = _place(folder)
    with files.open_input_stream(f"{path}/table") as raw:
        return rans.Table.from_bytes(raw.read())


def write_ids(ids: DataFrame, folder: str) -> None:
    """Writes the rows of ``encode_ids`` to ``folder``, a new folder that all executors share, in ascending order of ids.

    A null id comes first; rows of one id come in the order in which they were read.  No rows give an empty manifest.
    """
    spark = ids.sparkSession
    ids = checkpointed(ids.withColumn("nth", F.monotonically_increasing_id()))
    counts = frequencies(ids)
    files, path = _place(folder)
    files.create_dir(path, recursive=True)
    with files.open_output_stream(f"{path}/table") as out:
        out.write(rans.table_of(counts).to_bytes())
    spread = max(partitions(spark), -(-int(counts.sum()) // FILE))
    # rows of a frequent id are told apart by nth, so that they spread over files
    ranged = ids.repartitionByRange(spread, "id", "nth").sortWithinPartitions("id", "nth")
    ranged.select("id", "width", "packed").mapInPandas(_write(folder), _MANIFEST).write.parquet(f"{folder}/manifest")
    release(spark)


class File:
    """A written file: its directory, and its ids from any place on."""

    def __init__(self, folder: str, name: str, table: rans.Table):
        files, path = _place(folder)
        self.raw, self.table = files.open_input_file(f"{path}/{name}"), table
        size, tail = self.raw.size(), _TAIL.size + len(_MAGIC)
        last = self.raw.read_at(tail, size - tail)
        length, check = _TAIL.unpack_from(last)
        body = self.raw.read_at(length, size - tail - length)
        if last[_TAIL.size:] != _MAGIC or zlib.crc32(body) != check:
            raise ValueError(f"{name}: no whole directory")
        sizes, at, parts = struct.unpack_from("<4Q", body), 32, []
        for n in sizes:
            parts.append(zlib.decompress(body[at:at + n]))
            at += n
        self.known, self.docs, self.lengths, self.blocks = (np.frombuffer(p, t) for p, t in zip(parts, (bool, "<i8", "<i8", "<i8")))

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.raw.close()

    def ids(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` to ``stop``, in parts of ``AT_A_TIME`` at most, decoded from the checkpoint before."""
        while start < stop:
            first, upto = start // rans.BLOCK, min(stop, (start // rans.BLOCK + rans.BLOCKS_AT_A_TIME) * rans.BLOCK)
            some = range(first, -(-upto // rans.BLOCK))
            raw = self.raw.read_at(int(self.blocks[some[-1] + 1] - self.blocks[first]), int(self.blocks[first]))
            cuts = self.blocks[first:some[-1] + 2] - self.blocks[first]
            blocks = [rans.Block(raw[a:b]) for a, b in zip(cuts, cuts[1:])]
            begin = first * rans.BLOCK
            segment = (start - begin) // rans.SEGMENT
            found = rans.decode(blocks, self.table, segment, -(-(upto - begin) // rans.SEGMENT))
            at = begin + segment * rans.SEGMENT
            yield found[start - at:upto - at]
            start = upto


def _read(folder: str, with_ids: bool):
    def documents(file: File, first_doc: int, n_docs: int, first_token: int, n_tokens: int) -> Iterator[tuple]:
        parts, rest = file.ids(first_token, first_token + n_tokens), np.empty(0, np.uint32)
        at = first_token
        for d in range(first_doc, first_doc + n_docs):
            need, check, kept = int(file.lengths[d]), 0, []
            while need:
                if not len(rest):
                    rest = next(parts)
                own, rest = rest[:need], rest[need:]
                need -= len(own)
                check = zlib.crc32(own.astype("<u4").tobytes(), check)
                if with_ids:
                    kept.append(own)
            n = int(file.lengths[d])
            yield int(file.docs[d]) if file.known[d] else None, at, n, check, np.concatenate(kept).astype(np.int32) if with_ids else None
            at += n

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = None
        for batch in batches:
            for row in batch.itertuples():
                table = table or read_table(folder)
                with File(folder, row.path, table) as file:
                    docs = documents(file, row.first_doc, row.n_docs, row.first_token, row.n_tokens)
                    while some := [d for _, d in zip(range(256 if with_ids else 65_536), docs)]:
                        out = pd.DataFrame(some, columns=["id", "start", "n_tokens", "ids_crc32", "ids"])
                        out["id"] = pd.array(out["id"], "Int64")
                        out["start"] += row.before
                        yield out if with_ids else out.drop(columns="ids")

    return read


def read_ids(spark: SparkSession, folder: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """(id, start, n_tokens, ids_crc32, ids) for every document in the files of ``folder``.

    ``start`` counts the ids of all documents before it, over all files; ``ids_crc32`` is over the decoded ids as
    little-endian unsigned 32-bit integers.  A file that is not whole, or ids that do not fit their checksum, raise an error.
    """
    pieces = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    files = pieces.groupBy("file").agg(F.sum("n_tokens").alias("size"))
    # one row for each file of some FILE ids
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    dealt = pieces.join(files, "file").repartition(4 * partitions(spark), F.xxhash64("file", "piece"))
    schema = "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return dealt.mapInPandas(_read(folder, with_ids), schema).withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, path: str, end: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Writes the ids of all texts to a new folder that the session shares, and reads them back (``read_ids``).

    Every row of ``df`` is a document.  Null texts have the end id alone; equal rows stay; null ids come first; an empty
    table gives no rows; other columns are not read, whatever their names.
    """
    folder = new_folder(df.sparkSession, "token-files")
    write_ids(encode_ids(df, path, end, id_col, text_col), folder)
    return read_ids(df.sparkSession, folder, id_col, with_ids)
