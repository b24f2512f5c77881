"""Byte-level BPE through a sentencepiece model that is written straight from the vocabulary.

A vocabulary of byte strings and ranks becomes a sentencepiece BPE model: every byte is mapped to a visible character, a
piece's score is its negative rank (the highest score merges first, as the lowest rank does), and normalisation is the
identity.  Texts are cut into pre-tokens by the vocabulary's pattern, every pre-token is encoded by the model, and ids are
decoded by the inverse mapping.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import short_batches

ENCODED = "struct<ids:array<int>,n_tokens:bigint,ids_sha256:string,decoded_sha256:string,round_trip:boolean>"

#: Characters of distinct pre-tokens whose ids a Python worker remembers; beyond that it starts afresh.
REMEMBERED = 4_000_000


def byte_characters() -> list[str]:
    """A visible character for each byte: itself where Latin-1 prints it, else one from U+0100 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        out.append(chr(b if b in shown else spare))
        spare += b not in shown
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    """The ``base64 rank`` lines of a vocabulary file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised model: piece i is the byte string of rank i, the last piece is the unknown one."""
    characters = byte_characters()
    out = bytearray()
    by_rank = sorted(ranks.items(), key=lambda x: x[1])
    if [r for _, r in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must run from 0 without gaps")
    for raw, rank in by_rank:  # ModelProto.pieces = 1: piece = 1, score = 2, type = 3
        text = "".join(characters[b] for b in raw).encode()
        out += _block(1, _block(1, text) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank)))
    out += _block(1, _block(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, 2))
    unknown = len(by_rank)
    trainer = _number(3, 2) + _number(4, unknown + 1) + _number(40, unknown)  # BPE, vocabulary size, unknown id
    trainer += b"".join(_varint(f << 3) + _varint((1 << 64) - 1) for f in (41, 42, 43))  # no begin, end and padding ids
    normalizer = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return bytes(out + _block(2, trainer) + _block(3, normalizer))


class Codec:
    """Encodes and decodes with one vocabulary and pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        import regex
        from sentencepiece import SentencePieceProcessor

        ranks = read_ranks(path)
        self.cut = regex.compile(pattern).findall
        self.model = SentencePieceProcessor(model_proto=sentencepiece_model(ranks))
        self.shown = {b: c for b, c in enumerate(byte_characters())}
        back = {c: b for b, c in self.shown.items()}
        self.bytes_of = [bytes(back[c] for c in self.model.id_to_piece(i)) for i in range(len(ranks))]
        self.whole = ranks  # a pre-token that is itself a piece needs no merges
        self.known: dict[str, bytes] = {}
        self.held = 0

    def learn(self, tokens: list[str]) -> None:
        """Remembers the ids of pre-tokens, four bytes each."""
        for token in tokens:
            raw = token.encode("utf-8", "surrogatepass")
            rank = self.whole.get(raw)
            ids = [rank] if rank is not None else self.model.encode(raw.decode("latin-1").translate(self.shown))
            self.known[token] = struct.pack(f"={len(ids)}I", *ids)
        self.held += sum(map(len, tokens))

    def encode(self, text: str) -> array:
        tokens = self.cut(text)
        if new := set(tokens).difference(self.known):
            self.learn(list(new))
        ids = array("I")
        ids.frombytes(b"".join([self.known[t] for t in tokens]))
        if self.held > REMEMBERED:
            self.known.clear()
            self.held = 0
        return ids

    def decode(self, ids: array) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _encoder(path: str, pattern: str, with_ids: bool):
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(path, pattern)
        for texts in batches:
            rows = []
            for t in texts:
                text = t or ""
                ids = own.encode(text)
                raw = own.decode(ids)
                little = ids
                if sys.byteorder == "big":
                    little = ids[:]
                    little.byteswap()
                rows.append((
                    list(ids) if with_ids else None,
                    len(ids),
                    hashlib.sha256(little.tobytes()).hexdigest(),
                    hashlib.sha256(raw).hexdigest(),
                    raw == text.encode("utf-8", "surrogatepass"),
                ))
            yield pd.DataFrame(rows, columns=["ids", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])

    return encoded


def encode_texts(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 with_ids: bool = True) -> DataFrame:
    """(id, ids, n_tokens, ids_sha256, decoded_sha256, round_trip) for every row of ``df``.

    ``ids_sha256`` is over the ids as little-endian unsigned 32-bit integers, ``decoded_sha256`` over the bytes decoded
    from them.  A null text counts as empty: no ids.  Equal rows stay; a null id stays null; an empty table gives no rows;
    other columns are not read, whatever their names.  ``path`` must be readable on every executor.
    """
    short_batches(df.sparkSession)
    call = F.pandas_udf(_encoder(path, pattern, with_ids), ENCODED)
    return df.select(F.col(id_col), call(F.col(text_col)).alias("__encoded")).select(id_col, "__encoded.*")


def decode_ids(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``df`` with ``out_col``: the text of the ids (bytes that are no UTF-8 become U+FFFD); null ids give null."""
    short_batches(df.sparkSession)

    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for ids in batches:
            yield pd.Series([None if i is None else own.decode(array("I", i)).decode("utf-8", "replace") for i in ids], dtype=object)

    return df.withColumn(out_col, F.pandas_udf(decoded, "string")(F.col(ids_col)))
