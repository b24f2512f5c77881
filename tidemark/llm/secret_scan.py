"""Secrets in texts, also under nested encodings.

Every text is a worklist of layers.  A layer is scanned, then its URL, Unicode, HTML, base64 and compressed pieces are
decoded in place, which gives the next layer, until nothing decodes (a fixpoint) or a layer has been seen before (a
cycle).  What a layer shows is mapped back to the characters of the source that it came from.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import html
import re
import tempfile
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import short_batches
from tidemark.llm.spans import Layer

KINDS = ("assign", "access", "hex")

#: A compressed piece is unfolded EDGE bytes at a time, beyond MAX_UNFOLDED bytes into a temporary file, and its characters are read from
#: there WINDOW bytes at a time.  None of them changes what is found: a layer is scanned whole, however long it is.
MAX_UNFOLDED = 1 << 24
WINDOW, EDGE = 1 << 21, 1 << 20

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}+")

_ENCODED = re.compile(
    r"(?P<url>(?:%[0-9A-Fa-f]{2})++)"
    r"|(?P<escape>(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2})++)"
    r"|(?P<entity>(?:&\#[0-9]{1,7};|&\#[xX][0-9A-Fa-f]{1,6};|&(?:amp|quot|apos|lt|gt|equals|colon);)++)"
    r"|(?P<base64>(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)*+={0,2})"
)
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_NAMED = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", re.I | re.A)
_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]+)\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
_CONTROL = re.compile(r"[\x00-\x08\x0E-\x1F\x7F-\x9F\uFFFD]")
#: No secret, plain or encoded, has fewer characters than this in a row.
_SHOWING = re.compile(r"[^\x00-\x08\x0E-\x1F\x7F-\x9F\uFFFD]{10}")

FOUND = "array<struct<kind:string,start:int,end:int,layer:int>>"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind; those that are too short are dropped, not retried."""
    found: list[tuple[str, int, int]] = []
    if "=" in text or ":" in text:
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


class Run:
    """Lines of base64 as one run of characters, decoded from the start of any line."""

    def __init__(self, lines: list[str]):
        self.lines = [line.replace("-", "+").replace("_", "/") for line in lines]
        self.shift = [0, *accumulate(map(len, self.lines))]
        self.blank = [0] * 4  # by shift modulo 4: up to which line a reading that starts earlier showed no text

    def raw(self, first: int) -> Iterator[tuple[bytes, bytes]]:
        """For each line from ``first``: the bytes that it completes, and those that end the run if this is its last line."""
        left = ""
        for i in range(first, len(self.lines)):
            left += self.lines[i]
            whole = len(left) // 4 * 4
            out, left = base64.b64decode(left[:whole]), left[whole:]
            yield out, base64.b64decode(left + "=" * (-len(left) % 4)) if len(left) != 1 else None

    def decoded(self, first: int) -> tuple[int, str] | None:
        """How many lines from ``first`` are one piece, the most that decode, and its text; None if no line does."""
        head = base64.b64decode(self.lines[first][:4])
        if head[:2] == b"\x1f\x8b" or (head[0] == 0x78 and (head[0] << 8 | head[1]) % 31 == 0):
            found = self._unfolded(first)
            if found is not None:
                return found
        if first < self.blank[self.shift[first] % 4]:  # the same bytes again
            return None
        n, text, read = self._plain(first)
        if _is_text(text):
            return n, text
        self.blank[self.shift[first] % 4] = first + read
        return None

    def _plain(self, first: int) -> tuple[int, str, int]:
        """The longest run of lines that is UTF-8: their number, their text and how many lines were read without an error."""
        reader = codecs.getincrementaldecoder("utf-8")()
        parts: list[str] = []
        best, kept, end, n = 0, 0, "", 0
        for n, (raw, last) in enumerate(self.raw(first), 1):
            try:
                parts.append(reader.decode(raw))
            except UnicodeDecodeError:
                n -= 1
                break
            if last is not None:
                try:
                    end = (reader.getstate()[0] + last).decode("utf-8")
                    best, kept = n, len(parts)
                except UnicodeDecodeError:
                    pass
        return best, "".join(parts[:kept]) + end, n

    def _unfolded(self, first: int) -> tuple[int, str] | None:
        """The gzip members or zlib streams that begin on line ``first``, without their compression.

        A stream that breaks off shows what there is of it, up to the last line that fits.
        """
        size, fed, ends, whole, used = 0, 0, [], False, 0
        unpack = zlib.decompressobj(47)  # either header
        with tempfile.SpooledTemporaryFile(MAX_UNFOLDED) as out:

            def keep(part: bytes) -> None:
                nonlocal size
                size += len(part)
                out.write(part)

            def fed_with(raw: bytes) -> None:
                nonlocal unpack, whole, used
                while raw:
                    if unpack.eof:
                        raw = raw.lstrip(b"\0")  # padding between members
                        if not raw:
                            return
                        unpack, whole = zlib.decompressobj(47), False
                    keep(unpack.decompress(raw, EDGE))
                    while unpack.unconsumed_tail and not unpack.eof:  # after the end this is what follows the stream
                        keep(unpack.decompress(unpack.unconsumed_tail, EDGE))
                    raw = unpack.unused_data
                    if unpack.eof:
                        whole, used = True, fed - len(raw)

            last = None
            try:
                for raw, last in self.raw(first):
                    fed += len(raw)
                    fed_with(raw)
                    ends.append(fed + len(last or b""))  # the rest of its bytes may come with the next line
                if last and not whole:
                    fed += len(last)
                    fed_with(last)
                keep(unpack.flush())  # of a stream that breaks off
            except zlib.error:
                pass  # these bytes are no part of it
            if not size:
                return None
            if used:  # what follows a whole stream and is none itself belongs to no piece
                n = next((i for i, end in enumerate(ends, 1) if end >= used), len(ends) + 1)
            else:
                n = max(len(ends), 1)
            try:
                reader = codecs.getincrementaldecoder("utf-8")()
                parts = [reader.decode(part) for part in _parts(out, WINDOW)]
                text = "".join([*parts, reader.decode(b"", final=whole)])
            except UnicodeDecodeError:
                # for the next layer
                return n, "".join([base64.b64encode(part).decode() for part in _parts(out, 3 * WINDOW)])
        return (n, text) if _is_text(text) else None


def _parts(file, size: int) -> Iterator[bytes]:
    """A file from its beginning, ``size`` bytes at a time."""
    file.seek(0)
    return iter(lambda: file.read(size), b"")


def _is_text(text: str) -> bool:
    """Whether ``text`` may show something: it has no control characters, or enough others in a row."""
    return bool(text) and (not _CONTROL.search(text) or bool(_SHOWING.search(text)))


def _joined(m: re.Match) -> list[tuple[int, int, str]]:
    """One edit for each base64 piece of a run of lines; a piece goes on over line breaks as far as it decodes."""
    lines = list(_LINE.finditer(m.string, m.start(), m.end()))
    if len(lines) > 1 and (named := _NAMED.search(m.string, lines[-1].start(), m.end() + 8)) and named.start() < lines[-1].end():
        lines.pop()  # the name of what follows
    run, edits, at = Run([line.group() for line in lines]), [], 0
    while at < len(lines):
        found = run.decoded(at) if len(lines[at].group()) >= 16 else None
        if found is None:
            at += 1
            continue
        n, text = found
        end = m.end() if lines[at + n - 1].end() == len(m.group().rstrip("=")) + m.start() else lines[at + n - 1].end()
        edits.append((lines[at].start(), end, text))
        at += n
    return edits


def _code_point(m: re.Match) -> str:
    code = int(next(g for g in m.groups() if g), 16)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd"


def _surrogates_joined(text: str) -> str:
    """JSON writes one character as two escapes; joins them first."""
    def pair(m: re.Match) -> str:
        return f"\\U{0x10000 + ((int(m[1], 16) - 0xD800) << 10) + int(m[2], 16) - 0xDC00:08x}"

    return re.sub(r"\\u([dD][89abAB][0-9A-Fa-f]{2})\\u([dD][c-fC-F][0-9A-Fa-f]{2})", pair, text)


def _decoded(m: re.Match) -> Iterator[tuple[int, int, str]]:
    """The edits that one encoded run asks for: one for each of its characters, or one for each base64 piece."""
    start, run = m.start(), m.group()
    if m.lastgroup == "url":
        text = bytes.fromhex(run.replace("%", "")).decode("utf-8", "surrogateescape")
        at = start
        for c in text:
            width = 3 * len(c.encode("utf-8", "surrogateescape"))
            yield at, at + width, c if not "\udc80" <= c <= "\udcff" else "\ufffd"
            at += width
    elif m.lastgroup == "escape":
        if "\\U" in _surrogates_joined(run) and "\\U" not in run:
            yield start, m.end(), _ESCAPE.sub(_code_point, _surrogates_joined(run))
        else:
            for e in _ESCAPE.finditer(run):
                yield start + e.start(), start + e.end(), _code_point(e)
    elif m.lastgroup == "entity":
        for e in re.finditer(r"&[^;]+;", run):
            yield start + e.start(), start + e.end(), html.unescape(e.group())
    else:
        yield from _joined(m)


def next_layer(layer: Layer) -> Layer | None:
    edits = (e for m in _ENCODED.finditer(layer.text) for e in _decoded(m))
    first = next(edits, None)
    return None if first is None else layer.rewritten(chain([first], edits))


def all_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, layer) in the source; layer 0 holds the base spans, each other layer what it shows beyond them."""
    found = [(*s, 0) for s in base_spans(text)]
    known = {f[:3] for f in found}
    layer, depth, seen = Layer.source(text), 0, set()
    while (layer := next_layer(layer)) is not None:
        mark = hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if mark in seen:
            break
        seen.add(mark)
        depth += 1
        for kind, s, e in base_spans(layer.text):
            span = (kind, *layer.span(s, e))
            if span not in known:
                known.add(span)
                found.append((*span, depth))
    rank = {k: i for i, k in enumerate(KINDS)}
    return sorted(found, key=lambda x: (x[1], rank[x[0]], x[2], x[3]))


def _found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([[dict(zip(("kind", "start", "end", "layer"), s)) for s in all_spans(t or "")] for t in texts], dtype=object)


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, found) for every row of ``df``: ``found`` lists kind, start, end (code points, end exclusive) and layer.

    A null or empty text has an empty list.  Equal rows stay, each with its own result; a null id stays null; an empty
    table gives no rows; other columns are not read, whatever their names.  Texts are scanned whole, one by one.
    """
    short_batches(df.sparkSession)
    return df.select(F.col(id_col), F.pandas_udf(_found, FOUND)(F.col(text_col)).alias("found"))


def _redacted(texts: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else redacted_text(t) for t in texts], dtype=object)


def redacted_text(text: str, mark: str = "[secret]") -> str:
    """``text`` with every span, overlapping ones joined, replaced by ``mark``."""
    out, at, spans = [], 0, []
    for _, s, e, _ in all_spans(text):
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], e)
        else:
            spans.append([s, e])
    if not spans:
        return text
    for s, e in spans:
        out += [text[at:s], mark]
        at = e
    return "".join([*out, text[at:]])


def redact_secrets(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the spans in ``text_col`` replaced by a mark; every row and column stays, null texts stay null."""
    short_batches(df.sparkSession)
    return df.withColumn(text_col, F.pandas_udf(_redacted, "string")(F.col(text_col)))


__all__ = ["KINDS", "all_spans", "base_spans", "find_secrets", "redact_secrets", "redacted_text"]
