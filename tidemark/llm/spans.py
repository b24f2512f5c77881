"""A text rewritten piece by piece, with the way back to the places in the source."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable
from itertools import chain

#: Parts of a new text that are joined at a time.
PARTS = 1 << 16


class Layer:
    """A text whose pieces each came from a span of the source.

    A piece is (start in this text, start in the source, end in the source, verbatim).  Inside a verbatim piece characters
    correspond one to one; any other piece maps as a whole.
    """

    __slots__ = ("text", "starts", "pieces")

    def __init__(self, text: str, pieces: list[tuple[int, int, int, bool]]):
        self.text = text
        self.pieces = pieces
        self.starts = [p[0] for p in pieces]

    @classmethod
    def source(cls, text: str) -> "Layer":
        return cls(text, [(0, 0, len(text), True)])

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The source span of characters start..end of this text (end exclusive, not empty)."""
        at, src, src_end, same = self.pieces[bisect_right(self.starts, start) - 1]
        first = src + (start - at) if same else src
        at, src, src_end, same = self.pieces[bisect_right(self.starts, end - 1) - 1]
        last = src + (end - at) if same else src_end
        return first, last

    def rewritten(self, edits: Iterable[tuple[int, int, str]]) -> "Layer":
        """The layer with ``edits`` (start, end, new text; in order, not overlapping) applied.

        An edit's new characters all map to the edit's whole source span.  Neighbours that map to the same span are one piece.
        """
        out: list[str] = []
        pieces: list[tuple[int, int, int, bool]] = []
        size = pos = 0
        joined: list[str] = []
        for start, end, new in chain(edits, [(len(self.text), len(self.text), "")]):
            if start > pos:
                size = self._copy(pos, start, size, pieces)
                out.append(self.text[pos:start])
            if new:
                self._append((size, *self.span(start, end), False), pieces)
                out.append(new)
                size += len(new)
            if len(out) >= PARTS:
                joined.append("".join(out))
                out.clear()
            pos = end
        return Layer("".join([*joined, *out]), pieces)

    @staticmethod
    def _append(piece: tuple[int, int, int, bool], pieces: list) -> None:
        if piece[3] or not pieces or pieces[-1][1:] != piece[1:]:
            pieces.append(piece)

    def _copy(self, start: int, end: int, size: int, pieces: list) -> int:
        k = bisect_right(self.starts, start) - 1
        while start < end:
            at, src, src_end, same = self.pieces[k]
            stop = min(end, self.starts[k + 1] if k + 1 < len(self.pieces) else len(self.text))
            self._append((size, src + (start - at) if same else src, src + (stop - at) if same else src_end, same), pieces)
            size += stop - start
            start = stop
            k += 1
        return size

