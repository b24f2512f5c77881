"""Periodic runs of words: stretches that repeat themselves, found by splitting at rare words and scanning lags.

A run of period q holds every one of its words at least ``REPEATS`` times.  A word that occurs fewer times within a segment can
therefore be in no run of that segment, and cuts it; the pieces are counted anew, until a piece keeps all of its words
(recursive frequency splitting).  Ordinary prose falls to pieces shorter than a run.  What survives is scanned for lags:

The lags 2**k to 2**(k+1) - 1 are scanned together.  A run of such a lag q is at least 4 * q long, so it holds an anchor, a
multiple of 2**k, whose block of 2**k words comes again q words on.  Blocks carry names (equal blocks, equal names; a block
of twice the length is a pair of names), so each anchor is compared with 2**k later names, n comparisons for a class of lags.
A hit is extended to both sides by halving steps over the same names.  So n words cost O(n log(n)**2), whatever they are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, short_batches

#: A run repeats its period at least so often, and has at least so many words.
REPEATS, SHORTEST = 4, 6
#: Comparisons of names that are held at a time.
AT_A_TIME = 1 << 20

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
FOUND = f"struct<n_words:bigint,runs:{RUNS},collapsed:string>"

_WORDS = re.compile(WORD).findall


def surviving(words: list) -> list[tuple[int, int]]:
    """(start, end) of the segments, in order, in which every word occurs ``REPEATS`` times or more."""
    open_, kept = [(0, len(words))], []
    while open_:
        start, end = open_.pop()
        if end - start < SHORTEST:
            continue
        own = words[start:end]
        rare = {w for w, n in Counter(own).items() if n < REPEATS}
        if not rare:
            kept.append((start, end))
            continue
        at = start
        for i, w in enumerate(own, start):
            if w in rare:
                if i - at >= SHORTEST:
                    open_.append((at, i))
                at = i + 1
        if end - at >= SHORTEST:
            open_.append((at, end))
    return sorted(kept)


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers from 0 that are equal where the pairs are."""
    pairs = a.astype(np.int64) << 32 | b
    return np.unique(pairs, return_inverse=True)[1].astype(np.int32)


def _block_names(codes: np.ndarray) -> list[np.ndarray]:
    """names[k][i] tells the block of 2**k words from i on."""
    names = [codes]
    while 2 << len(names) - 1 <= len(codes):
        half = 1 << len(names) - 1
        names.append(_paired(names[-1][:-half], names[-1][half:]))
    return names


def _reach(names: list[np.ndarray], at: np.ndarray, lag: np.ndarray, forward: bool) -> np.ndarray:
    """How many words from ``at`` on (or before it) equal the words ``lag`` further on."""
    n, length = len(names[0]), np.zeros(len(at), np.int64)
    for k in range(len(names) - 1, -1, -1):
        here = at + length if forward else at - length - (1 << k)
        fits = (here + lag + (1 << k) <= n) & (here >= 0)
        i = np.flatnonzero(fits)
        same = names[k][here[i]] == names[k][here[i] + lag[i]]
        length[i[same]] += 1 << k
    return length


def _scan(codes: np.ndarray) -> set[tuple[int, int, int]]:
    """(start, length, period) of every run of a segment."""
    n, names = len(codes), _block_names(codes)
    known: dict[tuple[int, int], int] = {}
    for k, name in enumerate(names):
        step = 1 << k
        if REPEATS * step > n:
            break
        anchors = np.arange(0, len(name), step)
        lags = np.arange(step, 2 * step)
        starts, shifts = [], []
        rows, before = max(1, AT_A_TIME // step), np.zeros(step, bool)
        for part in range(0, len(anchors), rows):
            own = anchors[part:part + rows, None]
            later = own + lags
            hit = (later < len(name)) & (name[own] == name[np.minimum(later, len(name) - 1)])
            heads = hit.copy()  # an anchor whose predecessor hits at the same lag is of the same stretch
            heads[1:] &= ~hit[:-1]
            heads[0] &= ~before
            before = hit[-1]
            a, q = np.nonzero(heads)
            starts.append(anchors[part + a])
            shifts.append(lags[q])
        at, lag = np.concatenate(starts), np.concatenate(shifts)
        first = at - _reach(names, at, lag, False)
        length = at + _reach(names, at, lag, True) + lag - first
        enough = length >= np.maximum(SHORTEST, REPEATS * lag)
        for s, m, q in sorted(zip(first[enough].tolist(), length[enough].tolist(), lag[enough].tolist()), key=lambda x: x[2]):
            known.setdefault((s, m), q)  # the same stretch has its smallest period first
    return {(s, m, q) for (s, m), q in known.items()}


def runs_of(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words``, by start, then period.

    A run is a stretch of smallest period q and of at least max(6, 4 * q) words that no neighbouring word extends keeping q.
    """
    found = []
    for start, end in surviving(words):
        code: dict = {}
        codes = np.fromiter((code.setdefault(w, len(code)) for w in words[start:end]), np.int32, end - start)
        found += [(start + s, m, q) for s, m, q in _scan(codes)]
    return sorted(found, key=lambda x: (x[0], x[2]))


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` without those that a run holds after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(kept)]


def _found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        rows = []
        for text in texts:
            words = _WORDS(text or "")
            runs = runs_of(words)
            rows.append((len(words), [{"start": s, "length": m, "period": q} for s, m, q in runs], " ".join(collapsed(words, runs))))
        yield pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) for every row of ``df``.

    ``runs`` holds (start, length, period) in words from 0, by start, then period; ``collapsed`` is the words that no run holds
    after its first period, joined by one space.  Words are runs of characters other than ASCII white space.  A null text
    counts as empty: no words, no runs, an empty ``collapsed``.  Equal rows stay, a null id stays null, an empty table gives
    no rows; other columns are not read, whatever their names.  Every text is read whole by one task, without a shuffle; a
    segment of n words that survives the splitting takes some 4 * n * log2(n) bytes.
    """
    short_batches(df.sparkSession)
    call = F.pandas_udf(_found, FOUND)
    return df.select(F.col(id_col), call(F.col(text_col)).alias("__found")).select(id_col, "__found.*")
