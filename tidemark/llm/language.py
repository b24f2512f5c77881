"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.  The probability of a word is the sum over
all ways to cut it into pieces, by the forward algorithm; a text's is the product over its words.  Piece
probabilities are fitted by expectation-maximisation over distinct words and their counts, with Spark adding up what each
word expects.  The fit uses a bounded sample of labelled texts; every text is scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, short_batches

#: Labelled texts of a language that the fit uses, about; which ones follows from a hash of their ids.
SAMPLED = 2000
ROUNDS = 3
#: Weight, in expected pieces, of the uniform distribution that every language's pieces are smoothed with.
SMOOTHING = 200.0
#: Probability of a single character that the vocabulary lacks, in every language.
UNSEEN = 1e-7
LONGEST = 16
#: Words of more characters than this are scored with rescaling, and fitted part by part.
SHORT_WORD = 24
WORDS_AT_ONCE = 8192
#: Characters of distinct words whose scores a Python worker remembers.
REMEMBERED = 3_000_000

_WORDS = re.compile(r"[^\W\d_]+").findall


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict[str, int]:
    """Pieces of a sentencepiece model that are text, in lower case, with the mark of a word's start."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    kept: dict[str, int] = {}
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            piece = model.id_to_piece(i).lower()
            if len(piece) <= LONGEST:
                kept.setdefault(piece, len(kept))
    return kept


class Pieces:
    """Finds the pieces inside many words of one length at a time, by rolling hashes of their characters."""

    TABLE = 20

    def __init__(self, path: str) -> None:
        self.size = len(vocabulary(path))  # this number stands for an unknown character, the next one for no piece
        self.longest = max(map(len, vocabulary(path)), default=1)
        self.key = np.zeros(1 << self.TABLE, np.uint64)
        self.piece = np.full(1 << self.TABLE, self.size + 1, np.int32)
        self.probes = 1
        for piece, i in vocabulary(path).items():
            h = np.zeros(1, np.uint64)
            for c in piece:
                h = self._rolled(h, np.uint32(ord(c)))
            at = self._place(h)
            probes = 1
            while self.piece[at[0]] <= self.size:
                at = (at + 1) & ((1 << self.TABLE) - 1)
                probes += 1
            self.key[at[0]], self.piece[at[0]] = h[0], i
            self.probes = max(self.probes, probes)

    @staticmethod
    def _rolled(h: np.ndarray, c: np.ndarray) -> np.ndarray:
        h = (h + c + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))

    def _place(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.TABLE)).astype(np.int64)

    def _found(self, h: np.ndarray) -> np.ndarray:
        at = self._place(h)
        out = np.where(self.key[at] == h, self.piece[at], self.size + 1)
        for _ in range(self.probes - 1):
            at = (at + 1) & ((1 << self.TABLE) - 1)
            out = np.where(self.key[at] == h, self.piece[at], out)
        return out

    def inside(self, codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(start, end, piece of each word) for every part of the words (a row of characters each), by start."""
        n = codes.shape[1]
        for start in range(n):
            h = np.zeros(len(codes), np.uint64)
            for end in range(start + 1, min(n, start + self.longest) + 1):
                h = self._rolled(h, codes[:, end - 1])
                piece = self._found(h)
                if end == start + 1:
                    piece = np.where(piece > self.size, self.size, piece)
                yield start, end, piece


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def _by_length(some: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, characters) of the words of each length, ``WORDS_AT_ONCE`` at most."""
    lengths = np.array([len(w) for w in some])
    for n in np.unique(lengths):
        of_length = np.flatnonzero(lengths == n)
        for part in range(0, len(of_length), WORDS_AT_ONCE):
            at = of_length[part:part + WORDS_AT_ONCE]
            yield at, np.frombuffer("".join([some[i] for i in at]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(at), n)


def words(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    found = _WORDS(text.lower())
    if all(map(str.isalpha, found)):
        return found
    # \w also holds fractions, superscripts and letter-like numerals
    return [part for w in found for part in "".join([c if c.isalpha() else " " for c in w]).split()]


@dataclass
class Model:
    """``probability[piece, language]``; the last two rows are for characters that the vocabulary lacks, and for no piece."""

    path: str
    languages: list[str]
    probability: np.ndarray
    prior: np.ndarray
    known: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.scores = np.zeros((0, len(self.languages)))
        self.used = 0
        self.held = 0

    def forward(self, some: list[str]) -> np.ndarray:
        """The log probability of each word in each language, summed over all segmentations."""
        pieces = pieces_of(self.path)
        out = np.zeros((len(some), len(self.languages)))
        ring = pieces.longest + 1
        for at, codes in _by_length(["▁" + w for w in some]):
            n = codes.shape[1]
            reach = np.zeros((ring, len(at), len(self.languages)))
            reach[0] = 1.0
            scale, last = np.zeros(reach.shape[1:]), 0
            for start, end, piece in pieces.inside(codes):
                if start != last:
                    reach[last % ring] = 0.0
                    last = start
                    if n > SHORT_WORD and start % 8 == 0:  # against underflow
                        top = reach.max(axis=0)
                        reach /= top
                        scale += np.log(top)
                reach[end % ring] += reach[start % ring] * self.probability[piece]
            out[at] = np.log(reach[n % ring]) + scale
        return out

    def learn(self, new: list[str]) -> None:
        """Remembers the scores of words."""
        if self.used + len(new) > len(self.scores):
            more = max(len(new), len(self.scores), 4096)
            self.scores = np.concatenate([self.scores, np.zeros((more, len(self.languages)))])
        self.scores[self.used:self.used + len(new)] = self.forward(new)
        self.known.update(zip(new, range(self.used, self.used + len(new))))
        self.used += len(new)
        self.held += sum(map(len, new))

    def predict(self, texts: Sequence[str | None]) -> list[tuple[str, float]]:
        """The likeliest language of each text and its posterior; ``und`` and 0 without a letter or a learned language."""
        owns = [words(t) if t and self.languages else [] for t in texts]
        every = set().union(*owns)
        new = every.difference(self.known)
        if new and self.held > REMEMBERED:
            self.known.clear()
            self.used, self.held, new = 0, 0, every
        if new:
            self.learn(sorted(new))
        out = []
        for own in owns:
            if not own:
                out.append(("und", 0.0))
                continue
            logs = self.scores[[self.known[w] for w in own]].sum(axis=0) + np.log(self.prior)
            best = int(np.argmax(logs))  # the first of equal ones
            out.append((self.languages[best], float(1.0 / np.exp(np.minimum(logs - logs[best], 0.0)).sum())))
        return out


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            counts = Counter()
            for t in texts:
                counts.update(words(t))
            yield pd.DataFrame({"lang": lang, "word": list(counts.keys()), "times": list(counts.values())})


def _expected(path: str, languages: list[str], probability: np.ndarray | None):
    """Expected piece counts of each batch's words, by forward and backward sums in the word's own language."""
    def expected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = pieces_of(path)
        column = {lang: i for i, lang in enumerate(languages)}
        if probability is None:  # the first round takes all pieces to be as likely
            chance = np.full((pieces.size + 2, len(languages)), 1e-3)
            chance[-2:] = [[UNSEEN], [0.0]]
        else:
            chance = probability
        total = np.zeros(chance.size)

        def add(own: list[int], times: list[int], some: list[str]) -> None:
            own, times = np.array(own, np.int64), np.array(times, float)
            for at, codes in _by_length(some):
                mine = own[at]
                parts = []
                for start, end, piece in pieces.inside(codes):
                    row = np.flatnonzero(piece <= pieces.size)
                    parts.append((start, end, row, piece[row] * len(languages) + mine[row]))
                weights = [chance.ravel()[cell] for *_, cell in parts]
                ahead = np.zeros((codes.shape[1] + 1, len(at)))
                behind = np.zeros_like(ahead)
                ahead[0] = behind[-1] = 1.0
                for (start, end, row, _), weight in zip(parts, weights):
                    ahead[end, row] += ahead[start, row] * weight
                for (start, end, row, _), weight in zip(reversed(parts), reversed(weights)):
                    behind[start, row] += behind[end, row] * weight
                share = times[at] / ahead[-1]
                for (start, end, row, cell), weight in zip(parts, weights):
                    np.add.at(total, cell, ahead[start, row] * weight * behind[end, row] * share[row])

        own, times, some = [], [], []
        for batch in batches:
            for lang, word, n in zip(batch["lang"], batch["word"], batch["times"]):
                for begin in range(0, len(word), SHORT_WORD):  # a run of letters without end is fitted part by part
                    some.append(("▁" if begin == 0 else "") + word[begin:begin + SHORT_WORD])
                    own.append(column[lang])
                    times.append(n)
            if len(some) >= 8 * WORDS_AT_ONCE:
                add(own, times, some)
                own, times, some = [], [], []
        add(own, times, some)
        sums = total.reshape(chance.shape)[:pieces.size]
        piece, lang = np.nonzero(sums)
        yield pd.DataFrame({"own": lang, "piece": piece, "n": sums[piece, lang]})

    return expected


def learnable(id_col: str) -> Column:
    """Whether a document may be learned from: crc32(id) mod 3 is not 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 != 1, F.lit(False))


def held_out(id_col: str) -> Column:
    """Whether a document is kept for checks: crc32(id) mod 3 is 1.  A null id is neither learned from nor held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sampled: int = SAMPLED,
        rounds: int = ROUNDS) -> Model:
    """A model of the languages of ``df``, learned from the rows that ``learnable`` allows and whose language is not null.

    Of a language with more than ``sampled`` such texts, about that many take part, by a hash of their ids.  What
    reaches the driver is at most a number for each piece of the vocabulary and language.
    """
    short_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(learnable("id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row a language
    languages = sorted(counts)
    path = str(path)
    size = len(vocabulary(path))
    if not languages:
        return Model(path, [], np.zeros((size + 2, 0)), np.zeros(0))
    share = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, sampled / n)))])
    drawn = F.pmod(F.xxhash64(F.lit("language"), "id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)
    told = rows.where(drawn).select("lang", "text").mapInPandas(_counted, "lang string, word string, times long")
    told = checkpointed(told.groupBy("lang", "word").agg(F.sum("times").alias("times")))
    probability = None
    for _ in range(rounds):
        sums = told.mapInPandas(_expected(path, languages, probability), "own int, piece int, n double")
        sums = sums.groupBy("own", "piece").agg(F.sum("n").alias("n")).toPandas()
        n = np.zeros((size + 2, len(languages)))
        n[sums["piece"], sums["own"]] = sums["n"]
        probability = (n + SMOOTHING / size) / (n.sum(axis=0) + SMOOTHING)
        probability[-2:] = [[UNSEEN], [0.0]]
    total = np.array([counts[lang] for lang in languages], float)
    return Model(path, languages, probability, total / total.sum())


def _predictor(sent):
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        path, languages, probability, prior = sent.value
        model = Model(path, languages, probability, prior)
        for texts in batches:
            yield pd.DataFrame(model.predict(texts), columns=["lang_pred", "score"])

    return predicted


def prediction(df: DataFrame, model: Model, text_col: str = "text") -> Column:
    """A struct of lang_pred and score for each text of ``df``.  The model is sent to each executor once: pieces times languages."""
    short_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast((model.path, model.languages, model.probability, model.prior))
    return F.pandas_udf(_predictor(sent), "lang_pred string, score double")(F.col(text_col))


def _lettered(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([t is not None and any(map(str.isalpha, t)) for t in texts], dtype=bool)


def has_letter(df: DataFrame, text_col: str = "text") -> Column:
    """Whether each text of ``df`` has a letter, and so a word to tell a language by; a null text has none."""
    short_batches(df.sparkSession)
    return F.pandas_udf(_lettered, "boolean")(F.col(text_col))


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row of ``df``.

    ``lang_pred`` is ``und`` with score 0 if the text is null or has no letter, or nothing was learned.  Equal scores go to the language that
    is first in order.  Equal rows stay; a null id stays null; an empty table gives no rows; other columns are not read.
    """
    return df.select(F.col(id_col), prediction(df, model, text_col).alias("__said")).select(id_col, "__said.*")


__all__ = ["Model", "fit", "has_letter", "held_out", "learnable", "predict", "prediction", "vocabulary", "words"]
