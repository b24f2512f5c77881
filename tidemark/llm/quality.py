"""Quality of documents by hierarchical empirical Bayes.

A logistic classifier over measures of a text gives each document its own evidence.  Grouped sums of that evidence give every
host a posterior share of good documents, and every path of a host one that starts from its host's: sparse hosts shrink
towards the global share, sparse paths towards their host.  How strongly follows from how much hosts (paths) differ beyond
what their sizes explain.  A document's posterior is its evidence with the odds of its path, less its own part, as prior.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, short_batches

#: Labelled documents that the classifier is fitted on, about; which ones follows from a hash of their ids.
SAMPLED = 20_000
RIDGE = 1e-3
MEASURES = 16

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(0xC2, 0xF5), *range(0x80, 0xC0)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_STOP = np.zeros(256, bool)
_STOP[[33, 44, 46, 58, 59, 63]] = True


def measures(text: str | None) -> np.ndarray:
    """Measures of a text; null counts as empty.

    Shares of letters, capitals, digits, white space, stops and other signs; repeated signs; size, word length and their
    spread; shares of distinct words, of the commonest word, of repeated neighbours; line length and repeated lines.
    """
    out = np.zeros(MEASURES)
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    words = (text or "").split()
    out[0] = 1.0
    if not len(raw) or not words:
        return out
    counts = np.bincount(raw, minlength=256)
    n = len(raw)
    letters, upper, digit, blank, stop = (counts[x].sum() / n for x in (_LETTERS, _UPPER, _DIGIT, _BLANK, _STOP))
    lengths = np.fromiter(map(len, words), np.float64, len(words))
    times = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    same = (raw[1:] == raw[:-1]) & ~_LETTERS[raw[1:]] & ~_BLANK[raw[1:]]
    neighbours = sum(map(str.__eq__, words, words[1:])) if len(words) > 1 else 0
    out[1:] = (
        letters, upper / (letters + 1e-3), digit, blank, stop, max(0.0, 1 - letters - digit - blank - stop), same.mean() if n > 1 else 0.0,
        np.log1p(len(words)) / 10, lengths.mean() / 10, lengths.std() / 10, len(times) / len(words), max(times.values()) / len(words),
        neighbours / len(words), np.log1p(n / max(1, len(lines))) / 10, 1 - len(set(lines)) / max(1, len(lines)),
    )
    return out


def _measured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([measures(t) for t in texts], dtype=object)


def measured(df: DataFrame, text_col: str = "text") -> Column:
    short_batches(df.sparkSession)
    return F.pandas_udf(_measured, "array<double>")(F.col(text_col))


@dataclass
class Classifier:
    """Weights over standardised measures and the share of good documents among the labelled ones."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    good: float

    def evidence(self, values: Column) -> Column:
        """The log odds of a document by its measures alone."""
        total = F.lit(0.0)
        for i in range(MEASURES):
            total = total + F.lit(float(self.weights[i])) * (values[i] - F.lit(float(self.mean[i]))) / F.lit(float(self.spread[i]))
        return total


def fitted(x: np.ndarray, y: np.ndarray, rounds: int = 25) -> Classifier:
    """A ridge logistic regression by Newton steps; without both labels it knows only their share."""
    good = (y.sum() + 1) / (len(y) + 2)
    mean, spread = np.zeros(MEASURES), np.ones(MEASURES)
    weights = np.zeros(MEASURES)
    weights[0] = np.log(good / (1 - good))
    if 0 < y.sum() < len(y):
        mean[1:], spread[1:] = x[:, 1:].mean(axis=0), x[:, 1:].std(axis=0) + 1e-9
        z = (x - mean) / spread
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
            pull = np.full(MEASURES, RIDGE * len(y))
            pull[0] = 1e-9
            slope = z.T @ (y - p) - pull * weights
            curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(pull)
            weights = weights + np.linalg.solve(curve, slope)
    return Classifier(mean, spread, weights, float(good))


def fit(values: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sampled: int = SAMPLED) -> Classifier:
    """A classifier from (id, measures) and (id, label); at most about ``sampled`` labelled documents reach the driver.

    Null ids and labels take no part; of several labels of an id the least counts.
    """
    told = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(
        F.min(label_col).alias("__label"))
    n = told.count()
    told = told.where(F.pmod(F.xxhash64(F.lit("quality"), "__id"), F.lit(1 << 20)) < int(min(1.0, sampled / max(1, n)) * (1 << 20)))
    rows = values.join(told, values[id_col] == told["__id"]).select("measures", "__label").toPandas()
    if not len(rows):
        return fitted(np.zeros((0, MEASURES)), np.zeros(0))
    return fitted(np.stack(rows["measures"].to_numpy()).astype(float), (rows["__label"].to_numpy() > 0).astype(float))


def _strength(groups: DataFrame, prior: Column) -> float:
    """How many documents a group's prior is worth: p(1-p) / variance between groups, by moments; at least 1, at most a million."""
    p, n = F.col("good") / F.col("n"), F.col("n")
    row = groups.select(
        (n * (p - prior) * (p - prior)).alias("apart"), (prior * (1 - prior)).alias("within"), n.alias("n")).agg(
        F.sum("apart").alias("apart"), F.sum(F.col("within")).alias("noise"), F.sum(F.col("n") * F.col("within")).alias("scale"),
        F.sum("n").alias("n")).first()
    if not row["n"]:
        return 1.0
    between = max(0.0, row["apart"] - row["noise"]) / row["n"]
    return float(min(1e6, max(1.0, row["scale"] / row["n"] / between if between > 0 else 1e6)))


def quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            path_col: str = "lang", label_col: str = "quality", least: float = 0.5) -> DataFrame:
    """(id, evidence, host_share, path_share, posterior, kept) for every row of ``df``.

    ``evidence`` is the text's own probability to be good, ``host_share`` and ``path_share`` the posteriors of its host and of its
    path on the host, ``posterior`` all of them together, and ``kept`` whether that is ``least`` or more.  Null hosts and paths
    are groups of their own; a null text counts as empty; equal rows stay; an empty table gives no rows.  Without labels the
    evidence is 1/2.  Other columns are not read.
    """
    docs = df.select(
        F.col(id_col).alias(id_col), F.col(host_col).alias("__host"), F.col(path_col).alias("__path"), measured(df, text_col).alias("measures"))
    docs = checkpointed(docs)  # texts are read once
    model = fit(docs, labels, id_col, label_col)
    logit = F.greatest(F.lit(-12.0), F.least(F.lit(12.0), model.evidence(F.col("measures"))))
    docs = docs.select(id_col, "__host", "__path", (1 / (1 + F.exp(-logit))).alias("evidence"))
    paths = checkpointed(docs.groupBy("__host", "__path").agg(F.sum("evidence").alias("good"), F.count("*").alias("n")))
    hosts = paths.groupBy("__host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    everything = hosts.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    overall = (everything["good"] + 1) / (everything["n"] + 2) if everything["n"] else 0.5
    by_host = _strength(hosts, F.lit(overall))
    hosts = hosts.select(
        F.col("__host").alias("__of"), ((F.col("good") + by_host * overall) / (F.col("n") + by_host)).alias("host_share"))
    paths = checkpointed(paths.join(hosts, F.col("__host").eqNullSafe(F.col("__of"))).drop("__of"))
    by_path = _strength(paths, F.col("host_share"))
    paths = paths.select(F.col("__host").alias("__h"), F.col("__path").alias("__p"), "good", "n", "host_share")
    both = docs.join(paths, F.col("__host").eqNullSafe(F.col("__h")) & F.col("__path").eqNullSafe(F.col("__p")))
    start = by_path * F.col("host_share")
    others = (F.col("good") - F.col("evidence") + start) / (F.col("n") - 1 + by_path)
    others = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), others))
    odds = lambda p: F.log(p / (1 - p))
    total = odds(F.col("evidence")) - F.lit(float(np.log(model.good / (1 - model.good)))) + odds(others)
    return both.select(
        id_col, "evidence", "host_share",
        ((F.col("good") + start) / (F.col("n") + by_path)).alias("path_share"),
        (1 / (1 + F.exp(-total))).alias("posterior"),
    ).withColumn("kept", F.col("posterior") >= least)


__all__ = ["Classifier", "fit", "fitted", "measured", "measures", "quality"]
