"""The walk over hulls must break where a refit of the whole segment at every row breaks."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.segments import piecewise_segments


def refitted(values, deviation, shortest):
    """(first, last) of the greedy segments, every row tested on all rows of its segment."""

    def misses(held):
        y = np.asarray(held, float)
        x = np.arange(len(y)) - (len(y) - 1) / 2
        slope = (x @ y) / (x @ x) if len(y) > 1 else 0.0
        with np.errstate(all="ignore"):
            return np.max(np.abs(y - (y.mean() + slope * x)) / y)

    out, first, held = [], 0, []
    for y in values:
        if held and len(held) + 1 >= shortest and misses([*held, y]) > deviation:
            out.append((first, first + len(held) - 1))
            first, held = first + len(held), []
        held.append(y)
    return [*out, (first, first + len(held) - 1)] if held else out


def series(kind, n, rng):
    level, out = rng.choice([100.0, 1e5, 1e8]), []
    for i in range(n):
        level *= 1 + rng.gauss(0, 0.02)
        out.append({
            "drift": level, "small": float(rng.randrange(1, 6)), "zeros": float(rng.randrange(-3, 4)), "line": 100 + 2.0 * i,
            "mostly zeros": 0.0 if rng.random() < 0.9 else level, "zeros, then none": 0.0 if i < n // 2 else level,
            "through zero": float(i - n // 2), "signs": level if rng.random() < 0.95 else -level, "gap": math.nan if i == 40 else level,
        }[kind])
    return out


@pytest.mark.parametrize("deviation, shortest", [(0.0, 1), (0.03, 5), (0.1, 2), (0.6, 1)])
def test_breaks_equal_those_of_refits(spark, deviation, shortest):
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    made = {f"{kind}{n}": series(kind, n, rng) for kind in ("drift", "small", "zeros", "line", "signs", "gap", "mostly zeros", "zeros, then none", "through zero") for n in (1, 60, 300)}
    rows = [(name, start + dt.timedelta(minutes=i), y) for name, values in made.items() for i, y in enumerate(values)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "instrument string, ts timestamp_ntz, v double")
    found = piecewise_segments(df, "v", deviation, shortest, by=("instrument",))
    got = {}
    for r in found.orderBy("instrument", "start_row").collect():
        got.setdefault(r.instrument, []).append((r.start_row, r.end_row))
    assert got == {name: refitted(values, deviation, shortest) for name, values in made.items()}


def test_a_long_segment_is_walked_once(spark):
    """100,000 rows in one segment; with a refit at every row this would not end."""
    rows = spark.range(100_000).select(
        F.lit("A").alias("instrument"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(mins=F.col("id"))).alias("ts"),
        (100_000 + 50 * F.col("id") + 200 * F.sin("id")).alias("v"))
    assert [(r.start_row, r.end_row) for r in piecewise_segments(rows, "v", 0.5, by=("instrument",)).collect()] == [(0, 99_999)]


def test_zeros_are_as_quick_as_other_values(spark):
    """A file without open interest is read as zeros."""
    rows = spark.range(100_000).select(
        F.lit("A").alias("instrument"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(mins=F.col("id"))).alias("ts"),
        F.when(F.col("id") < 60_000, 0.0).otherwise(F.lit(5.0)).alias("v"))
    found = piecewise_segments(rows, "v", 0.5, 5, by=("instrument",)).orderBy("start_row").collect()
    assert [(r.start_row, r.end_row) for r in found] == [(0, 59_999), (60_000, 99_999)]
