"""Piecewise linear segmentation.

The next break of a greedy segmentation depends on where the current segment began, so a group is walked in order.  Groups
are (series, day) by default: a day of one instrument is short, and a long history is spread over as many tasks as days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.series import BAR_SERIES, SeriesSpec
from tidemark.schema import fields_of


def piecewise_segments(
    df: DataFrame,
    c: str = "oi",
    max_deviation: float = 0.05,
    min_segment_len: int = 5,
    by: tuple[str, ...] | None = None,
    spec: SeriesSpec = BAR_SERIES,
) -> DataFrame:
    """Greedy segments of ``c`` per group: first and last row number (from 0) and the rows' times.

    A segment grows while the line through it misses no value by more than ``max_deviation`` of that value.  It is not tested
    while shorter than ``min_segment_len``.  ``by`` names the grouping columns; by default the keys and the ``day``.
    Rows are sorted inside the partitions and walked batch by batch; only the open segment is kept.
    """
    if by is None:
        df = df.withColumn("day", F.to_date(spec.ts))
        by = (*spec.keys, "day")
    schema = T.StructType(
        fields_of(df.schema, by)
        + [
            T.StructField("start_row", T.LongType()),
            T.StructField("end_row", T.LongType()),
            T.StructField("start_ts", df.schema[spec.ts].dataType),
            T.StructField("end_ts", df.schema[spec.ts].dataType),
        ]
    )
    rows = df.select(*by, spec.ts, *spec.ties, F.col(c).cast("double").alias("__y")).filter(F.col("__y").isNotNull())
    spread = rows.repartition(*by).sortWithinPartitions(*by, *spec.order)
    return spread.mapInPandas(_walker(by, spec.ts, max_deviation, min_segment_len), schema)


def _walker(by, ts, max_deviation, min_segment_len):
    """The greedy walk over sorted rows. Self-contained, so that it travels to the Python workers by value.

    A line misses no value by more than the allowed share if it runs below all values raised by it and above all
    lowered by it.  Of these two rows of points only the hulls matter, and on a hull the point nearest to a line is found by
    bisection; the line itself follows from running sums.  A value of zero allows no distance at all, so a line misses one unless it
    goes through it, which only the zeros around its own zero can be.  Only where the nearest point is as close as rounding can
    blur, or a value is not finite, are all distances computed.
    """

    def walk(batches):
        import bisect
        import math

        import numpy as np
        import pandas as pd

        blur = 1e-7

        def table(found):
            names = [*by, "start_row", "end_row", "start_ts", "end_ts"]
            return pd.DataFrame({n: [f[i] for f in found] for i, n in enumerate(names)})

        def misses(values):
            """Largest relative distance from the least-squares line, sign of the value kept as in y-relative error."""
            y = np.asarray(values)
            x = np.arange(len(y)) - (len(y) - 1) / 2
            slope = (x @ y) / (x @ x) if len(y) > 1 else 0.0
            with np.errstate(divide="ignore", invalid="ignore"):
                return np.max(np.abs(y - (y.mean() + slope * x)) / y)

        class Hull:
            """The points of a growing row that a line from below (``side`` 1) or above (-1) touches first."""

            def __init__(self, side):
                self.side, self.points = side, []

            def add(self, x, y):
                points, y = self.points, self.side * y
                while len(points) > 1:
                    (x1, y1), (x2, y2) = points[-2], points[-1]
                    if (y2 - y1) * (x - x2) < (y - y2) * (x2 - x1):
                        break
                    points.pop()
                points.append((x, y))

            def excess(self, level, slope):
                """How far the line passes the point nearest to it; negative if it keeps away."""
                points, level, slope = self.points, self.side * level, self.side * slope
                low, high = 0, len(points) - 1
                while low < high:
                    mid = (low + high) // 2
                    (x1, y1), (x2, y2) = points[mid], points[mid + 1]
                    if y2 - y1 < slope * (x2 - x1):
                        low = mid + 1
                    else:
                        high = mid
                return level + slope * points[low][0] - points[low][1] if points else -math.inf

        class Segment:
            """The open segment with the sums of its line, relative to its first value."""

            def __init__(self, y):
                self.values, self.base = [], y
                self.sum = self.sum_x = self.scale = 0.0
                self.odd = not 0 <= max_deviation < math.inf  # judged by all distances
                self.below, self.above = Hull(1), Hull(-1)
                self.zeros = []
                self.add(y)

            def add(self, y):
                n, rise = len(self.values), y - self.base
                self.values.append(y)
                self.odd = self.odd or not math.isfinite(y)
                if y == 0:
                    self.zeros.append(n)
                self.scale = max(self.scale, abs(y))
                self.sum, self.sum_x = self.sum + rise, self.sum_x + n * rise
                if y > 0 and not self.odd:  # the distance of a negative value counts as negative, so it allows everything
                    self.below.add(n, rise + max_deviation * y)
                    self.above.add(n, rise - max_deviation * y)

            def meets_a_zero(self, level, slope):
                """Whether the line may go through a value of zero: that is, whether rounding hides by how much it misses the nearest one."""
                places = {self.zeros[0], self.zeros[-1]}
                if slope:
                    near = bisect.bisect_left(self.zeros, -level / slope)
                    places.update(self.zeros[max(0, near - 1):near + 1])
                return any(abs(level + slope * x) <= blur * self.scale for x in places)

            def holds(self):
                """Whether the line through all values is near enough to them."""
                n = len(self.values)
                if not self.odd:
                    if not self.scale:
                        return True  # nothing but zeros, all of them on the line
                    middle = (n - 1) / 2
                    slope = (self.sum_x - middle * self.sum) * 12 / (n * (n * n - 1)) if n > 1 else 0.0
                    level = self.sum / n - slope * middle
                    if self.zeros:
                        # any distance from a zero is too much
                        if not self.meets_a_zero(self.base + level, slope):
                            return False
                    else:
                        worst = max(self.below.excess(level, slope), self.above.excess(level, slope))
                        if abs(worst) > blur * self.scale:
                            return worst < 0
                return not misses(self.values) > max_deviation

        group, first, first_ts, last_ts, segment = None, 0, None, None, None

        def closed(rows):
            return (*group, first, first + rows - 1, first_ts, last_ts)

        for pdf in batches:
            found = []
            keys = zip(*[pdf[k].tolist() for k in by])
            for key, at, y in zip(keys, pdf[ts].array, pdf["__y"].tolist()):
                if key != group:
                    if segment:
                        found.append(closed(len(segment.values)))
                    group, first, first_ts, segment = key, 0, at, Segment(y)
                else:
                    segment.add(y)
                    rows = len(segment.values) - 1
                    if rows + 1 >= min_segment_len and not segment.holds():
                        found.append(closed(rows))
                        first, first_ts, segment = first + rows, at, Segment(y)
                last_ts = at
            if found:
                yield table(found)
        if segment:
            yield table([closed(len(segment.values))])

    return walk
