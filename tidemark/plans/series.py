"""How per-series window work is spread over a cluster.

Indicators and signals need the rows of one instrument in time order.  A window partitioned by the
instrument puts a whole instrument into one task, which fails when one instrument holds a third of the
data.  The layout below bounds what a task receives:

* The series are counted first (key columns only, map-side combined).  If no series exceeds ``slice_rows`` the
  window is partitioned by the series keys alone and nothing else happens.
* Otherwise the table is range-partitioned in the full order (keys, time, ties, then a hash of the row, so that rows of one
  time are told apart) and its rows are numbered from first to last: a row's number is its place in its
  partition plus the rows of all partitions before, of which there is one count each.  Every ``slice_rows`` numbers are a *slice*,
  wherever they fall.  A row goes to its own slice and, if it lies at most ``lookback`` rows before a later slice (or
  ``lookahead`` rows after an earlier one), also to that slice as a *halo* row.  Windows are partitioned by
  (slice, keys) and ordered by number; halo rows are dropped at the end.  The result equals the unsplit one.
* Running values (unbounded frames) are computed per slice and completed with a prefix over
  one summary row per (series, slice).  Only one series reaches into a slice from before, so a slice receives one row.

The numbered rows are kept in the shared folder, once for each layout, as windows and summaries both read them; nothing above them
is computed again, and plans do not grow with a chain of operators.  The count is a bound that also holds for selections
of rows, so operators in a chain do not count again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.plans.storage import checkpointed

SLICE = "__slice"
HOME = "__home"
PLACE = "__place"
_IN_PARTITION = (1 << 33) - 1


@dataclass(frozen=True)
class SeriesSpec:
    """Identity and order of a series, and the size limit of its layout.

    ``max_rows`` is an upper bound on the rows of one series and ``rows`` one on all rows when they are already known;
    ``measured`` fills them in.
    """

    keys: tuple[str, ...] = ("instrument",)
    ts: str = "ts"
    ties: tuple[str, ...] = ()
    slice_rows: int = 500_000
    max_rows: int | None = None
    rows: int | None = None

    @property
    def order(self) -> list[Column]:
        return [F.col(c) for c in (self.ts, *self.ties)]

    def window(self, *extra: str) -> WindowSpec:
        return Window.partitionBy(*self.keys, *extra).orderBy(*self.order)

    def keyed_by(self, *keys: str, copies: int = 1) -> SeriesSpec:
        """The spec for series keyed by ``keys``, each row of which stands for ``copies`` rows.

        Series of more keys are no longer than those of fewer; any series is no longer than the table.
        """
        rows = self.rows * copies if self.rows is not None else None
        return replace(self, keys=keys, max_rows=self.max_rows if set(keys) >= set(self.keys) else rows, rows=rows)

    def reordered(self, ts: str, *ties: str) -> SeriesSpec:
        """The same series in another order, or a selection of their rows: the bounds still hold."""
        return replace(self, ts=ts, ties=ties)

    def measured(self, df: DataFrame) -> SeriesSpec:
        """Count the rows of every series (one small job) unless a bound is known."""
        if self.max_rows is not None:
            return self
        size = df.groupBy(*self.keys).agg(F.count("*").alias("n")).agg(F.max("n").alias("longest"), F.sum("n").alias("rows")).first()
        return replace(self, max_rows=size["longest"] or 0, rows=size["rows"] or 0)

    def whole(self) -> bool:
        return self.max_rows <= self.slice_rows


BAR_SERIES = SeriesSpec()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


@dataclass(frozen=True)
class Layout:
    """Rows arranged for windows; build columns on ``df`` with ``window`` and ``running``, then ``finish``."""

    df: DataFrame
    spec: SeriesSpec
    split: bool
    slice: str = SLICE
    home: str = HOME
    place: str = PLACE

    @property
    def window(self) -> WindowSpec:
        if self.split:  # the slice comes first, as rows are dealt out by it
            return Window.partitionBy(self.slice, *self.spec.keys).orderBy(self.place)
        return self.spec.window()

    @property
    def own(self) -> Column:
        return F.col(self.slice) == F.col(self.home)

    def finish(self, df: DataFrame) -> DataFrame:
        if not self.split:
            return df
        return df.filter(self.own).drop(self.slice, self.home, self.place)

    def running(self, df: DataFrame, **columns: tuple) -> DataFrame:
        """Add running aggregates from the first row of the series to the current one.

        ``columns`` maps a name to (kind, expression), kind one of sum, product, max, min, last; ``last`` is the
        latest non-null value.  A third element names an earlier sum or product of the same call which the
        expression contains: ``("max", F.col("nth") * flag, "nth")`` for expressions of the form ``x + nth`` or
        ``x * growth``, ``("last", x - F.col("n"), "-n")`` for ``x - n``.  All columns of a call cost one pass.
        On halo rows the values are undefined.
        """
        frame = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        parts = [_Part(n, c[0], c[1], c[2] if len(c) > 2 else None, columns) for n, c in columns.items()]
        free, bound = [p for p in parts if p.moves_with is None], [p for p in parts if p.moves_with is not None]
        home = self.own if self.split else None

        def over_frame(p: _Part, name: str, kind: str) -> Column:
            value = F.when(home, p.value) if self.split else p.value
            return _AGGREGATES[kind](value).over(frame).alias(name)

        local = df.select("*", *[over_frame(p, p.name, p.kind) for p in free])
        if bound:
            local = local.select("*", *[over_frame(p, p.name, p.kind) for p in bound])
        if not self.split:
            return local
        # a negative growth factor turns the largest value into the smallest
        scaled = [p for p in bound if p.scaled]
        if scaled:
            local = local.select("*", *[over_frame(p, p.other_end, {"max": "min", "min": "max"}[p.kind]) for p in scaled])
        return self._with_carry(df.columns, local, free, bound)

    def _with_carry(self, kept: list[str], local: DataFrame, free: list[_Part], bound: list[_Part]) -> DataFrame:
        """Complete running values that start anew in every slice."""
        keys = self.spec.keys
        names = [p.name for p in (*free, *bound)] + [p.other_end for p in bound if p.scaled]
        # a slice's last own row holds its totals
        totals = local.filter(self.own).groupBy(self.slice, *keys).agg(F.max_by(F.struct(*names), self.place).alias("__totals"))
        totals = totals.select(self.slice, *keys, "__totals.*")
        earlier = Window.partitionBy(*keys).orderBy(self.slice).rowsBetween(Window.unboundedPreceding, -1)
        carried = totals.withColumn("__earlier", F.count("*").over(earlier))
        carried = carried.withColumns({p.carry: _AGGREGATES[p.kind](F.col(p.name)).over(earlier) for p in free})
        carried = carried.withColumns({p.carry: _AGGREGATES[p.kind](p.moved()).over(earlier) for p in bound})
        # the series that reaches into a slice from before: one at most
        carried = carried.filter("__earlier > 0").select(
            F.col(self.slice).alias("__into"), *[F.col(k).alias(f"__into_{i}") for i, k in enumerate(keys)], *[p.carry for p in (*free, *bound)])
        on = F.col(self.slice) == F.col("__into")
        for i, k in enumerate(keys):
            on = on & F.col(k).eqNullSafe(F.col(f"__into_{i}"))
        return local.join(carried, on, "left").select(
            *kept,
            *[_COMBINE[p.kind](F.col(p.carry), F.col(p.name)).alias(p.name) for p in free],
            *[_COMBINE[p.kind](F.col(p.carry), p.moved()).alias(p.name) for p in bound],
        )


class _Part:
    """One column of a ``running`` call."""

    def __init__(self, name: str, kind: str, value: Column, moves_with: str | None, columns: dict):
        self.name, self.kind, self.value = name, kind, value
        self.sign = -1 if moves_with and moves_with.startswith("-") else 1
        self.moves_with = moves_with.lstrip("-") if moves_with else None
        self.scaled = self.moves_with is not None and columns[self.moves_with][0] == "product"
        self.carry = f"__carry_{name}"
        self.other_end = f"__other_{name}"

    def moved(self) -> Column:
        """The slice's own value as it would be had the slice not started anew."""
        c, carry = F.col(self.name), F.col(f"__carry_{self.moves_with}")
        if self.scaled:
            return F.when(carry < 0, F.col(self.other_end)).otherwise(c) * F.coalesce(carry, F.lit(1.0))
        return c + self.sign * F.coalesce(carry, F.lit(0))


_AGGREGATES = {
    "sum": F.sum,
    "product": F.product,
    "max": F.max,
    "min": F.min,
    "last": lambda c: F.last(c, ignorenulls=True),
}

_COMBINE = {
    "sum": lambda carry, c: F.coalesce(carry + c, carry, c),
    "product": lambda carry, c: F.coalesce(carry * c, carry, c),
    "max": F.greatest,
    "min": F.least,
    "last": lambda carry, c: F.coalesce(c, carry),
}


def layout(df: DataFrame, spec: SeriesSpec = BAR_SERIES, lookback: int = 0, lookahead: int = 0) -> Layout:
    spec = spec.measured(df)
    if spec.whole():
        return Layout(df, spec, split=False)
    if not lookback and not lookahead:
        return ranges(df, spec)
    names = [free_name(df, n) for n in (SLICE, HOME, PLACE)]
    slice_, place = F.col(names[0]), F.col(names[2])
    numbered = _numbered(df, spec, names[2])
    # rows 0 to slice_rows - 1 are slice 0, and so on; the first and last slice that need a row
    first = F.greatest(F.floor((place - lookahead) / spec.slice_rows), F.lit(0))
    last = F.floor((place + lookback) / spec.slice_rows)
    dealt = numbered.withColumn(names[1], F.floor(place / spec.slice_rows)).withColumn(names[0], F.explode(F.sequence(first, last)))
    return Layout(dealt.repartition(slice_), spec, True, *names)


def ranges(df: DataFrame, spec: SeriesSpec) -> Layout:
    """A layout without halos whose slices are the ranges that Spark deals out: for running values, and without a count."""
    names = [free_name(df, n) for n in (SLICE, HOME, PLACE)]
    ranged = _in_ranges(df, spec, names[2])
    part = F.shiftright(names[2], 33)
    return Layout(ranged.withColumns({names[0]: part, names[1]: part}).repartition(F.col(names[0])), spec, True, *names)


def _in_ranges(df: DataFrame, spec: SeriesSpec, at: str) -> DataFrame:
    """``df`` range-partitioned in the full order, and where each row stands: the partition in the upper 31 bits, the place in it below."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-(spec.rows or 0) // spec.slice_rows))
    tie = free_name(df, "__tie")
    order = [*spec.keys, *spec.order, tie]
    ranged = df.withColumn(tie, F.xxhash64(*df.columns)).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # Spark samples the ranges anew wherever the rows are read, so they are kept once dealt out
    return checkpointed(ranged.drop(tie).withColumn(at, F.monotonically_increasing_id()))


def _numbered(df: DataFrame, spec: SeriesSpec, place: str) -> DataFrame:
    """``df`` with the number of each row, from 0, in the order of the series and of the rows of each."""
    at, part = free_name(df, "__at"), free_name(df, "__part")
    ranged = _in_ranges(df, spec, at).withColumn(part, F.shiftright(at, 33))
    nth = F.col(at).bitwiseAND(F.lit(_IN_PARTITION))
    sizes = ranged.groupBy(F.col(part).alias("part")).agg((F.max(nth) + 1).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = sizes.select(F.col("part").alias("__of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    # as many rows as partitions, 16 bytes each: one for every slice
    joined = ranged.join(F.broadcast(starts), F.col(part) == F.col("__of"))
    return joined.select(*df.columns, (F.col("__before") + nth).alias(place))


def over_series(
    df: DataFrame,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    spec: SeriesSpec = BAR_SERIES,
    lookback: int = 0,
    lookahead: int = 0,
) -> DataFrame:
    """Apply ``build(df, window)``, which may look ``lookback`` rows back and ``lookahead`` rows ahead."""
    lay = layout(df, spec, lookback, lookahead)
    return lay.finish(build(lay.df, lay.window))
