"""Column builders shared by the operators. All of them are plain Spark expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_SECONDS = 86_400


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a: Column, b: Column) -> Column:
    """``a / b``, NULL where ``b`` is zero."""
    return F.try_divide(a, b)


def pct_change(c: str | Column, w: WindowSpec) -> Column:
    c = as_col(c)
    return ratio(c, F.lag(c).over(w)) - 1


def join_on(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on equal ``keys``, a missing key being equal to a missing one, as in groups; the columns of ``left``, then the others of ``right``."""
    named = {k: f"__on_{k}" for k in keys}
    others = [F.col(c) for c in right.columns if c not in named]
    same = F.lit(True)
    for k, n in named.items():
        same = same & F.col(k).eqNullSafe(F.col(n))
    return left.join(right.select(*[F.col(k).alias(n) for k, n in named.items()], *others), same, how).drop(*named.values())


def rolling(agg: Callable[[Column], Column], c: str | Column, w: WindowSpec, n: int) -> Column:
    """Aggregate of the last ``n`` rows, NULL until the frame holds ``n`` non-null values."""
    c = as_col(c)
    frame = w.rowsBetween(-(n - 1), Window.currentRow)
    return F.when(F.count(c).over(frame) >= n, agg(c).over(frame))


def rolling_mean(c, w: WindowSpec, n: int) -> Column:
    return rolling(F.avg, c, w, n)


def rolling_std(c, w: WindowSpec, n: int) -> Column:
    return rolling(F.stddev_samp, c, w, n)


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Seconds since 1970-01-01 with their fraction. NTZ values are read as they stand, without any time zone."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.unix_micros(c) / 1e6
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return _since_epoch(c).cast("decimal(20,6)").cast("double")
    return local_seconds(c).cast("double")


def _since_epoch(c: Column) -> Column:
    """Time since 1970-01-01 of a TIMESTAMP_NTZ, as an interval of seconds; involves no time zone."""
    return (c - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second")


def local_seconds(c: Column) -> Column:
    """Seconds since 1970-01-01 of a TIMESTAMP_NTZ, fraction dropped."""
    return _since_epoch(c).cast("bigint")


def local_micros(c: Column) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ."""
    return (_since_epoch(c).cast("decimal(18,6)") * 1_000_000).cast("bigint")


def micros_of_day(c: Column) -> Column:
    """Microseconds since midnight, local time of the session for a TIMESTAMP."""
    return F.pmod(local_micros(c.cast("timestamp_ntz")), F.lit(DAY_SECONDS * 1_000_000))


def minutes_between(later: Column, earlier: Column) -> Column:
    return (local_micros(later) - local_micros(earlier)) / F.lit(60_000_000.0)


def ordering(order: list[Column]) -> Column:
    """One value to order by. A single column stays as it is, which keeps ``min_by`` / ``max_by`` hash-based."""
    return order[0] if len(order) == 1 else F.struct(*order)


def first_value_of(c: str | Column, order: list[Column]) -> Column:
    """Earliest non-null value."""
    c = as_col(c)
    return F.min_by(c, F.when(c.isNotNull(), ordering(order)))


def last_value_of(c: str | Column, order: list[Column]) -> Column:
    """Latest non-null value."""
    c = as_col(c)
    return F.max_by(c, F.when(c.isNotNull(), ordering(order)))
