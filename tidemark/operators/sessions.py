"""Trading sessions: labels, edges, and the position of a bar inside its session run."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from tidemark.plans.series import BAR_SERIES, Layout, SeriesSpec, layout, over_series

# Session name, first minute of the day, minute after the last.
SESSIONS = (("pre_market", 540, 555), ("normal", 555, 930), ("post_market", 940, 960))


def session_label(df: DataFrame, ts: str = "ts") -> DataFrame:
    df = df.withColumns({"hour": F.hour(ts), "minute": F.minute(ts)})
    df = df.withColumn("time_minutes", F.col("hour") * 60 + F.col("minute"))
    label = F
    for name, first, after in SESSIONS:
        label = label.when((F.col("time_minutes") >= first) & (F.col("time_minutes") < after), F.lit(name))
    return df.withColumn("session", label.otherwise(F.lit("closed")))


def edge_columns(df: DataFrame, w: WindowSpec) -> DataFrame:
    session = F.col("session")
    return df.withColumns(
        {
            "session_start": F.coalesce(session != F.lag("session").over(w), F.lit(True)),
            "session_end": F.coalesce(session != F.lead("session").over(w), F.lit(True)),
        }
    )


def session_edges(df: DataFrame, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """Needs ``session``. A label that differs from the neighbour's marks an edge; series ends are edges."""
    return over_series(df, edge_columns, spec, lookback=1, lookahead=1)


def count_in_run(lay: Layout, df: DataFrame, reset_daily: bool) -> DataFrame:
    starts = F.col("session_start")
    if reset_daily:
        day = F.to_date(lay.spec.ts)
        new_day = F.coalesce(day != F.lag(day).over(lay.window), F.lit(True))
        df = df.withColumn("__starts", starts | new_day)
        starts = F.col("__starts")
    df = lay.running(df, __nth=("sum", F.lit(1)), __first=("max", F.when(starts, F.col("__nth")), "__nth"))
    df = df.withColumn("minutes_in_session", (F.col("__nth") - F.col("__first")).cast("bigint"))
    return df.drop("__nth", "__first", "__starts")


def session_bar_count(df: DataFrame, reset_daily: bool = False, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """Bars since the start of the run of equal labels, from 0. Needs ``session_start``.

    By default a run may continue overnight when no other label lies between; ``reset_daily`` starts anew each day.
    """
    lay = layout(df, spec, lookback=1)
    return lay.finish(count_in_run(lay, lay.df, reset_daily))


def market_sessions(df: DataFrame, reset_daily: bool = False, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    lay = layout(session_label(df, spec.ts), spec, lookback=1, lookahead=1)
    return lay.finish(count_in_run(lay, edge_columns(lay.df, lay.window), reset_daily))
