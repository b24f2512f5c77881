"""Signals and positions on a stream of bars.

The state of an instrument is small: the open-interest values a rule looks back on, the open position, the number of
entries, and the bars that still wait for their turn. Feed it bars, not ticks: ``stream_resample`` reduces a busy instrument to
one row per bar first.

A bar's turn comes once a bar of any instrument that is ``delay`` newer has been seen; an instrument's bars are taken in time order.
So the results do not depend on where batches end, as long as no bar comes later than that.  A timer on event time releases the
bars of an instrument that falls quiet.  A bar that comes when a newer one has been taken, or
repeats a time, is not taken, but it is not lost either: ``live_bars`` returns it with ``skipped`` set.

Spark drops rows behind the watermark before a state with timers sees them, so the watermark reads a column of its own
(``CLOCK``), which is NULL for bars; a few more rows (ticks), which are nothing else, carry the newest time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.state import GroupStateTimeout

from tidemark.functions.rules import Rule, rule_of
from tidemark.operators.signals import signal_columns
from tidemark.plans.series import BAR_SERIES, SeriesSpec

LIVE_FIELDS = [
    T.StructField("ts", T.TimestampType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("nth", T.LongType()),
    T.StructField("doi", T.DoubleType()),
    T.StructField("d2oi", T.DoubleType()),
    T.StructField("oi_ma", T.DoubleType()),
    T.StructField("action", T.StringType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("entry_ts", T.TimestampType()),
    T.StructField("entry_price", T.DoubleType()),
    T.StructField("pnl", T.DoubleType()),
    T.StructField("minutes_held", T.DoubleType()),
    T.StructField("entries", T.LongType()),
    T.StructField("skipped", T.BooleanType()),
]

#: Times are microseconds since 1970.
STATE = T.StructType(
    [
        T.StructField("oi", T.ArrayType(T.DoubleType())),
        T.StructField("nth", T.LongType()),
        T.StructField("taken", T.LongType()),
        T.StructField("newest", T.LongType()),
        T.StructField("entry_ts", T.LongType()),
        T.StructField("entry_price", T.DoubleType()),
        T.StructField("entries", T.LongType()),
        T.StructField("day", T.LongType()),
        T.StructField("waiting_ts", T.ArrayType(T.LongType())),
        T.StructField("waiting_close", T.ArrayType(T.DoubleType())),
        T.StructField("waiting_oi", T.ArrayType(T.DoubleType())),
    ]
)

DAY = 86_400_000_000
CLOCK = "__clock"


def with_ticks(df: DataFrame, ts: str, delay: float) -> DataFrame:
    """``df`` with the column ``CLOCK``, NULL but in one more row for each Arrow batch, a tick, and a watermark on it.

    A tick repeats a row of the batch and has the batch's newest time; it is for the watermark only.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(CLOCK, T.TimestampType())])
    arrow = to_arrow_schema(schema)

    def ticking(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        clock = arrow.field(len(arrow) - 1).type
        for batch in batches:
            columns = [c.cast(f.type) for c, f in zip(batch.columns, arrow)]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(batch.num_rows, clock)], schema=arrow)
            newest = pc.max(batch.column(batch.schema.get_field_index(ts)))
            if newest.is_valid:
                yield pa.RecordBatch.from_arrays([*[c.slice(0, 1) for c in columns], pa.array([newest.as_py()], clock)], schema=arrow)

    return df.mapInArrow(ticking, schema).withWatermark(CLOCK, f"{round(delay * 1e6)} microseconds")


def _live_stepper(keys: tuple[str, ...], rule: Rule, lot: int, cap: int | None, per: str, delay: int):
    """Derivatives and positions as arrays. Self-contained: it travels to the workers by value."""
    if rule.held:
        raise ValueError("live signals need levels that do not depend on the trade")
    keep, period, variant, relative = rule.lookback, rule.ma_period, rule.variant, rule.relative
    both = rule.both
    enter, leave1, leave2 = rule.entry_level, rule.exit_first_level, rule.exit_second_level
    names, day_length, clock = [*keys, *[f.name for f in LIVE_FIELDS]], DAY, CLOCK

    def derivatives(oi, seen):
        """Arrays for the values after the first ``seen``; ``oi`` starts with the remembered ones."""
        import numpy as np

        first_known = seen <= keep  # the remembered values reach back to the first bar
        doi, d2oi, ma = (np.full(len(oi), np.nan) for _ in range(3))
        doi[1:] = np.diff(oi) / 3
        d2oi[2:] = (oi[2:] + oi[:-2] - 2 * oi[1:-1]) / 9
        if variant == "rounded":
            doi, d2oi = np.rint(doi), np.rint(d2oi)
        elif variant == "indicator" and first_known:
            doi[:1], d2oi[:1] = 0.0, 0.0
            d2oi[1:2] = np.diff(oi[:2]) / 9
        if period and len(oi) >= period:
            ma[period - 1:] = np.convolve(oi, np.ones(period), "valid") / period
        return doi, d2oi, ma

    def latest(where):
        """The last place up to each at which ``where`` holds, or -1."""
        import numpy as np

        return np.maximum.accumulate(np.where(where, np.arange(len(where)), -1))

    def positions(buy, sell, held, left):
        """Position after each bar: what the last flag asked for, without entries beyond the next ``left``."""
        import numpy as np

        at = latest(buy | sell)
        after = np.where(at >= 0, buy[at], held)
        if left is None:
            return after
        entered = np.cumsum(after & ~np.concatenate([[held], after[:-1]]))
        return after & (entered <= left)

    def step(key, batches, state):
        import numpy as np
        import pandas as pd

        if state.exists:
            tail, nth, taken, newest, entry_ts, entry_price, entries, day, *waiting = state.get
        else:
            tail, nth, taken, newest, entry_ts, entry_price, entries, day, waiting = [], 0, None, None, None, None, 0, None, ([], [], [])

        def table(ts, close, skipped, **known):
            """Rows of the result; columns that are not ``known`` are NULL."""
            empty = {"action": pd.Series([None] * len(ts), dtype=object), "entry_ts": pd.NaT, "skipped": skipped}
            empty |= {c: pd.array([pd.NA] * len(ts), "Int64") for c in ("nth", "position", "entries")}
            empty |= {c: np.nan for c in ("doi", "d2oi", "oi_ma", "entry_price", "pnl", "minutes_held")}
            columns = dict(zip(keys, key)) | {"ts": ts.astype("datetime64[us]"), "close": close} | empty | known
            out = pd.DataFrame(columns, index=range(len(ts)))[names]
            return out.astype({"entry_ts": "datetime64[us]"})

        no_ts = np.iinfo(np.int64).min  # NaT
        # an instrument's bars of a batch: three numbers each
        parts = [[np.asarray(w, t) for w, t in zip(waiting, (np.int64, float, float))]]
        for b in batches:
            if delay:
                b = b[b[clock].isna()]
            parts.append([b["ts"].to_numpy("datetime64[us]").astype(np.int64), b["close"].to_numpy(float), b["oi"].to_numpy(float)])
        ts, close, oi = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((oi, close, ts))
        ts, close, oi = ts[order], close[order], oi[order]
        fresh = np.concatenate([[True], ts[1:] != ts[:-1]]) & (ts != no_ts)
        if taken is not None:
            fresh &= ts > taken
        if not fresh.all():
            yield table(ts[~fresh], close[~fresh], True)
            ts, close, oi = ts[fresh], close[fresh], oi[fresh]
        if len(ts):
            newest = int(ts[-1]) if newest is None else max(newest, int(ts[-1]))
        elif newest is None:
            return
        passed = state.getCurrentWatermarkMs() * 1000 if delay else 0  # 0: none yet
        ready = int(np.searchsorted(ts, max(newest - delay, passed) if passed > 0 else newest - delay, "right"))
        waiting = ts[ready:].tolist(), close[ready:].tolist(), oi[ready:].tolist()
        if waiting[0]:
            state.setTimeoutTimestamp(max(-(-waiting[0][0] // 1000), 1))
        ts, close, oi = ts[:ready], close[:ready], np.concatenate([np.asarray(tail, dtype=float), oi[:ready]])
        if not ready:
            state.update((tail, nth, taken, newest, entry_ts, entry_price, entries, day, *waiting))
            return

        doi, d2oi, ma = (a[len(tail):] for a in derivatives(oi, nth))
        scale = ma if relative else 1.0
        buys = (doi < 0) & (d2oi < enter * scale)
        first, second = doi > leave1 * scale, d2oi > leave2 * scale
        sells = ~buys & (first & second if both else first | second)
        numbers = nth + 1 + np.arange(ready)
        buys, sells = buys & (numbers >= 2), sells & (numbers >= 2)

        days = ts // day_length
        ends = [*(np.flatnonzero(np.diff(days)) + 1), ready] if per == "day" else [ready]
        held, begin = entry_ts is not None, 0
        after, counts = np.empty(ready, bool), np.empty(ready, np.int64)
        for end in ends:
            if per == "day" and int(days[begin]) != day:
                day, entries = int(days[begin]), 0
            part = slice(begin, end)
            after[part] = positions(buys[part], sells[part], held, None if cap is None else cap - entries)
            counts[part] = entries + np.cumsum(after[part] & ~np.concatenate([[held], after[part][:-1]]))
            held, entries, begin = bool(after[end - 1]), int(counts[end - 1]), end

        before = np.concatenate([[entry_ts is not None], after[:-1]])
        bought, sold = after & ~before, before & ~after
        at = latest(bought)
        in_trade = after | before
        entered = np.where(at >= 0, ts[at], no_ts if entry_ts is None else entry_ts)
        price = np.where(at >= 0, close[at], np.nan if entry_price is None else entry_price)
        yield table(
            ts, close, False, nth=numbers, doi=doi, d2oi=d2oi, oi_ma=ma,
            action=np.where(bought, "BUY", np.where(sold, "SELL", None)),
            position=after.astype(np.int64),
            entry_ts=np.where(in_trade, entered, no_ts).astype("datetime64[us]"),
            entry_price=np.where(in_trade, price, np.nan),
            pnl=np.where(sold, (close - price) * lot, np.nan),
            minutes_held=np.where(sold, (ts - entered) / 60e6, np.nan),
            entries=counts,
        )
        trade = (int(entered[-1]), float(price[-1])) if held else (None, None)
        state.update((oi[-keep:].tolist(), int(numbers[-1]), int(ts[-1]), newest, *trade, entries, day, *waiting))

    return step


def live_bars(
    df: DataFrame,
    preset="absolute",
    lot: int = 25,
    cap: int | None = None,
    per: str = "run",
    spec: SeriesSpec = BAR_SERIES,
    delay: float = 0,
    **params,
) -> DataFrame:
    """Every bar of the stream with derivatives, signal, the order it causes and the position after it.

    BUY acts only when flat, SELL only in a position.  ``cap`` stops entering after that many entries per run or day.
    ``delay`` is in seconds.  Of waiting bars of one time the one of the lowest close, then open interest, is taken; all others are
    ``skipped``, as are bars without a time and those that come when a newer one has been taken: these have no signal and no action.
    """
    if per not in ("run", "day"):
        raise ValueError(f"per must be 'run' or 'day', not {per!r}")
    rule = rule_of(preset, **params)
    keys = [T.StructField(k, df.schema[k].dataType) for k in spec.keys]
    bars = df.select(*spec.keys, F.col(spec.ts).alias("ts"), "close", "oi")
    stepped = (
        (with_ticks(bars, "ts", delay) if delay else bars)
        .groupBy(*spec.keys)
        .applyInPandasWithState(
            _live_stepper(spec.keys, rule, lot, cap, per, round(delay * 1e6)),
            T.StructType(keys + LIVE_FIELDS),
            STATE,
            "append",
            GroupStateTimeout.EventTimeTimeout if delay else GroupStateTimeout.NoTimeout,
        )
    )
    numbers = ("close", "doi", "d2oi", "oi_ma", "entry_price", "pnl", "minutes_held")
    clean = stepped.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in numbers})
    live = signal_columns(clean, rule, F.col("nth") >= 2)
    return live.withColumns({c: F.when(~F.col("skipped"), F.col(c)) for c in ("signal", "reason")})


def stream_signals(df: DataFrame, preset="absolute", spec: SeriesSpec = BAR_SERIES, delay: float = 0, **params) -> DataFrame:
    """Derivatives and classification of each new bar."""
    live = live_bars(df, preset, spec=spec, delay=delay, **params).filter(~F.col("skipped"))
    return live.select(*spec.keys, "ts", "close", "doi", "d2oi", "oi_ma", "signal", "reason")


def stream_skipped(df: DataFrame, preset="absolute", spec: SeriesSpec = BAR_SERIES, delay: float = 0, **params) -> DataFrame:
    """The bars that the other live streams do not take: repeated times, and bars later than ``delay``."""
    return live_bars(df, preset, spec=spec, delay=delay, **params).filter("skipped").select(*spec.keys, "ts", "close")


def stream_positions(
    df: DataFrame, preset="absolute", lot: int = 25, spec: SeriesSpec = BAR_SERIES, delay: float = 0, **params
) -> DataFrame:
    """Round trips as they are closed: entry, exit, profit of the lot, minutes held, reason."""
    closed = live_bars(df, preset, lot, spec=spec, delay=delay, **params).filter(F.col("action") == "SELL")
    return closed.select(
        *spec.keys, "entry_ts", "entry_price", F.col("ts").alias("exit_ts"), F.col("close").alias("exit_price"),
        "pnl", "minutes_held", F.col("reason").alias("exit_reason"),
    )


def stream_trade_cap(
    df: DataFrame, cap: int, per: str = "run", preset="absolute", spec: SeriesSpec = BAR_SERIES, delay: float = 0, **params
) -> DataFrame:
    """Orders while no more than ``cap`` positions are entered per run or day and instrument."""
    acting = live_bars(df, preset, cap=cap, per=per, spec=spec, delay=delay, **params).filter(F.col("action").isNotNull())
    return acting.select(*spec.keys, "ts", "action", "close", F.col("entries").alias("entry_no"))


#: Times are microseconds since 1970; orders that wait for their turn and entries of open trades are pickled, as keys have any type.
CAP_STATE = T.StructType(
    [
        T.StructField("entries", T.LongType()),
        T.StructField("day", T.LongType()),
        T.StructField("newest", T.LongType()),
        T.StructField("waiting", T.BinaryType()),
        T.StructField("held", T.BinaryType()),
    ]
)


def stream_cap_across(live: DataFrame, cap: int, per: str = "run", spec: SeriesSpec = BAR_SERIES, delay: float = 0) -> DataFrame:
    """Orders of live bars of all instruments while no more than ``cap`` positions are entered per run or day, by one counter.

    Orders are merged in the order of time, then keys; one has its turn when a bar ``delay`` seconds newer has been seen.
    A position that was not entered is not left either, and its instrument stays out until its next entry.  An order that comes later than
    that is counted when it comes.  Rows without a time and skipped ones are no orders.

    ``live`` is a stream of the table that a ``live_bars`` stream writes, as Spark allows one state of this kind in a query;
    ``delay`` must cover the time that a batch of it spans.
    One task keeps the counter, as each entry needs the number of those before; it sees orders only, and remembers those of
    the last ``delay`` seconds and at most ``cap`` open trades of a run or day.  For a cap per run, ``live_bars`` may be given the same
    ``cap``: the first entries of all are among the first of each instrument.
    """
    if per not in ("run", "day"):
        raise ValueError(f"per must be 'run' or 'day', not {per!r}")
    keys = [T.StructField(k, live.schema[k].dataType) for k in spec.keys]
    fields = [T.StructField("ts", T.TimestampType()), T.StructField("action", T.StringType()), T.StructField("close", T.DoubleType())]
    bars = with_ticks(live.select(*spec.keys, "ts", "action", "close", "entry_ts"), "ts", delay)
    orders = bars.filter((F.col("action").isNotNull() & F.col("ts").isNotNull()) | F.col(CLOCK).isNotNull())
    out = T.StructType([*keys, *fields, T.StructField("entry_no", T.LongType())])
    return orders.withColumn("__all", F.lit(0)).groupBy("__all").applyInPandasWithState(
        _cap_counter(spec.keys, cap, per, round(delay * 1e6)), out, CAP_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def _cap_counter(keys: tuple[str, ...], cap: int, per: str, delay: int):
    """Counts entries in the order of time.  Self-contained: it travels to the workers by value."""
    day_length, clock = DAY, CLOCK

    def count(key, batches, state):
        import pickle

        import numpy as np
        import pandas as pd

        entries, day, newest, waiting, held = 0, None, None, [], {}
        if state.exists:
            entries, day, newest, *lists = state.get
            waiting, held = map(pickle.loads, lists)
        micros = lambda c: c.to_numpy("datetime64[us]").astype(np.int64).tolist()
        for b in batches:
            ticks = b[clock].notna()
            if ticks.any():
                newest = max(micros(b[clock][ticks]) + ([] if newest is None else [newest]))
            b = b[~ticks]
            if len(b):
                waiting += zip(micros(b["ts"]), zip(*[b[k] for k in keys]), b["action"], b["close"], micros(b["entry_ts"]))
        # a row's keys as text put missing ones in a place of their own
        waiting.sort(key=lambda order: (order[0], [(k is None, "" if k is None else k) for k in order[1]], order[2]))
        passed = state.getCurrentWatermarkMs() * 1000
        horizon = max([h for h in (None if newest is None else newest - delay, passed or None) if h is not None], default=None)
        ready = 0 if horizon is None else sum(1 for order in waiting if order[0] <= horizon)
        done = []
        for ts, row, action, close, entry_ts in waiting[:ready]:
            if per == "day" and (day is None or ts // day_length > day):
                day, entries = ts // day_length, 0
            if action == "BUY":
                if entries < cap:
                    entries += 1
                    held[row] = (ts, entries)
                    done.append((*row, ts, action, close, entries))
            elif row in held and held[row][0] == entry_ts:
                done.append((*row, ts, action, close, held.pop(row)[1]))
        waiting = waiting[ready:]
        state.update((entries, day, newest, pickle.dumps(waiting), pickle.dumps(held)))
        if waiting:
            state.setTimeoutTimestamp(max(-(-waiting[0][0] // 1000), 1))
        if done:
            out = pd.DataFrame(done, columns=[*keys, "ts", "action", "close", "entry_no"])
            yield out.assign(ts=out["ts"].to_numpy("datetime64[us]"))

    return count
