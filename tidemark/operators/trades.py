"""Trade ledger: the one-position state machine with stop-loss and take-profit.

Whether a trade is stopped depends on the price it was filled at, so in general a trade is followed bar by bar.  Little
of a series needs that.  A bar whose exit holds however the trade was entered, and which is no entry, leaves
every position flat; such bars cut a series into segments that start flat and do not influence each other.

1. Windows over the series give flags, next-bar fills and segment numbers; bars before the first entry of a
   segment cannot trade and are dropped.
2. Windows over the segments, which spread even a single long series over the cluster, follow the first trade of each
   segment: its entry is known, so stops can be tested per bar.  If it ends with its segment, it is complete.
3. Only from the first stop, or the first bar that is entry and exit at once, does Python step through the
   rest of the segment, batch by batch with a constant amount of state.

A segment may be as long as its series.  Series that are cut into slices are therefore followed slice by slice (``carried``).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import minutes_between
from tidemark.functions.rules import FIRST_EXIT, SECOND_EXIT, Rule, is_true, rule_of
from tidemark.operators.carried import carried_trades
from tidemark.operators.signals import derivative_columns, stop_take
from tidemark.operators.swept import swept_trades
from tidemark.plans.series import BAR_SERIES, Layout, SeriesSpec, layout
from tidemark.schema import TRADE_FIELDS, fields_of

SEGMENT = "__segment"
DONE, OPEN, STEP = 1, 2, 3


def _decisions(rule: Rule) -> dict[str, Column]:
    """What a rule says about a bar, as expressions over its derivative columns."""
    ready = F.col(rule.ma).isNotNull() if rule.ma_period else F.lit(True)
    first, second = F.lit(False), rule.second_exit()
    if rule.both:
        first, second = rule.exit(), F.lit(False)
    elif not rule.held:
        first = rule.first_exit()
    entry = ready & rule.entry()
    return {
        "__entry": entry,
        "__first": ready & first,
        "__second": ready & second,
        # an order decided on the last bar is never filled
        "__decides": ready & F.col("__fill_ts").isNotNull(),
        "__leaves": ready & rule.certain_exit() & ~entry,
    }


def _with_fills(lay: Layout, df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Where a decision is filled, and the averages of the bar before."""
    w = lay.window
    fills = {"__fill_ts": F.lead(lay.spec.ts).over(w), "__fill": F.lead("open").over(w)}
    return df.withColumns(fills | {f"__before_{m}": F.lag(m).over(w) for m in {r.ma for r in rules}})


def tradable_bars(lay: Layout, df: DataFrame, rule: Rule) -> DataFrame:
    """Bars that may trade, with decisions, next-bar fill and segment number.  Needs a layout with one row of lookahead."""
    w, spec = lay.window, lay.spec
    decisions = _decisions(rule)
    df = _with_fills(lay, df, [rule]).withColumn("__leaves", decisions["__leaves"])
    df = df.withColumn("__opens", F.coalesce(F.lag("__leaves").over(w), F.lit(False)))
    opens, entered = F.col("__opens"), F.when(decisions["__entry"], F.lit(1)).otherwise(F.lit(0))
    running = {
        SEGMENT: ("sum", F.when(opens, F.lit(1)).otherwise(F.lit(0))),
        "__entries": ("sum", entered),
        "__before": ("last", F.when(opens, F.col("__entries") - entered), "__entries"),
    }
    df = lay.finish(lay.running(df, **running)).filter(F.col("__entries") > F.coalesce(F.col("__before"), F.lit(0)))
    parts = [decisions[n].alias(n) for n in ("__entry", "__first", "__second", "__decides")]
    return df.select(*spec.keys, spec.ts, *spec.ties, "close", "doi", "__fill_ts", "__fill", SEGMENT, *parts, F.col(f"__before_{rule.ma}").alias("__held_ma"))


def segment_columns(bars: DataFrame, spec: SeriesSpec, rule: Rule) -> DataFrame:
    """Bars that matter to trades, with the entry of their segment's first trade.

    ``__outcome`` is DONE on the bar that completes the first trade, OPEN on the last bar of the series while it is
    held, STEP from the first bar on that ends a trade inside its segment.
    """
    w = spec.window(SEGMENT)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    entry = {"entry_signal_ts": spec.ts, "entry_ts": "__fill_ts", "entry_price": "__fill", "__entry_ma": "__held_ma"}
    bars = bars.withColumns({n: F.first(c).over(so_far) for n, c in entry.items()} | {"__nth": F.row_number().over(w)})
    stopped = F.lit(False)
    if rule.stop_loss is not None or rule.take_profit is not None:
        reason = stop_take(F.col("entry_price"), F.col("close"), rule.stop_loss, rule.take_profit)
        stopped = reason.isNotNull()
    if rule.held:
        stopped = stopped | is_true(F.col("doi") > F.lit(rule.exit_first_level) * F.col("__entry_ma"))
    leaves = F.col("__first") | F.col("__second")
    held = F.col("__decides") & (F.col("__nth") > 1)
    inside = held & (stopped | (F.col("__entry") & leaves))
    bars = bars.withColumn("__inside", F.max(inside).over(so_far))
    outcome = (
        F.when(F.col("__inside"), F.lit(STEP))
        .when(held & leaves, F.lit(DONE))
        .when(~F.col("__decides") & (F.col("__nth") > 1), F.lit(OPEN))
    )
    return bars.withColumn("__outcome", outcome).filter(F.col("__outcome").isNotNull()).drop("__inside", "__nth")


def _stepper(keys, ts, rule: Rule):
    """The state machine over the sorted bars of unfinished segments; finished trades pass through as columns.

    Self-contained, so that it travels to the Python workers by value.
    """
    held_level = rule.exit_first_level if rule.held else None
    stop = 1 - rule.stop_loss if rule.stop_loss is not None else None
    take = 1 + rule.take_profit if rule.take_profit is not None else None
    first_reason, second_reason, done_code, step_code = FIRST_EXIT, SECOND_EXIT, DONE, STEP
    names = [*keys, *[f.name for f in TRADE_FIELDS]]
    segment_names = [*keys, SEGMENT]
    entry_names = ["entry_signal_ts", "entry_ts", "entry_price", "__entry_ma"]
    bar_names = [ts, "close", "doi", "__entry", "__first", "__second", "__decides", "__fill_ts", "__fill", "__held_ma"]

    def reason_to_leave(close, doi, first, second, price, held_ma):
        if price and stop is not None and close <= price * stop:
            return "STOP LOSS"
        if price and take is not None and close >= price * take:
            return "TAKE PROFIT"
        if first or (held_level is not None and doi > held_level * held_ma):
            return first_reason
        return second_reason if second else None

    def step(batches: Iterator):
        import pyarrow as pa
        import pyarrow.compute as pc

        def finished(batch):
            """First trades that ended with their segment, or are still open."""
            closes = pc.equal(batch["__outcome"], done_code)
            only_closed = lambda c: pc.if_else(closes, c, pa.scalar(None, c.type))
            reason = pc.if_else(batch["__first"], first_reason, second_reason)
            exits = [only_closed(c) for c in (batch[ts], batch["__fill_ts"], batch["__fill"], reason)]
            return pa.RecordBatch.from_arrays([batch[n] for n in (*keys, *entry_names[:3])] + exits, names)

        def plain(c):
            """Values as a list; times as numbers.  A missing number is NaN, which no level compares with."""
            if pa.types.is_timestamp(c.type):
                c = pc.fill_null(c.cast(pa.int64()), 0)
            fixed = pa.types.is_floating(c.type) or pa.types.is_boolean(c.type) or not c.null_count and pa.types.is_integer(c.type)
            return c.to_numpy(zero_copy_only=False).tolist() if fixed else c.to_pylist()

        def listed(batch, columns):
            return zip(*[plain(batch[c]) for c in columns])

        def table(trades, key_types, time_type):
            types = [*key_types, time_type, time_type, pa.float64(), time_type, time_type, pa.float64(), pa.string()]
            columns = zip(*trades)
            return pa.RecordBatch.from_arrays([pa.array(c, t, from_pandas=True) for c, t in zip(columns, types)], names)

        key, held, types = None, None, None
        for batch in batches:
            types = [batch[k].type for k in keys], batch[ts].type
            stepping = pc.equal(batch["__outcome"], step_code)
            rest = batch.filter(pc.invert(stepping))
            if rest.num_rows:
                yield finished(rest)
            batch = batch.filter(stepping)
            done = []
            rows = zip(listed(batch, segment_names), listed(batch, entry_names), listed(batch, bar_names))
            for segment, first_trade, (at, close, doi, entry, first, second, decides, fill_ts, fill, ma) in rows:
                if segment != key:
                    if held:
                        done.append((*key[:-1], *held[:3], None, None, None, None))
                    key, held = segment, first_trade
                if not decides:
                    continue
                if held is None:
                    if entry:
                        held = (at, fill_ts, fill, ma)
                    continue
                reason = reason_to_leave(close, doi, first, second, held[2], held[3])
                if reason:
                    done.append((*key[:-1], *held[:3], at, fill_ts, fill, reason))
                    held = None
            if done:
                yield table(done, *types)
        if held:
            yield table([(*key[:-1], *held[:3], None, None, None, None)], *types)

    return step


def trades_of(bars: DataFrame, spec: SeriesSpec, rule: Rule) -> DataFrame:
    """Trades in the shape of ``TRADE_FIELDS`` from tradable bars."""
    rows = segment_columns(bars, spec, rule)
    schema = T.StructType(fields_of(rows.schema, spec.keys) + TRADE_FIELDS)
    # the windows have brought segments together and sorted them: this sort is dropped from the plan
    in_order = rows.sortWithinPartitions(*spec.keys, SEGMENT, *spec.order)
    return in_order.mapInArrow(_stepper(spec.keys, spec.ts, rule), schema)


def all_trades(
    df: DataFrame,
    preset="share_of_ma",
    commission: float = 0.001,
    size: int = 1,
    spec: SeriesSpec = BAR_SERIES,
    **params,
) -> DataFrame:
    """Closed trades and, with NULL exits, the ones still open at the end of their series."""
    rule = rule_of(preset, **params)
    lay = layout(df, spec, lookback=rule.lookback + 1, lookahead=1)
    return followed(lay, derivative_columns(lay.df, lay.window, rule), [rule], commission, size)


def followed(lay: Layout, df: DataFrame, rules: list[Rule], commission: float, size: int, param: str | None = None, brief: bool = False) -> DataFrame:
    """Trades of every series under each of the rules, whose number stands in the column ``param``.

    ``brief`` asks for no more than accounts need: other fields of the trades may be NULL.
    """
    if lay.split:
        raw = carried_trades(lay, _with_fills(lay, df, rules), rules, [_decisions(r) for r in rules], param)
        return priced(raw, (*([param] if param else []), *lay.spec.keys), commission, size)
    if param:
        raw = swept_trades(lay, _with_fills(lay, df, rules), rules, [_decisions(r) for r in rules], param, brief)
        return priced(raw, (param, *lay.spec.keys), commission, size)
    spec = lay.spec
    raw = trades_of(tradable_bars(lay, df, rules[0]), spec, rules[0])
    in_order = Window.partitionBy(*spec.keys).orderBy("entry_ts")
    return priced(raw.withColumn("trade_no", F.row_number().over(in_order).cast("bigint")), spec.keys, commission, size)


def priced(numbered: DataFrame, keys: tuple[str, ...], commission: float, size: int) -> DataFrame:
    """Profit and commission of numbered trades."""
    pnl = (F.col("exit_price") - F.col("entry_price")) * F.lit(size)
    turnover = F.coalesce(F.col("exit_price"), F.lit(0.0)) + F.col("entry_price")
    fees = turnover * F.lit(commission) * F.lit(size)
    numbered = numbered.withColumns({"size": F.lit(size), "pnl": pnl, "commission": fees})
    return numbered.select(
        *keys, "trade_no", "entry_signal_ts", "entry_ts", "entry_price", "exit_signal_ts", "exit_ts",
        "exit_price", "size", "pnl", "commission", (F.col("pnl") - F.col("commission")).alias("pnl_net"),
        "exit_reason",
    )


def closed(trades: DataFrame) -> DataFrame:
    return trades.filter(F.col("exit_ts").isNotNull())


def trade_ledger(df: DataFrame, preset="share_of_ma", commission=0.001, size=1, spec=BAR_SERIES, **params):
    """Closed trades of every series under a rule, filled at the open of the bar after the decision."""
    return closed(all_trades(df, preset, commission, size, spec, **params))


def round_trip_pnl(trades: DataFrame, lot: int = 25) -> DataFrame:
    """Profit of a fixed lot and minutes held, per trade."""
    return trades.withColumns(
        {
            "lot_pnl": (F.col("exit_price") - F.col("entry_price")) * F.lit(lot),
            "minutes_held": minutes_between(F.col("exit_ts"), F.col("entry_ts")),
        }
    )
