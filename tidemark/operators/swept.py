"""Trades under many parameter sets, followed together.

The decisions of all sets on a bar are a few numbers with a bit for each set, so a sweep shuffles and sorts each bar
once, whatever the number of sets, and adds no columns to the windows.  Sorted bars then pass through Python in Arrow batches: the
series of a batch are followed side by side, a step for each bar of the longest, and every step treats all sets of all
series at once.  What is kept from batch to batch is the open trade of each set in one series.

Numbered trades come out: nothing is left to shuffle but what the caller groups.  Series too long for one task are
followed slice by slice (``carried``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.functions.rules import FIRST_EXIT, SECOND_EXIT, Rule
from tidemark.operators.carried import DECISIONS, WORD, decision_bits
from tidemark.plans.series import Layout
from tidemark.schema import TRADE_FIELDS, fields_of

#: Bars that are followed at a time, at least, but for a task's last ones: Arrow batches are put together up to there, whatever the session sends.
AT_A_TIME = 1 << 16
#: What an account needs of a trade.
BRIEF = ("entry_price", "exit_ts", "exit_price")


def swept_trades(lay: Layout, df: DataFrame, rules: list[Rule], decisions: list[dict[str, Column]], param: str,
                 brief: bool = False) -> DataFrame:
    """Trades under each of the rules, whose number stands in ``param``, in the shape of ``TRADE_FIELDS`` behind keys and ``trade_no``.

    ``df`` is ``lay.df`` with derivatives, fills and averages, its series whole.  The rules differ in levels and averages only, and
    none has levels that are held from a trade's entry.  A missing close or fill price meets no level; without a fill price,
    or with one of zero, a trade is not stopped.  ``brief`` leaves all but ``BRIEF`` of a trade's fields NULL: they are not made.
    """
    spec, first = lay.spec, rules[0]
    df = df.withColumns({"__opens": F.row_number().over(lay.window) == 1} | decision_bits(rules, decisions))
    bits = [f"__{name}_{i}" for name in DECISIONS for i in range(-(-len(rules) // WORD))]
    bars = df.select(*spec.keys, F.col(spec.ts).alias("__ts"), *spec.ties, "__fill_ts", F.col("__fill").cast("double").alias("__fill"),
                     F.col("close").cast("double").alias("close"), "__opens", *bits)
    out = T.StructType([T.StructField(param, T.IntegerType()), *fields_of(bars.schema, spec.keys), T.StructField("trade_no", T.LongType()), *[f for f in TRADE_FIELDS if f.name in BRIEF or not brief]])
    stop = 1 - first.stop_loss if first.stop_loss is not None else None
    take = 1 + first.take_profit if first.take_profit is not None else None
    # the windows have brought the series together and sorted them: this sort is dropped from the plan
    in_order = bars.sortWithinPartitions(*spec.keys, "__ts", *spec.ties)
    trades = in_order.mapInArrow(_follower(spec.keys, len(rules), stop, take, out), out)
    return trades.withColumns({f.name: F.lit(None).cast(f.dataType) for f in TRADE_FIELDS if f.name not in out.names})


def _follower(keys: tuple[str, ...], n_rules: int, stop: float | None, take: float | None, out: T.StructType):
    """The state machine of all rules over sorted bars.  Self-contained, so that it travels to the Python workers by value."""
    word, at_a_time, reasons = WORD, AT_A_TIME, ["STOP LOSS", "TAKE PROFIT", FIRST_EXIT, SECOND_EXIT]
    schema = to_arrow_schema(out)
    sources = {"signal_ts": "__ts", "ts": "__fill_ts", "price": "__fill"}

    def decided(table, name):
        """A row for each bar, a column for each rule."""
        import numpy as np

        words = [table.column(f"__{name}_{i}").to_numpy() for i in range(-(-n_rules // word))]
        return np.stack([words[rule // word] >> (rule % word) & 1 for rule in range(n_rules)], axis=1).astype(bool)

    def trades(table, rules, numbers, entered, left, why):
        """Rows of the result; ``entered`` and ``left`` are rows of ``table``, the latter -1 for open trades."""
        import numpy as np
        import pyarrow as pa

        bars, at = pa.array(entered), pa.array(left, mask=left < 0)
        columns = [pa.array(rules), *[table.column(k).take(bars) for k in keys], pa.array(numbers)]
        for name in schema.names[len(columns):]:
            if name == "exit_reason":
                columns.append(pa.array(reasons).take(pa.array(why, mask=left < 0)))
            else:
                end, _, of = name.partition("_")
                columns.append(table.column(sources[of]).take(bars if end == "entry" else at))
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    def gathered(batches):
        import pyarrow as pa

        waiting, n = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                n += batch.num_rows
            if n >= at_a_time:
                yield pa.Table.from_batches(waiting).combine_chunks()
                waiting, n = [], 0
        if n:
            yield pa.Table.from_batches(waiting).combine_chunks()

    def follow(batches):
        import numpy as np
        import pyarrow as pa

        kept = None  # the bars at which the open trades of the series at hand were entered
        held_from, count, number = np.full(n_rules, -1), np.zeros(n_rules, np.int64), np.zeros(n_rules, np.int64)
        for table in gathered(batches):
            before = 0 if kept is None else kept.num_rows
            table = table if not before else pa.concat_tables([kept, table]).combine_chunks()
            n = table.num_rows
            close, fill = (table.column(c).to_numpy() for c in ("close", "__fill"))
            entry, first, second, decides = (decided(table, name) for name in DECISIONS)
            entry, leaves, price = entry & decides, (first | second) & decides, np.where(fill != 0, fill, np.nan)
            opens = table.column("__opens").to_numpy()
            # the first rows go on with the series at hand, if any do; it has come to its end otherwise
            starts = np.unique(np.concatenate([[before], before + np.flatnonzero(opens[before:])]))
            goes_on = not opens[before]
            done = []
            if not goes_on:
                open_ = np.flatnonzero(held_from >= 0)
                if len(open_):
                    done.append((open_, number[open_], held_from[open_], np.full(len(open_), -1), np.zeros(len(open_), int)))
                held_from, count, number = np.full(n_rules, -1), np.zeros(n_rules, np.int64), np.zeros(n_rules, np.int64)
            lengths = np.diff([*starts, n])
            longest_first = np.argsort(-lengths, kind="stable")
            begin, length = starts[longest_first], lengths[longest_first]
            shape = (len(begin), n_rules)
            held, total, nth = np.full(shape, -1), np.zeros(shape, np.int64), np.zeros(shape, np.int64)
            at_hand = int(np.flatnonzero(longest_first == 0)[0])
            held[at_hand], total[at_hand], nth[at_hand] = held_from, count, number
            since = np.where(held >= 0, price[held], np.nan)
            lower, upper = since * (np.nan if stop is None else stop), since * (np.nan if take is None else take)
            running = np.searchsorted(-length, -np.arange(length[0]), "left")  # series that have a bar at each step
            for t in range(length[0]):
                a = running[t]
                rows = begin[:a] + t
                in_trade, now = held[:a] >= 0, close[rows, None]
                stopped, taken = now <= lower[:a], now >= upper[:a]
                ends = in_trade & (leaves[rows] | (decides[rows] & (stopped | taken)))
                enters = entry[rows] & ~in_trade
                if ends.any():
                    s, r = np.nonzero(ends)
                    bar = rows[s]
                    why = np.where(stopped[s, r], 0, np.where(taken[s, r], 1, np.where(first[bar, r], 2, 3)))
                    done.append((r, nth[s, r], held[s, r], bar, why))
                    held[s, r], lower[s, r], upper[s, r] = -1, np.nan, np.nan
                if enters.any():
                    s, r = np.nonzero(enters)
                    bar = rows[s]
                    held[s, r] = bar
                    total[s, r] += 1
                    nth[s, r] = total[s, r]
                    if stop is not None:
                        lower[s, r] = price[bar] * stop
                    if take is not None:
                        upper[s, r] = price[bar] * take
            last = int(np.flatnonzero(longest_first == len(begin) - 1)[0])
            s, r = np.nonzero(held >= 0)
            s, r = s[s != last], r[s != last]
            if len(s):
                done.append((r, nth[s, r], held[s, r], np.full(len(s), -1), np.zeros(len(s), int)))
            if done:
                yield trades(table, *(np.concatenate(c) for c in zip(*done)))
            count, number, held_from = total[last], nth[last], np.full(n_rules, -1)
            open_ = np.flatnonzero(held[last] >= 0)
            held_from[open_] = np.arange(len(open_))
            kept = table.take(pa.array(held[last][open_]))
        open_ = np.flatnonzero(held_from >= 0)
        if len(open_):
            yield trades(kept, open_, number[open_], held_from[open_], np.full(len(open_), -1), np.zeros(len(open_), int))

    return follow
