"""Trades of long series, slice by slice.

A trade with stops is followed bar by bar, and a series may never be flat for certain.  So that even such a series spreads over
its slices, each slice is first reduced to a function: from the trade carried into it (or none) to the trade carried out.  An
unknown trade ends in a slice at the first bar that leaves in any case, or before, where the close falls below or rises above
levels that depend on its price.  Only bars at which the lowest or highest close so far changes (records) can be that bar, so
the function is a few sorted lists: the records, and for each bar at which the carried trade may end, the trade that is open at the
end of the slice if one is flat from there on.

1. Every slice gives the functions of the series that reach over its ends.
2. They are applied one after the other, a row for each slice of a series, which gives the trade carried into each slice.
3. Every slice follows its trades from there.

All rules of a sweep share the rows: their decisions travel as bits, ``WORD`` rules to a number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.functions.rules import FIRST_EXIT, SECOND_EXIT, Rule
from tidemark.plans.series import Layout
from tidemark.schema import TRADE_FIELDS, fields_of

WORD = 60
DECISIONS = ("entry", "first", "second", "decides")
#: The levels of a rule, and those that a decision reads.
LEVELS = ("entry_level", "exit_first_level", "exit_second_level")
READS = {"entry": LEVELS[:1], "first": LEVELS[1:], "second": LEVELS[2:], "decides": ()}


def decision_bits(rules: list[Rule], decisions: list[dict[str, Column]]) -> dict[str, Column]:
    """The decisions of all rules, ``WORD`` rules to a column.  Rules that agree in all that a decision reads share its test."""
    out = {}
    for name in DECISIONS:
        ignored = {level: 0.0 for level in LEVELS if level not in READS[name]}
        for word in range(0, len(rules), WORD):
            tests: dict[Rule, tuple[Column, int]] = {}
            for i, (rule, d) in enumerate(zip(rules[word:word + WORD], decisions[word:word + WORD])):
                test, mask = tests.get(rule.with_(**ignored), (d[f"__{name}"], 0))
                tests[rule.with_(**ignored)] = test, mask | 1 << i
            bits = F.lit(0).cast("bigint")
            for test, mask in tests.values():
                bits = bits + F.when(test, F.lit(mask).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
            out[f"__{name}_{word // WORD}"] = bits
    return out


def carried_trades(lay: Layout, df: DataFrame, rules: list[Rule], decisions: list[dict[str, Column]], param: str | None = None) -> DataFrame:
    """Trades under each of the rules, numbered in their series, in the shape of ``TRADE_FIELDS`` behind keys and ``trade_no``.

    ``df`` is ``lay.df`` with derivatives, fills and averages; ``lay`` needs a row of lookback and one of lookahead.  The rules differ
    in levels and averages only.
    """
    w, spec, first = lay.window, lay.spec, rules[0]
    starts, ends = F.lag(lay.place).over(w).isNull(), F.lead(lay.place).over(w).isNull()
    # own rows stand together, so the first one follows a halo row or none
    opens = ~F.coalesce(F.lag(lay.own).over(w), F.lit(False))
    df = df.withColumns({"__starts": starts, "__ends": ends, "__opens": opens} | decision_bits(rules, decisions)).filter(lay.own)
    bits = [f"__{name}_{i}" for name in DECISIONS for i in range(-(-len(rules) // WORD))]
    keys = [k for k in spec.keys if k != param]
    before = f"__before_{first.ma}"
    bars = df.select(
        F.col(lay.slice).alias("__slice"), F.col(lay.place).alias("__place"), *keys, F.col(spec.ts).alias("__ts"), "__fill_ts", "__fill", "close",
        "doi", F.col(before).cast("double").alias("__ma"), "__starts", "__ends", "__opens", *bits)

    key_fields = fields_of(bars.schema, keys)
    time = T.LongType() if isinstance(bars.schema["__ts"].dataType, (T.TimestampType, T.TimestampNTZType)) else bars.schema["__ts"].dataType
    state = [T.StructField("signal_at", time), T.StructField("filled_at", time), T.StructField("price", T.DoubleType()), T.StructField("ma", T.DoubleType())]
    rule_field = T.StructField("__rule", T.IntegerType())
    lists = [T.StructField(f.name, T.ArrayType(f.dataType)) for f in state]
    records = [T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("lows", "highs", "tops")]
    places = [T.StructField(n, T.ArrayType(T.LongType())) for n in ("lows_at", "highs_at", "tops_at", "ends_at", "entries")]
    function = T.StructType([T.StructField("__slice", T.LongType()), *key_fields, rule_field, T.StructField("certain", T.LongType()), *records, *places, *lists])
    entering = T.StructType([T.StructField("__slice", T.LongType()), *key_fields, rule_field, T.StructField("entered", T.LongType()), *state])
    trades = T.StructType([*([T.StructField(param, T.IntegerType())] if param else []), *key_fields, T.StructField("trade_no", T.LongType()), *TRADE_FIELDS])

    held = first.exit_first_level if first.held else None
    stop = 1 - first.stop_loss if first.stop_loss is not None else None
    take = 1 + first.take_profit if first.take_profit is not None else None
    reduce_, apply_, follow = _walkers(keys, len(rules), stop, take, held, param, function, entering, trades)
    functions = bars.groupBy("__slice").applyInArrow(reduce_, function)
    by_series = functions.repartition(*keys, "__rule") if keys else functions.repartition("__rule")
    carried = by_series.sortWithinPartitions(*keys, "__rule", "__slice").mapInArrow(apply_, entering)
    return bars.groupBy("__slice").cogroup(carried.groupBy("__slice")).applyInArrow(follow, trades)


def _walkers(keys, n_rules, stop, take, held_level, param, function, entering, trades):
    """The three steps over Arrow data.  Self-contained, so that they travel to the Python workers by value."""
    first_reason, second_reason, word, block = FIRST_EXIT, SECOND_EXIT, WORD, 1024
    function_names = function.fieldNames()
    function_schema, entering_schema, trade_schema = map(to_arrow_schema, (function, entering, trades))

    def plain(c):
        """Values as numpy; times as whole numbers, missing numbers as NaN."""
        import pyarrow as pa

        if pa.types.is_timestamp(c.type):
            c = c.cast(pa.int64()).fill_null(0)  # only those of bars that decide are read
        return c.to_numpy(zero_copy_only=False)

    class Series:
        """The own rows of a series in one slice."""

        def __init__(self, table, a, b):
            part = table.slice(a, b - a)
            column = lambda name: part.column(name).combine_chunks()
            self.part, self.n = part, b - a
            self.key = tuple(column(k)[0] for k in keys)
            self.starts, self.ends = column("__starts")[0].as_py(), column("__ends")[-1].as_py()
            self.close = plain(column("close")).astype(float)
            self.doi = plain(column("doi")).astype(float)
            self.price, self.ma = plain(column("__fill")).astype(float), plain(column("__ma")).astype(float)
            self.column = column

        def under(self, rule):
            import numpy as np

            bit = rule % word
            at = lambda name: plain(self.column(f"__{name}_{rule // word}")) >> bit & 1 == 1
            self.first, self.second, decides = at("first"), at("second"), at("decides")
            self.entries = np.flatnonzero(at("entry") & decides)
            self.leaves = (self.first | self.second) & decides
            # what no level meets stands for bars that decide nothing
            self.low = np.where(decides & (self.close == self.close), self.close, np.inf)
            self.high = np.where(decides & (self.close == self.close), self.close, -np.inf)
            self.top = np.where(decides & (self.doi == self.doi), self.doi, -np.inf)
            edges = np.arange(0, self.n, block)
            self.low_of, self.high_of, self.top_of = (
                f.reduceat(v, edges) for f, v in ((np.minimum, self.low), (np.maximum, self.high), (np.maximum, self.top)))
            self.leaves_of = np.logical_or.reduceat(self.leaves, edges)
            self.after = {}
            return self

        def levels(self, price, ma):
            """The close at or below which a trade is stopped, at or above which it is taken, and the derivative above which it leaves."""
            inf = float("inf")
            lower = price * stop if price and stop is not None else -inf
            upper = price * take if price and take is not None else inf
            above = held_level * ma if held_level is not None else inf
            # NaN: nothing compares with it
            return (lower if lower == lower else -inf), (upper if upper == upper else inf), (above if above == above else inf)

        def end_of(self, k, price, ma):
            """The first bar from k on at which a trade ends, None if it is open at the end."""
            import numpy as np

            lower, upper, above = self.levels(price, ma)

            def hits(low, high, top, leaves):
                found = leaves | (high >= upper) if upper != float("inf") else leaves.copy()
                if lower != -float("inf"):
                    found = found | (low <= lower)
                return found | (top > above)

            a = k
            while a < self.n:
                b = min(self.n, (a // block + 1) * block)
                found = hits(self.low[a:b], self.high[a:b], self.top[a:b], self.leaves[a:b])
                at = int(found.argmax())
                if found[at]:
                    return a + at
                if b == self.n:
                    return None
                first_block = b // block
                found = hits(self.low_of[first_block:], self.high_of[first_block:], self.top_of[first_block:], self.leaves_of[first_block:])
                at = int(np.argmax(found))
                if not found[at]:
                    return None
                a = (first_block + at) * block
            return None

        def next_entry(self, k):
            """The first entry from bar k on."""
            import numpy as np

            at = int(np.searchsorted(self.entries, k))
            return int(self.entries[at]) if at < len(self.entries) else None

        def flat_from(self, k):
            """(number of entries from bar k on, the entry of the trade that is open at the end), being flat before k."""
            way, k = [], self.next_entry(k)
            while k is not None and k not in self.after:
                end = self.end_of(k + 1, self.price[k], self.ma[k])
                way.append(k)
                if end is None:
                    self.after[k] = (1, k)
                    way.pop()
                    break
                k = self.next_entry(end + 1)
            number, open_ = self.after[k] if k is not None else (0, None)
            for entry in reversed(way):
                number += 1
                self.after[entry] = (number, open_)
            return number, open_

        def reason(self, at, price, ma):
            lower, upper, above = self.levels(price, ma)
            if self.low[at] <= lower and lower != -float("inf"):
                return "STOP LOSS"
            if self.high[at] >= upper and upper != float("inf"):
                return "TAKE PROFIT"
            return first_reason if self.first[at] or self.top[at] > above else second_reason

    def series_of(table):
        """The series of a slice, in order."""
        import numpy as np

        table = table.sort_by("__place")
        opens = np.flatnonzero(plain(table.column("__opens").combine_chunks()))
        for a, b in zip(opens, [*opens[1:], table.num_rows]):
            yield Series(table, int(a), int(b))

    def at_of(series):
        return plain(series.column("__ts")), plain(series.column("__fill_ts"))

    def records(values, at):
        """The values before bar ``at`` that are above all earlier ones, and where they are."""
        import numpy as np

        run = np.maximum.accumulate(values[:at])
        changes = np.flatnonzero(run > np.concatenate([[-np.inf], run[:-1]])[:len(run)])
        return run[changes], changes

    def reduce_(table):
        import numpy as np
        import pyarrow as pa

        rows = []
        for s in series_of(table):
            if s.starts and s.ends:
                continue
            times, fills = at_of(s)
            number = table.column("__slice")[0].as_py()
            for rule in range(n_rules):
                s.under(rule)
                certain = np.flatnonzero(s.leaves)
                certain = int(certain[0]) if len(certain) else s.n
                empty = (np.empty(0), np.empty(0, int))
                # lows are kept with their signs turned, so that all records ascend
                lows, highs = records(-s.low, certain) if stop is not None else empty, records(s.high, certain) if take is not None else empty
                tops = records(s.top, certain) if held_level is not None else empty
                ends = np.unique(np.concatenate([lows[1], highs[1], tops[1], [certain] if certain < s.n else []]).astype(int))
                outs = [s.flat_from(0), *(s.flat_from(int(e) + 1) for e in ends)]
                value = lambda v, k: None if k is None else v[k].item()
                rows.append((
                    number, *[k.as_py() for k in s.key], rule, certain, lows[0].tolist(), highs[0].tolist(), tops[0].tolist(), lows[1].tolist(),
                    highs[1].tolist(), tops[1].tolist(), ends.tolist(), [n for n, _ in outs], *[[value(v, k) for _, k in outs] for v in (times, fills, s.price, s.ma)]))
        schema = function_schema
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema) if rows else schema.empty_table()

    def apply_(batches):
        import bisect

        import pyarrow as pa

        schema = entering_schema
        now, state, entered = None, None, 0
        walker = Series.__new__(Series)
        for batch in batches:
            rows = []
            columns = {n: batch.column(n) for n in function_names}
            for i in range(batch.num_rows):
                row = {n: c[i].as_py() for n, c in columns.items()}
                key = (*[row[k] for k in keys], row["__rule"])
                if key != now:
                    now, state, entered = key, None, 0
                rows.append((row["__slice"], *key, entered, *(state or (None,) * 4)))
                if state is None:
                    out = 0
                else:
                    price, ma = (float("nan") if x is None else x for x in state[2:])
                    lower, upper, above = walker.levels(price, ma)
                    at = []
                    if lower != -float("inf"):
                        at.append((bisect.bisect_left(row["lows"], -lower), row["lows_at"]))
                    if upper != float("inf"):
                        at.append((bisect.bisect_left(row["highs"], upper), row["highs_at"]))
                    if above != float("inf"):
                        at.append((bisect.bisect_right(row["tops"], above), row["tops_at"]))
                    bars = [places[j] for j, places in at if j < len(places)] + [row["certain"]]
                    end = bisect.bisect_left(row["ends_at"], min(bars))
                    if end == len(row["ends_at"]):
                        continue  # it is carried through
                    out = end + 1
                entered += row["entries"][out]
                signal = row["signal_at"][out]
                state = None if signal is None else (signal, row["filled_at"][out], row["price"][out], row["ma"][out])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def follow(table, carried):
        import pyarrow as pa

        schema = trade_schema
        into = {}
        for row in carried.to_pylist():
            into[(*[row[k] for k in keys], row["__rule"])] = row
        out = []
        for s in series_of(table) if table.num_rows else ():
            times, fills = at_of(s)
            key = [k.as_py() for k in s.key]
            for rule in range(n_rules):
                s.under(rule)
                row = into.get((*key, rule))
                number, held, k = 0, None, 0
                if row:
                    number = row["entered"]
                    if row["signal_at"] is not None:
                        price, ma = (float("nan") if row[x] is None else row[x] for x in ("price", "ma"))
                        held = (row["signal_at"], row["filled_at"], price, ma)
                while True:
                    if held is None:
                        k = s.next_entry(k)
                        if k is None:
                            break
                        held = (times[k].item(), fills[k].item(), s.price[k], s.ma[k])
                        number += 1
                        k += 1
                    end = s.end_of(k, held[2], held[3])
                    started = (*([rule] if param else []), *key, number, held[0], held[1], None if held[2] != held[2] else float(held[2]))
                    if end is None:
                        if s.ends:
                            out.append((*started, None, None, None, None))
                        break
                    price = float(s.price[end])
                    out.append((*started, times[end].item(), fills[end].item(), None if price != price else price, s.reason(end, held[2], held[3])))
                    held, k = None, end + 1
        if not out:
            return schema.empty_table()
        arrays = []
        for values, f in zip(zip(*out), schema):
            timed = pa.types.is_timestamp(f.type)
            arrays.append(pa.array(values, pa.int64()).cast(f.type) if timed else pa.array(values, f.type))
        return pa.Table.from_arrays(arrays, schema=schema)

    return reduce_, apply_, follow
