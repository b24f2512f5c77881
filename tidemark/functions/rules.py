"""Rule presets: what counts as an entry and as an exit.

A rule reads three columns: ``doi`` and ``d2oi`` (derivatives of open interest) and ``oi_ma`` (its moving average).
Thresholds are either shares of the moving average or absolute numbers.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_EXIT = "First derivative exit"
SECOND_EXIT = "Second derivative exit"


@dataclass(frozen=True)
class Rule:
    """Entry: ``doi < 0`` and ``d2oi`` below the entry level. Exit: a derivative above its exit level.

    ``relative`` levels are multiplied with the moving average.  ``both`` demands both exits at once.
    ``held`` takes the first exit level from the moving average of the bar before the entry signal, for
    as long as the trade lasts.  ``variant`` names the form of the derivatives, ``ma`` the column of the average.
    """

    entry_level: float
    exit_first_level: float
    exit_second_level: float
    relative: bool = False
    ma_period: int | None = None
    variant: str = "indicator"
    both: bool = False
    held: bool = False
    stop_loss: float | None = None
    take_profit: float | None = None
    ma: str = "oi_ma"

    @property
    def lookback(self) -> int:
        return max(2, self.ma_period or 0)

    def _level(self, level: float) -> Column:
        return F.lit(level) * F.col(self.ma) if self.relative else F.lit(level)

    def entry_threshold(self) -> Column:
        return self._level(self.entry_level)

    def first_exit_threshold(self) -> Column:
        return self._level(self.exit_first_level)

    def second_exit_threshold(self) -> Column:
        return self._level(self.exit_second_level)

    def entry(self) -> Column:
        return is_true((F.col("doi") < 0) & (F.col("d2oi") < self.entry_threshold()))

    def first_exit(self) -> Column:
        if self.held:
            raise ValueError("the first exit level of this rule is fixed at entry: it exists only inside a trade")
        return is_true(F.col("doi") > self.first_exit_threshold())

    def second_exit(self) -> Column:
        return is_true(F.col("d2oi") > self.second_exit_threshold())

    def exit(self) -> Column:
        if self.both:
            return self.first_exit() & self.second_exit()
        return self.first_exit() | self.second_exit()

    def certain_exit(self) -> Column:
        """Exit that does not depend on how the trade was entered."""
        return self.second_exit() if self.held else self.exit()

    def exit_reason(self) -> Column:
        return F.when(self.exit(), F.when(self.first_exit(), F.lit(FIRST_EXIT)).otherwise(F.lit(SECOND_EXIT)))

    def with_(self, **changes) -> Rule:
        return replace(self, **changes)


def is_true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def share_of_ma(entry=0.005, exit_first=0.001, exit_second=0.005, ma_period=50, stop_loss=0.15, take_profit=0.30):
    """Main rule: levels are shares of the moving average of open interest."""
    return Rule(-entry, -exit_first, -exit_second, relative=True, ma_period=ma_period, stop_loss=stop_loss,
                take_profit=take_profit)


def absolute(sensitivity=0.01, feeling=3_000_000.0, variant="rounded"):
    """Live rule: absolute levels from two tuning numbers."""
    unit = sensitivity * feeling
    return Rule(-0.1 * unit, -1 * unit, -0.1 * unit, variant=variant)


def absolute_both(sensitivity=0.01, feeling=3_000_000.0, ma_period=30):
    """As ``absolute``, but leaving only when both derivatives say so; starts when the average exists."""
    return absolute(sensitivity, feeling, variant="indicator").with_(both=True, ma_period=ma_period)


def held_ma(entry=0.002, exit_first=0.01, exit_second=0.001, ma_period=30):
    """First exit level fixed at entry."""
    return Rule(-entry, -exit_first, -exit_second, relative=True, held=True, ma_period=ma_period)


def coarse_absolute(sensitivity=7.0, feeling=9_000_000.0):
    """Absolute levels in whole numbers: the tuning product divided by 1000 and 100, rounded down."""
    unit = -1 * sensitivity * feeling
    return Rule(unit // 1000, unit // 100, unit // 1000, variant="rounded")


PRESETS = {
    "share_of_ma": share_of_ma,
    "absolute": absolute,
    "absolute_both": absolute_both,
    "held_ma": held_ma,
    "coarse_absolute": coarse_absolute,
}


def rule_of(rule: str | Rule, **params) -> Rule:
    if isinstance(rule, Rule):
        return rule.with_(**params) if params else rule
    if rule not in PRESETS:
        raise ValueError(f"unknown rule preset {rule!r}; known: {', '.join(PRESETS)}")
    return PRESETS[rule](**params)
