"""Quality predicates: a value is kept when finite and in range, and NULL otherwise."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

Predicate = Callable[[Column], Column]


def finite(value: Column) -> Column:
    """TRUE for a number that is neither NULL, NaN nor infinite.

    NaN has to be excluded by name: Spark orders it above every number, so a
    range test alone lets it through.
    """
    number = value.cast("double")
    return value.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))


@dataclass(frozen=True)
class Range:
    """Predicate: between two finite ends, each open or closed."""

    low: float
    high: float
    low_open: bool = False
    high_open: bool = False

    def __call__(self, number: Column) -> Column:
        above = number > self.low if self.low_open else number >= self.low
        below = number < self.high if self.high_open else number <= self.high
        return above & below


def between(low: float, high: float, *, low_open: bool = False, high_open: bool = False) -> Range:
    return Range(low, high, low_open, high_open)


def keep_if(value: Column, predicate: Predicate | None = None) -> Column:
    """The value as DOUBLE where it is finite and passes, else NULL (never a default).

    A range with two ends already excludes NaN and both infinities, so wide adapters
    stay small enough for the JIT.
    """
    number = value.cast("double")
    if isinstance(predicate, Range):
        return F.when(predicate(number), number)
    kept = finite(value) if predicate is None else finite(value) & predicate(number)
    return F.when(kept, number)


def positive(number: Column) -> Column:
    return number > 0
