"""Functions over one category's daily series.

All windows are partitioned by category and run on day-level tables: item-level rows
are never windowed, and a category with a third of all sales is no larger here than any
other. A window is bounded by the calendar; where a signal may list a day more than once,
equal rows are reduced to three before (see :mod:`signalwatch.operators.copies`).

Frames count rows, not days: days without sales are skipped, not filled with 0.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from signalwatch.functions.numeric import relative_change, rescale
from signalwatch.schemas import CATEGORY


def by_time(*order: str, group: str = CATEGORY) -> WindowSpec:
    """A category's rows in time, by default by day number."""
    return Window.partitionBy(group).orderBy(*(order or ("time_sk",)))


def _last(window: WindowSpec, rows: int) -> WindowSpec:
    return window.rowsBetween(1 - rows, Window.currentRow)


def moving_average(value: Column, window: WindowSpec, rows: int = 3) -> Column:
    """Mean of the last ``rows`` rows, of fewer at the start."""
    return F.avg(value).over(_last(window, rows))


def smoothed(value: Column, window: WindowSpec, rows: int) -> Column:
    """Mean of the last ``rows`` rows, missing until there are that many."""
    frame = _last(window, rows)
    return F.when(F.count(value).over(frame) == rows, F.avg(value).over(frame))


def growth(value: Column, window: WindowSpec) -> Column:
    """Relative change from the row before, 0 on the first row."""
    return relative_change(value, F.lag(value, 1).over(window))


def step(value: Column, window: WindowSpec) -> Column:
    """Difference from the row before, 0 on the first row."""
    return F.coalesce(value - F.lag(value, 1).over(window), F.lit(0.0))


def previous(value: Column, window: WindowSpec, rows: int = 1) -> Column:
    return F.lag(value, rows).over(window)


def previous_or_zero(value: Column, window: WindowSpec) -> Column:
    return F.coalesce(F.lag(value, 1).over(window), F.lit(0))


def previous_or_current(value: Column, window: WindowSpec, rows: int) -> Column:
    return F.coalesce(F.lag(value, rows).over(window), value)


def shifted_early(value: Column, window: WindowSpec, rows: int = 3) -> Column:
    """The value ``rows`` rows later; the last ``rows`` rows keep their own."""
    return F.coalesce(F.lead(value, rows).over(window), value)


def progress(window: WindowSpec) -> Column:
    """0 on the first row to 1 on the last, in equal steps."""
    return F.percent_rank().over(window)


def group_mean(value: Column, weight: Column, group: str = CATEGORY) -> Column:
    """The category's mean on each of its rows, a row counting ``weight`` times."""
    whole = Window.partitionBy(group)
    known = F.sum(F.when(value.isNotNull(), weight)).over(whole)
    return F.try_divide(F.sum(value * weight).over(whole), known)


def spread_5_95(value: Column, group: str = CATEGORY) -> Column:
    """Rescale a category's series to 5-95; a flat series becomes 50."""
    whole = Window.partitionBy(group)
    low, high = F.min(value).over(whole), F.max(value).over(whole)
    return rescale(value, low, high, span=90.0, start=5.0, flat=50.0)
