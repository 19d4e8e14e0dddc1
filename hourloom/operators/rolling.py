"""Row-frame window expressions. Each takes the window of the block layout."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from hourloom.operators.layout import POS, REL


@lru_cache(maxsize=64)
def last_rows(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def rolling_mean(name: str, n: int, w: WindowSpec) -> Column:
    return F.avg(name).over(last_rows(w, n))


def rolling_mean_min(name: str, n: int, least: int, w: WindowSpec) -> Column:
    """Mean over n rows, NULL below ``least`` values.

    Rounded to 9 decimals: these means are truncated next, and the order in which a sum
    was added up must not decide on which side of a cut it falls.
    """
    frame = last_rows(w, n)
    return F.when(F.count(name).over(frame) >= least, F.round(F.avg(name).over(frame), 9))


def rolling_std(name: str, n: int, w: WindowSpec) -> Column:
    """Sample deviation; a single value has none."""
    return F.stddev_samp(name).over(last_rows(w, n))


def rolling_max(name: str, n: int, w: WindowSpec) -> Column:
    return F.max(name).over(last_rows(w, n))


def rolling_trend(name: str, n: int, w: WindowSpec) -> Column:
    """Least-squares slope per row; NULL for one row or when the frame has a missing value.

    Without gaps the positions in a frame are consecutive, so their mean and spread are known
    and one sum of products is all the frame has to gather.
    """
    frame = last_rows(w, n)
    value = F.col(name)
    rows = F.least(F.col(POS), F.lit(n)).cast("double")
    whole = (rows >= 2) & (F.count(value).over(frame) == rows)
    centre = F.col(REL) - (rows - 1) / 2
    products = F.sum(F.col(REL) * value).over(frame) - centre * F.sum(value).over(frame)
    return F.when(whole, products * 12 / (rows * (rows * rows - 1)))


def lag(name: str, k: int, w: WindowSpec) -> Column:
    return F.lag(name, k).over(w)


def lead(name: str, k: int, w: WindowSpec) -> Column:
    return F.lead(name, k).over(w)


def change(name: str, k: int, w: WindowSpec) -> Column:
    return F.col(name) - F.lag(name, k).over(w)


def hours_since_previous(ts: str, w: WindowSpec) -> Column:
    seconds = F.unix_timestamp(ts)
    return (seconds - F.lag(seconds, 1).over(w)) / F.lit(3600.0)


def rolling_mean_time(name: str, hours: int, ts: str, w: WindowSpec) -> Column:
    """Gap-safe variant: the frame is a span of time, not a number of rows.

    ``w`` is a block window; hourly rows are unique, so a span of n hours holds at most
    n rows and the same halo covers it.
    """
    seconds = F.unix_timestamp(ts)
    frame = w.orderBy(seconds).rangeBetween(-(hours - 1) * 3600, 0)
    return F.avg(name).over(frame)
