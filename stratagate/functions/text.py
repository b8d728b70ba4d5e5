"""Text clean-up steps: functions from Column to Column, NULL stays NULL."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Transform = Callable[[Column], Column]


def trim_ends(c: Column) -> Column:
    return F.trim(c)


def upper_case(c: Column) -> Column:
    return F.upper(c)


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def null_if(*sentinels: str) -> Transform:
    """Declared sentinel values become NULL."""
    return lambda c: F.when(~c.isin(*sentinels), c)


def pad_left(size: int, char: str) -> Transform:
    """Fill on the left up to ``size``; a longer value is kept whole."""
    return lambda c: F.lpad(c, F.greatest(F.length(c), F.lit(size)), F.lit(char))


def apply_all(c: Column, transforms: Iterable[Transform]) -> Column:
    return reduce(lambda value, step: step(value), transforms, c)
