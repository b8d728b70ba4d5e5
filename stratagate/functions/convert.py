"""Text to typed values. Whatever does not convert becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratagate import vocabulary as v


def date_pattern(notation: str) -> str:
    """``AAAA-MM-DD`` notation as a Spark datetime pattern."""
    for token, pattern in v.DATE_TOKENS.items():
        notation = notation.replace(token, pattern)
    return notation


def to_number(c: Column, spark_type: str, decimal_mark: str = ".") -> Column:
    if decimal_mark != ".":
        c = F.replace(c, F.lit(decimal_mark), F.lit("."))
    return c.try_cast(spark_type)


def to_date(c: Column, notation: str) -> Column:
    return F.try_to_timestamp(c, F.lit(date_pattern(notation))).cast("date")


def is_code(value: Column, code: str, spark_type: str) -> Column:
    """A typed value against a code written as text."""
    return value == F.lit(code).try_cast(spark_type)


def label_of(value: Column, labels: Mapping[str, str], spark_type: str = "string") -> Column:
    """Description of a code; NULL when the code is not listed."""
    told = [F.when(is_code(value, c, spark_type), F.lit(text)) for c, text in labels.items()]
    return F.coalesce(*told, F.lit(None).cast("string"))


def is_listed(value: Column, codes: Iterable[str], spark_type: str = "string") -> Column:
    return F.coalesce(
        reduce(or_, [is_code(value, c, spark_type) for c in codes], F.lit(False)), F.lit(False)
    )
