"""Sums and means that do not depend on how rows are spread over tasks.

Doubles are added as whole numbers of a smallest unit, so addition is exact and
its order does not matter; the result is rounded to a double once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_sum(value: str | Column, digits: int = 8) -> Column:
    """The sum of values rounded to so many decimal places each; null without values; an error from 10 ** 20 on."""
    column = F.col(value) if isinstance(value, str) else value
    return F.sum(F.round(column, digits).cast(f"decimal({20 + digits},{digits})")).cast("double")


def exact_mean(value: str | Column, digits: int = 8) -> Column:
    """The mean of values rounded to so many decimal places each; null without values."""
    column = F.col(value) if isinstance(value, str) else value
    return F.try_divide(exact_sum(column, digits), F.count(column))
