"""Evaluating an expression a single time where its result is needed more than once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once.

    Written out directly, a filter condition or a lambda body computes the value again at every mention.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
