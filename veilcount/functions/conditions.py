"""Conditions of many parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_of(tests: list[Column]) -> Column:
    """A balanced disjunction, so that many parts make no deep expression; no part at all is false."""
    if len(tests) < 2:
        return tests[0] if tests else F.lit(False)
    return any_of(tests[: len(tests) // 2]) | any_of(tests[len(tests) // 2 :])
