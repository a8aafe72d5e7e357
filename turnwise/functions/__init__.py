"""Functions on columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once per row, however often it is used.

    Common parts of an expression are shared in generated code, but not inside the
    lambdas of array functions; there this saves parsing the same JSON again and again.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
