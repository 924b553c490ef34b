"""Naming an intermediate value inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it.

    Spark repeats an expression wherever it is used inside conditions and
    lambdas; a lambda variable is computed before the lambda runs.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
