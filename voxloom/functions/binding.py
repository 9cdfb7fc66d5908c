"""Local names inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once.

    An expression that is named inside a lambda is otherwise computed again for every element, which makes a pass over
    a signal quadratic.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
