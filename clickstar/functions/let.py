"""A value that an expression names several times, worked out once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that it names several times and that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
