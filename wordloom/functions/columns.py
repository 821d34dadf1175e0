"""Small building blocks of Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is worked out once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def depths(steps: Column) -> Column:
    """Running sums of an array of steps, from 0 before the first: one element more than the array."""
    return F.aggregate(steps, F.array(F.lit(0)), lambda sums, step: F.concat(sums, F.array(F.element_at(sums, -1) + step)))
