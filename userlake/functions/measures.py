"""Aggregate and ordering expressions shared by facts, trends and views."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def rows() -> Column:
    return F.count(F.lit(1))


def tally(condition: Column) -> Column:
    """Number of rows that meet a condition; null over no rows, as SUM is."""
    return F.sum(F.when(condition, 1).otherwise(0))


def tally_value(name: str, value: str) -> Column:
    return tally(F.col(name) == value)


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    """part as a percentage of whole; null where whole is 0."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def steady_avg(column: Column) -> Column:
    """Average of a double metric that does not depend on the order of the rows.

    A sum of doubles changes in its last digits with the partitioning; a sum of
    decimals does not, and the rounded views need that.
    """
    return F.avg(column.cast("decimal(38,18)")).cast("double")


Steps = Sequence[tuple[Any, str]]


def _ladder(reached: Callable[[Any], Column], steps: Steps, otherwise: str | Column) -> Column:
    """Label of the first step whose bound is reached; a null value reaches none."""
    ladder: Any = F
    for bound, label in steps:
        ladder = ladder.when(reached(bound), label)
    return ladder.otherwise(otherwise)


def label_below(value: Column, steps: Steps, otherwise: str | Column) -> Column:
    """Label of the first bound above the value."""
    return _ladder(lambda bound: value < bound, steps, otherwise)


def label_up_to(value: Column, steps: Steps, otherwise: str | Column) -> Column:
    """Label of the first bound that the value does not exceed."""
    return _ladder(lambda bound: value <= bound, steps, otherwise)


def label_from(value: Column, steps: Steps, otherwise: str | Column) -> Column:
    """Label of the first bound that the value reaches."""
    return _ladder(lambda bound: value >= bound, steps, otherwise)


def label_above(value: Column, steps: Steps, otherwise: str | Column) -> Column:
    """Label of the first bound that the value exceeds."""
    return _ladder(lambda bound: value > bound, steps, otherwise)


def label_of(value: Column, labels: Mapping[Any, str], otherwise: str | Column) -> Column:
    """Label of the value itself."""
    return _ladder(lambda key: value == key, list(labels.items()), otherwise)


def down(name: str) -> Column:
    """Descending with nulls first: the order of the SQL views, where null is largest."""
    return F.desc_nulls_first(name)


def up(name: str) -> Column:
    """Ascending with nulls last: the order of the SQL views, where null is largest."""
    return F.asc_nulls_last(name)
