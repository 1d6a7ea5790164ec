"""Joins whose right side is a handful of rows known beforehand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_or_null(rows: DataFrame, *columns: str) -> Column:
    """The single row of `rows` as a struct scalar; null when there is none."""
    return rows.select(F.struct(*columns)).scalar()


def few_rows(rows: DataFrame, *columns: str) -> Column:
    """A handful of rows as one array scalar.

    Only for rows whose number is fixed by labels (generations, weekdays), never
    for rows that grow with the users.
    """
    return rows.select(F.collect_list(F.struct(*columns))).scalar()


# Lots into which rows are dealt that meet every row of another table.
LOTS = 16


def beside_every(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each row of `left` beside each row of `right`, as an equality join.

    `left` is dealt to lots by a hash and `right` is copied to every lot, so
    that the pairs spread over tasks; whether a side is broadcast is left to
    its size, and nothing passes the driver.
    """
    dealt = left.withColumn("_lot", F.pmod(F.xxhash64(*left.columns), F.lit(LOTS)).cast("int"))
    copied = right.withColumn("_lot", F.explode(F.sequence(F.lit(0), F.lit(LOTS - 1))))
    return dealt.join(copied, "_lot").drop("_lot")
