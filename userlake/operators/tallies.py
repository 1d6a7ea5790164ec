"""Counts of several kinds of values, their total and their leaders from one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TOTAL = "total"
# The total is handed to the counted values in so many slices, so that free text never meets in one task.
SLICES = 64


@dataclass(frozen=True)
class Kind:
    """A value to count.

    `where` leaves rows out of the counts, though not out of the total. Of a
    `leading` kind the first rows by count are kept, ties by value. Of a
    `distinct` kind only one row stays, which has the number of its values.
    """

    name: str
    value: Column
    where: Column | None = None
    leading: bool = False
    distinct: bool = False


def tallies(df: DataFrame, kinds: Sequence[Kind], leaders: int = 10) -> DataFrame:
    """kind, value, n, values and total: the rows with each value of each kind, and the row of the kind TOTAL.

    `df` is read once. Each row is paired with its values and with the total
    and all are summed in one aggregation, which combines on the map side; a
    distinct count folds its values where they lie before they move on.
    Leaders are limited where they lie too. Over no rows the total and the
    distinct kinds still have a row.
    """
    pairs = [
        F.when(F.lit(True) if k.where is None else k.where, F.struct(F.lit(k.name).alias("kind"), k.value.alias("value")))
        for k in kinds
    ]
    total = F.struct(F.lit(TOTAL).alias("kind"), F.lit(None).cast("string").alias("value"))
    paired = (
        df.select(F.explode(F.array(*pairs, total)).alias("pair"))
        .where(F.col("pair").isNotNull())
        .select("pair.kind", "pair.value", F.lit(1).alias("weight"))
    )
    distinct = [k.name for k in kinds if k.distinct]
    always = F.array(*[F.lit(name) for name in [TOTAL, *distinct]])
    seeds = df.sparkSession.range(1).select(
        F.explode(always).alias("kind"), F.lit(None).cast("string").alias("value"), F.lit(0).alias("weight")
    )
    counted = paired.unionByName(seeds).groupBy("kind", "value").agg(F.sum("weight").alias("n"))
    if distinct:
        folded = F.when(~F.col("kind").isin(distinct), F.col("value"))
        counted = counted.groupBy("kind", folded.alias("folded")).agg(
            F.sum("n").alias("n"), F.count("value").alias("values")
        ).withColumnRenamed("folded", "value")
    else:
        counted = counted.withColumn("values", F.lit(1).cast("bigint"))
    leading = [k.name for k in kinds if k.leading]
    if leading:
        # Values of other kinds are first among themselves, so one limit serves all.
        apart = F.when(~F.col("kind").isin(leading), F.col("value"))
        place = F.row_number().over(W.partitionBy("kind", apart).orderBy(F.desc("n"), "value"))
        counted = counted.withColumn("place", place).where(F.col("place") <= leaders).drop("place")
    # Every slice gets the total and its part of the other rows.
    own = F.array(F.pmod(F.xxhash64("kind", "value"), F.lit(SLICES)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(SLICES - 1))
    sliced = counted.withColumn("slice", F.explode(F.when(F.col("kind") == TOTAL, every).otherwise(own)))
    whole = F.max(F.when(F.col("kind") == TOTAL, F.col("n"))).over(W.partitionBy("slice"))
    return (
        sliced.withColumn("total", whole)
        .where((F.col("kind") != TOTAL) | (F.col("slice") == 0))
        .select("kind", "value", "n", "values", "total")
    )
