"""Row numbers over groups that may be too large for one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

_SLOT_DIGITS = 2  # hex digits of the tie key: 256 slots per order value


def with_row_number(
    df: DataFrame,
    name: str,
    group: Sequence[str],
    order: str,
    ties: Sequence[str],
    descending: bool = True,
) -> DataFrame:
    """Exact row_number() of each row within `group`, ordered by `order`.

    Rows with the same order value are told apart by a hash of the `ties`
    columns. That hash is uniform, so its leading digits cut any run of ties
    into even slots: a row's number is the count of all rows in earlier
    (order value, slot) cells plus its place in its own cell. Only the cell
    counts are windowed per group. They stay few where the order value is a
    count of users: n groups of users with different counts hold at least
    n(n+1)/2 users, so N users give at most sqrt(2N) order values.
    """
    tie_text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ties]
    keyed = df.withColumn("_tie", F.md5(F.concat_ws("|", *tie_text)))
    keyed = keyed.withColumn("_slot", F.substring("_tie", 1, _SLOT_DIGITS))
    # One key for both the window and the join, so that they share an exchange.
    # Structs compare nulls inside as equal, so no row is lost to a null.
    keyed = keyed.withColumn("_cell", F.struct(*group, order, "_slot"))

    first = F.desc_nulls_first if descending else F.asc_nulls_last
    earlier = (
        W.partitionBy(*[f"_at.{c}" for c in group])
        .orderBy(first(f"_at.{order}"), "_at._slot")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    counts = keyed.groupBy(F.col("_cell").alias("_at")).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = counts.select("_at", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))

    here = W.partitionBy("_cell").orderBy("_tie", *ties)
    numbered = keyed.withColumn("_place", F.row_number().over(here))
    return numbered.join(offsets, F.col("_cell") == F.col("_at")).select(
        *df.columns, (F.col("_before") + F.col("_place")).cast("int").alias(name)
    )


# Ranges into which rows are dealt for numbering, at most; each tells all later ones how many rows it holds.
MAX_RANGES = 1024


def falling(column: Column) -> list[Column]:
    """Key columns that put a number in descending order, nulls last."""
    return [column.isNull(), -column]


def rising(column: Column) -> list[Column]:
    """Key columns that put a value in ascending order, nulls last."""
    return [column.isNull(), column]


def _telling_later_ranges(columns: Sequence[str], group: Sequence[str], ranges: int):
    """Pass rows on; at the end of a range tell each later one how many rows the last group has here.

    Only the last group of a range can go on in a later one. The function names
    nothing of this package, so workers need not import it.
    """
    import pyarrow as pa

    columns, group = list(columns), list(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, here, schema = None, 0, 0, None
        for batch in batches:
            schema = batch.schema
            if batch.num_rows:
                here = batch.column("_range")[0].as_py()
                keys = list(zip(*(batch.column(c).to_pylist() for c in group)))
                if keys[-1] != last:
                    last, held = keys[-1], 0
                at = len(keys)
                while at and keys[at - 1] == last:
                    at -= 1
                held += len(keys) - at
            yield batch
        if last is not None:
            later = list(range(here + 1, ranges))
            told = dict(zip(group, last)) | {"_told": held}
            yield pa.RecordBatch.from_pylist(
                [{c: told.get(c) for c in [*columns, "_told"]} | {"_range": r} for r in later], schema
            )

    return run


def with_range_number(
    df: DataFrame, name: str, group: Sequence[str], order: Sequence[Column], ranges: int | None = None
) -> DataFrame:
    """Exact row_number() of each row within `group`, ascending by `order`, which may be of any type.

    Rows are dealt out by ranges of (group, order) and sorted within them, so
    that a large group spreads over as many tasks as it has rows for, and ties
    of one column are cut by the next. A row's number is its place in its range
    and the rows that its group has in earlier ranges; each range tells the
    later ones about its last group, the only one that can go on. `df` is read
    once, in one job, so all numbers go by one set of ranges. There are as many
    ranges as shuffle partitions, MAX_RANGES at most; rows of one and the same
    key share a range.
    """
    ranges = ranges or min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MAX_RANGES)
    keys = {f"_key{i}": column for i, column in enumerate(order)}
    dealt = (
        df.withColumns(keys)
        .repartitionByRange(ranges, *group, *keys)
        .sortWithinPartitions(*group, *keys)
        .withColumns({"_range": F.spark_partition_id(), "_told": F.lit(None).cast("bigint")})
    )
    nullable = StructType([StructField(f.name, f.dataType) for f in dealt.schema])
    told = dealt.mapInArrow(_telling_later_ranges([*df.columns, *keys], group, ranges), nullable)
    part = W.partitionBy("_range", *group)
    place = F.row_number().over(part.orderBy(F.col("_told").isNotNull(), *keys))
    before = F.coalesce(F.sum("_told").over(part), F.lit(0))
    numbered = told.withColumns({"_place": place, "_before": before}).where(F.col("_told").isNull())
    return numbered.select(*df.columns, (F.col("_before") + F.col("_place")).cast("int").alias(name))
