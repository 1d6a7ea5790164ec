"""Helpers that the operators share."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from userlake.sources.scratch import scratch_folder

ROOT = str(Path(__file__).resolve().parents[2])

# The white space that parts words; every other character belongs to a word.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def importable_on_workers(spark: SparkSession) -> None:
    """Let Python workers that share this machine's disk import the package; elsewhere it is shipped with --py-files."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write rows to the shared folder and read them back: cuts lineage, survives lost executors."""
    path = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_merge(df: DataFrame) -> DataFrame:
    """One side of a join that is merged at every size, as both sides grow with the input.

    Spark sizes a table by its file and its columns and takes no account of an
    explode or of how well the file is packed, so it may broadcast a table of
    very many rows, which all pass through the driver.
    """
    return df.hint("merge")


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for a null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def unique_names(df: DataFrame, *wanted: str) -> dict[str, str]:
    """For each wanted name one that no column of `df` has, so that working columns never clash."""
    taken = {c.lower() for c in df.columns}
    names = {}
    for name in wanted:
        free = f"_{name}"
        while free.lower() in taken:
            free = f"_{free}"
        taken.add(free.lower())
        names[name] = free
    return names
