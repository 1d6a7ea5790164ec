"""Folders for data a job writes on the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder of `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of this machine;
    on a cluster executors could not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="userlake-")
    return f"{shared.rstrip('/')}/userlake/{purpose}-{uuid.uuid4().hex}"


def stored_rows(df: DataFrame, purpose: str) -> DataFrame:
    """Write rows to a scratch folder and read them back: made once, whatever reads them."""
    path = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
