"""Z-score outlier marks on any numeric column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from userlake.functions.scoring import anomaly_severity


def detect_anomalies(df: DataFrame, metric: str, threshold: float = 2.0) -> DataFrame:
    """Mark rows whose metric lies more than `threshold` sample deviations off the mean.

    Mean and deviation are one scalar subquery, that is one further pass over the
    input, of which two numbers reach the driver. The generator that hands them
    to the rows keeps filters on the marks from copying it. With no spread to
    measure (fewer than two rows, or equal values) the score is null and the row
    counts as normal.
    """
    figures = df.select(
        F.struct(F.avg(metric).alias("mean"), F.nullif(F.stddev_samp(metric), F.lit(0.0)).alias("spread"))
    ).scalar()
    value, mean = F.col(metric), F.col("_figures.mean")
    scored = df.withColumn("_figures", F.explode(F.array(figures))).withColumn(
        "z_score", F.abs(value - mean) / F.col("_figures.spread")
    )
    marked = scored.withColumn("is_anomaly", F.col("z_score") > threshold)
    return marked.withColumns(
        {
            "anomaly_type": F.when(F.col("is_anomaly") & (value > mean), "High Anomaly")
            .when(F.col("is_anomaly") & (value < mean), "Low Anomaly")
            .otherwise("Normal"),
            "anomaly_severity": anomaly_severity(F.col("z_score")),
        }
    ).drop("_figures")
