"""Ordered per-key analytics: change against the previous row, trailing z-score.

Both expect one row per (key, order value): callers collapse to that grain first, so
a key's window holds at most one row per report date or trading day, whatever share
of the raw rows the key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], prefix: str = "previous_"
) -> DataFrame:
    """Adds ``previous_<column>`` for each column from one shared window."""
    window = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())
    return df.withColumns({prefix + c: F.lag(c).over(window) for c in columns})


def with_next(df: DataFrame, keys: Sequence[str], order: str, column: str, name: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())
    return df.withColumn(name, F.lead(column).over(window))


def rolling_zscore(
    df: DataFrame, keys: Sequence[str], order: str, value: str, observations: int = 8
) -> DataFrame:
    """Trailing z-score over the current row and the ``observations - 1`` before it.

    Rows whose window has no spread (NULL or zero sample deviation) or whose value is
    NULL are dropped.  Adds window_start_date, window_end_date, observation_count,
    metric_mean, metric_stddev, metric_z_score.
    """
    window = (
        Window.partitionBy(*keys)
        .orderBy(F.col(order).asc_nulls_last())
        .rowsBetween(-(observations - 1), Window.currentRow)
    )
    number = F.col(value).cast("double")
    stats = df.withColumns(
        {
            "lookback_observations": F.lit(observations),
            "window_start_date": F.min(order).over(window),
            "window_end_date": F.max(order).over(window),
            "observation_count": F.count(value).over(window),
            "metric_mean": F.avg(number).over(window),
            "metric_stddev": F.stddev_samp(number).over(window),
        }
    )
    spread = stats.where(F.col("metric_stddev").isNotNull() & (F.col("metric_stddev") != 0))
    return spread.withColumn(
        "metric_z_score", (number - F.col("metric_mean")) / F.col("metric_stddev")
    ).where(F.col("metric_z_score").isNotNull())
