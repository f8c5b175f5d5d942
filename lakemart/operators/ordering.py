"""Latest-version selection and ordered picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(*columns: Column | str) -> list[Column]:
    """Descending order with NULLs last for every column."""
    return [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in columns]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``order``.

    ``row_number() = 1`` plans as a group-limit before and after the exchange, so
    each map task forwards at most one row per key however hot the key is.  Without
    keys it is a top-1, never an unpartitioned window.
    """
    if not keys:
        return df.orderBy(*order).limit(1)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_ties(df: DataFrame, keys: Sequence[str], value: str, count_name: str = "tie_count") -> DataFrame:
    """Groups whose greatest value is shared by several rows, with the number sharing it.

    Counting per (key, value) first means the second stage sees one row per distinct
    value, and both aggregations combine map-side.
    """
    per_value = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias(count_name))
    top = per_value.groupBy(*keys).agg(F.max(F.struct(value, count_name)).alias("_top"))
    return top.select(*keys, f"_top.{value}", f"_top.{count_name}").where(F.col(count_name) > 1)


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
