"""Join shapes the marts are built from.

No join carries a broadcast hint: the size-checked choice is left to
``autoBroadcastJoinThreshold`` and AQE, which fall back to a shuffled join beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "1970-01-01"


def spine_join(sources: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct keys of all sources, each source left-joined back, columns ``<source>__<column>``.

    A NULL key part survives in the spine but matches nothing.  The distinct and all
    joins share the keys, so every source is shuffled once.
    """
    spine = reduce(
        lambda a, b: a.union(b), [df.select(*keys) for df in sources.values()]
    ).distinct()
    for name, df in sources.items():
        side = df.select(
            *[F.col(k).alias(f"_{name}_{k}") for k in keys],
            *[F.col(c).alias(f"{name}__{c}") for c in df.columns if c not in keys],
        )
        on = [spine[k] == side[f"_{name}_{k}"] for k in keys]
        spine = spine.join(side, on, "left").drop(*[f"_{name}_{k}" for k in keys])
    return spine


def _bucket(day: Column, width: int) -> Column:
    return F.floor(F.datediff(day, F.lit(EPOCH).cast("date")) / F.lit(width)).cast("int")


def interval_pairs(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    point: str,
    start: str,
    end: str,
    how: str = "inner",
    bucket_days: int = 366,
) -> DataFrame:
    """Join each point to the intervals of its key that contain it (both ends included).

    ``how`` is inner, left, left_semi or left_anti, seen from the points.  A NULL end
    is open; a NULL start contains nothing.  The join key is (keys, time bucket): an
    interval is repeated once per bucket it covers and a point has one bucket, so a
    pair is found once and a hot key is spread over its buckets instead of being
    compared point by interval in one task.  Open intervals stop at the last point.
    """
    shared = set(points.columns) & set(intervals.columns) - set(keys)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    last = points.agg(F.max(point).cast("date")).scalar()
    spans = (
        intervals.where(F.col(start).isNotNull())
        .withColumn("_stop", F.least(F.col(end).cast("date"), last))
        .where(F.col(start).cast("date") <= F.col("_stop"))
        .withColumn(
            "_bucket",
            F.explode(F.sequence(_bucket(F.col(start), bucket_days), _bucket(F.col("_stop"), bucket_days))),
        )
        .drop("_stop")
        .withColumnsRenamed({k: f"_i_{k}" for k in keys})
        .withColumnRenamed("_bucket", "_i_bucket")
    )
    spread = points.withColumn("_bucket", _bucket(F.col(point), bucket_days))
    on = [spread[k] == spans[f"_i_{k}"] for k in keys]
    on += [
        spread["_bucket"] == spans["_i_bucket"],
        spread[point] >= spans[start],
        spans[end].isNull() | (spread[point] <= spans[end]),
    ]
    joined = spread.join(spans, on, how)
    return joined.drop("_bucket", "_i_bucket", *[f"_i_{k}" for k in keys])


def without_matches(df: DataFrame, matched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose columns appear nowhere in ``matched``; NULL equals NULL."""
    side = matched.select(*[F.col(c).alias(f"_m_{c}") for c in columns]).distinct()
    return df.join(side, [df[c].eqNullSafe(side[f"_m_{c}"]) for c in columns], "left_anti")
