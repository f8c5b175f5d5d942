"""Bounded backfill plans, calendar windows and coverage gaps as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import scalar as S

# Last day the daily northbound holding feed was published, and the length
# of the bounded window.
NORTHBOUND_LAST_DATE = date(2024, 8, 20)
WINDOW_MONTHS = 120

STOCK_DATASETS = ("top10_holders", "top10_floatholders")
FUND_DATASETS = ("fund_portfolio",)
TURNOVER_DATASET = "hsgt_top10"
NORTHBOUND_DATASET = "hsgt_hold_top10"


def month_ends(bounds: DataFrame, first: str, last: str, name: str = "month_end") -> DataFrame:
    """Every month end from the month of ``first`` to the month of ``last``."""
    start = F.trunc(F.col(first).cast("date"), "month")
    stop = F.trunc(F.col(last).cast("date"), "month")
    months = F.sequence(start, stop, F.expr("interval 1 month"))
    return bounds.select(F.explode(F.transform(months, F.last_day)).alias(name))


def month_end_window(bounds: DataFrame, last: str, months: int = WINDOW_MONTHS) -> DataFrame:
    """The ``months`` month ends up to and including the month of ``last``."""
    return month_ends(
        bounds.select(F.add_months(F.col(last).cast("date"), -(months - 1)).alias("_first"), F.col(last).alias("_last")),
        "_first",
        "_last",
    )


def report_periods(ends: DataFrame, column: str = "month_end") -> DataFrame:
    return ends.where(S.is_quarter_end(F.col(column)))


def provider_dates(ends: DataFrame, column: str = "month_end", cutoff: date = NORTHBOUND_LAST_DATE) -> DataFrame:
    """Each month end with the date the northbound feed can still answer for, and why not.

    Before the cut-off the month end itself; in the cut-off's month the cut-off; later
    months have none.
    """
    limit = F.lit(cutoff)
    month_end = F.col(column)
    capped = (F.last_day(limit) == F.last_day(month_end)) & (month_end > limit)
    return ends.select(
        column,
        F.when(month_end <= limit, month_end).when(capped, limit).alias("provider_date"),
        F.when(capped, F.lit("partial_month_provider_cutoff"))
        .when(month_end > limit, F.lit("post_publication_cutoff"))
        .alias("gap_reason"),
    )


def plan_items(
    dataset: str,
    codes: DataFrame,
    code: str,
    dates: DataFrame,
    date_column: str,
    variants: Sequence[str] = (),
    variant_name: str | None = None,
    cutoff: date = NORTHBOUND_LAST_DATE,
) -> DataFrame:
    """One planning decision per (code, date, variant) of a dataset.

    The dates of a plan are a bounded calendar, so they travel as one array attached to
    each code and are exploded there; variants are a short constant list.
    """
    calendar = dates.select(F.array_sort(F.collect_set(F.col(date_column).cast("date"))).alias("_dates")).scalar()
    rows = codes.select(F.col(code).alias("code")).distinct().select("code", F.explode(calendar).alias("partition_date"))
    if variants:
        rows = rows.withColumn(variant_name or "variant", F.explode(F.array(*[F.lit(v) for v in variants])))
    late = discontinued(F.lit(dataset), F.col("partition_date"), cutoff)
    bad_code = F.col("code").isNull() | (F.trim("code") == "")
    return rows.select(
        F.lit(dataset).alias("dataset"),
        "*",
        F.when(bad_code, "rejected").when(late, "skipped").otherwise("planned").alias("status"),
        F.when(bad_code, "missing_bounded_inputs").when(late, "post_publication_cutoff").alias("reason_type"),
    )


def plan_limit(plan: DataFrame, limit: int) -> DataFrame:
    """One rejection row when the planned items exceed the limit, else none."""
    return (
        plan.where(F.col("status") == "planned")
        .agg(F.count("*").alias("planned_count"))
        .where(F.col("planned_count") > limit)
        .select(
            F.lit("rejected").alias("status"),
            F.lit("plan_item_limit_exceeded").alias("reason_type"),
            "planned_count",
            F.lit(limit).alias("max_plan_items"),
        )
    )


def coverage_gaps(plan: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Planned items that have not landed."""
    have = landed.select(*[F.col(k).alias(f"_l_{k}") for k in keys]).distinct()
    planned = plan.where(F.col("status") == "planned")
    return planned.join(have, [planned[k] == have[f"_l_{k}"] for k in keys], "left_anti")


def discontinued(dataset: Column, partition_date: Column, cutoff: date = NORTHBOUND_LAST_DATE) -> Column:
    """Whether a scheduled pull of the feed must be skipped rather than land empty."""
    return (dataset == NORTHBOUND_DATASET) & (partition_date > F.lit(cutoff))
