"""Data-quality checks; each returns the violating rows or keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import scalar as S
from lakemart.operators.ordering import latest_ties

# Pattern of a listed security code; run ids are a UUID4 with or without
# hyphens, or a ULID.
STOCK_CODE = r"^[0-9]{6}\.(SZ|SH|BJ)$"
RUN_ID_PATTERNS = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$",
    r"(?i)^[0-9a-f]{12}4[0-9a-f]{3}[89ab][0-9a-f]{15}$",
    r"(?i)^[0-7][0-9A-HJKMNP-TV-Z]{25}$",
)


def nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any listed column, naming the columns."""
    found = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.withColumn("null_columns", F.array_join(found, ",")).where(F.size(found) > 0)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_count) for every listed column, all counted in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], [F.col(c) for c in columns], "column_name", "null_count")


def duplicates(df: DataFrame, keys: Sequence[str], count_name: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(count_name)).where(F.col(count_name) > 1)


def outside_values(df: DataFrame, column: str, accepted: Sequence[Any]) -> DataFrame:
    """Distinct non-NULL values outside the accepted set, with their row counts."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(accepted)))
        .groupBy(column)
        .agg(F.count("*").alias("row_count"))
    )


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL child keys without a parent, with their row counts.

    Children are counted per key before the join, so a hot key joins as one row.
    """
    children = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("row_count"))
    side = parent.select(F.col(parent_column).alias("_parent"))
    return children.join(side, children[column] == side["_parent"], "left_anti")


def unparsable_dates(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that are neither ISO nor YYYYMMDD dates."""
    return df.where(F.col(column).isNotNull() & S.lenient_date(column).isNull())


def several_true(df: DataFrame, groups: Sequence[str], flag: str, count_name: str = "row_count") -> DataFrame:
    return duplicates(df.where(F.col(flag)), groups, count_name)


def key_parity(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys on one side only; NULL equals NULL.

    One tagged aggregation instead of two anti joins: each side's keys are reduced
    map-side and shuffled once.
    """
    tagged = left.select(*keys, F.lit(True).alias("_l")).union(right.select(*keys, F.lit(False).alias("_l")))
    sides = tagged.groupBy(*keys).agg(F.bool_or("_l").alias("_in_left"), F.bool_and("_l").alias("_only_left"))
    return sides.where(~F.col("_in_left") | F.col("_only_left")).select(
        *keys, F.when(F.col("_only_left"), F.lit("left")).otherwise(F.lit("right")).alias("only_in")
    )


def pairing_report(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: counts, NULL keys, duplicate keys, one-sided keys and coverage of two paired tables."""
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    tagged = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")).union(
        right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    per_key = tagged.groupBy(*keys).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    total = per_key.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("_r"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.when(any_null, F.col("_l") + F.col("_r"))), F.lit(0)).alias("null_key_rows"),
        F.count_if(F.col("_l") > 1).alias("left_duplicate_keys"),
        F.count_if(F.col("_r") > 1).alias("right_duplicate_keys"),
        F.count_if((F.col("_l") > 0) & (F.col("_r") == 0)).alias("missing_in_right"),
        F.count_if((F.col("_r") > 0) & (F.col("_l") == 0)).alias("extra_in_right"),
        F.count_if((F.col("_l") > 0) & (F.col("_r") > 0)).alias("_both"),
        F.count_if(F.col("_l") > 0).alias("_left_keys"),
    )
    return total.withColumn(
        "coverage",
        F.when(F.col("_left_keys") == 0, F.lit(1.0)).otherwise(F.col("_both") / F.col("_left_keys")),
    ).drop("_both", "_left_keys")


def latest_artifact_ties(df: DataFrame) -> DataFrame:
    """Partitions whose newest load time is shared by several artifacts."""
    return latest_ties(
        df, ["source_id", "dataset", "partition_date"], "raw_loaded_at", "latest_artifact_count"
    )


def valid_run_id(run_id: Column) -> Column:
    matched = F.lit(False)
    for pattern in RUN_ID_PATTERNS:
        matched = matched | run_id.rlike(pattern)
    return matched


def is_trade_date(value: Column) -> Column:
    """Exactly eight digits that form a calendar date."""
    return F.coalesce(
        value.rlike(S.EIGHT_DIGITS) & F.try_to_date(F.when(value.rlike(S.EIGHT_DIGITS), value), "yyyyMMdd").isNotNull(),
        F.lit(False),
    )


def identity_violations(
    df: DataFrame,
    identity: Sequence[str],
    code_columns: Sequence[str] = (),
    date_columns: Sequence[str] = (),
    nullable: Sequence[str] = (),
) -> DataFrame:
    """Rows whose identity fields are null, blank or malformed, as a ``violations`` list."""
    problems = []
    for name in identity:
        text = F.col(name).cast("string")
        blank = F.trim(text) == ""
        filled = text.isNotNull() & ~blank
        if name not in nullable:
            problems.append(F.when(text.isNull(), F.lit(f"{name}:null")).when(blank, F.lit(f"{name}:blank")))
        if name in code_columns:
            problems.append(F.when(filled & ~text.rlike(STOCK_CODE), F.lit(f"{name}:malformed")))
        if name in date_columns:
            problems.append(F.when(filled & ~is_trade_date(text), F.lit(f"{name}:malformed")))
    found = F.array_compact(F.array(*problems))
    return df.withColumn("violations", F.array_join(found, ",")).where(F.size(found) > 0)


def wrong_partition_rows(df: DataFrame, date_column: str, partition_yyyymmdd: str | Column) -> DataFrame:
    """Rows whose date text is NULL or differs from the partition's."""
    expected = F.lit(partition_yyyymmdd) if isinstance(partition_yyyymmdd, str) else partition_yyyymmdd
    return df.where(~F.col(date_column).cast("string").eqNullSafe(expected))


def bad_event_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where any event date is NULL or not a valid YYYYMMDD date, naming the columns."""
    found = F.array_compact(
        F.array(*[F.when(~is_trade_date(F.col(c).cast("string")), F.lit(c)) for c in columns])
    )
    return df.withColumn("bad_columns", F.array_join(found, ",")).where(F.size(found) > 0)


def bad_measures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where a non-blank measure does not parse as decimal(38,18), naming the columns."""
    found = F.array_compact(
        F.array(
            *[
                F.when(S.clean_text(c).isNotNull() & S.lenient_measure(S.clean_text(c)).isNull(), F.lit(c))
                for c in columns
            ]
        )
    )
    return df.withColumn("bad_columns", F.array_join(found, ",")).where(F.size(found) > 0)


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    units: Mapping[str, float] | None = None,
    date: str | None = None,
) -> DataFrame:
    """Per-key differences of two providers' tables: missing side, row count, value, unit, date.

    ``units`` maps a value to a factor; a difference that vanishes when the right value
    is multiplied by it is reported as a unit difference.  Values are summed per key
    before the join, so each key joins one row to one row.
    """

    def side(df: DataFrame, tag: str) -> DataFrame:
        aggregates = [F.count("*").alias(f"{tag}_rows")]
        aggregates += [F.sum(v).alias(f"{tag}_{v}") for v in values]
        if date:
            aggregates.append(F.max(date).alias(f"{tag}_date"))
        return df.groupBy(*[F.col(k).alias(f"_{tag}_{k}") for k in keys]).agg(*aggregates)

    one, two = side(left, "left"), side(right, "right")
    both = one.join(two, [one[f"_left_{k}"] == two[f"_right_{k}"] for k in keys], "full_outer")
    in_left, in_right = F.col("left_rows").isNotNull(), F.col("right_rows").isNotNull()
    columns = [F.coalesce(f"_left_{k}", f"_right_{k}").alias(k) for k in keys]
    columns += [
        F.when(~in_left, F.lit("missing_left")).when(~in_right, F.lit("missing_right")).otherwise(F.lit("both")).alias("coverage"),
        F.coalesce(in_left & in_right & (F.col("left_rows") != F.col("right_rows")), F.lit(False)).alias("row_count_diff"),
    ]
    for v in values:
        differs = ~F.col(f"left_{v}").eqNullSafe(F.col(f"right_{v}")) & in_left & in_right
        columns.append(differs.alias(f"{v}_diff"))
        factor = (units or {}).get(v)
        if factor is not None:
            scaled = F.col(f"left_{v}") == F.col(f"right_{v}") * F.lit(factor)
            columns.append((differs & F.coalesce(scaled, F.lit(False))).alias(f"{v}_unit_diff"))
    if date:
        columns.append((in_left & in_right & ~F.col("left_date").eqNullSafe(F.col("right_date"))).alias("date_diff"))
    return both.select(*columns)


def reconcile_summary(diffs: DataFrame) -> DataFrame:
    flags = [f.name for f in diffs.schema.fields if f.dataType.typeName() == "boolean"]
    return diffs.groupBy("coverage").agg(
        F.count("*").alias("key_count"), *[F.count_if(F.col(f)).alias(f) for f in flags]
    )
