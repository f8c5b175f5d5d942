"""Typed staging tables over the latest raw artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import scalar as S
from lakemart.operators.ordering import latest_per_key, newest_first
from lakemart.plans import schemas
from lakemart.session import keep_methods_compiled, keep_tasks_small


def latest_artifacts(artifacts: DataFrame, partitioned: bool = True, request_scoped: bool = False) -> DataFrame:
    """The winning artifact per partition, per request scope, per both, or of the dataset.

    ``artifacts`` has partition_date (date), run_id, written_at (timestamp) and
    request_params_hash.  The newest load wins, then the newest date, then the run id.
    """
    scoped = artifacts.withColumn("request_scope_key", S.scope_key(F.col("request_params_hash"), F.col("run_id")))
    keys = (["partition_date"] if partitioned else []) + (["request_scope_key"] if request_scoped else [])
    return latest_per_key(scoped, keys, newest_first("written_at", "partition_date", "run_id"))


def select_latest(
    raw: DataFrame, artifacts: DataFrame, partitioned: bool = True, request_scoped: bool = False
) -> DataFrame:
    """Raw rows (carrying ``dt`` and ``run_id``) of the winning artifacts, with the load time.

    Without request scopes there is one winner a date at most, so winners are sent to the rows: these are neither
    shuffled nor sorted, and a date's rows do not meet in one task.
    """
    winners = latest_artifacts(artifacts, partitioned, request_scoped).select(
        F.date_format("partition_date", "yyyyMMdd").alias("_dt"),
        F.col("run_id").alias("_run"),
        F.col("written_at").cast("timestamp_ntz").alias("raw_loaded_at"),
    )
    if not request_scoped:
        winners = F.broadcast(winners)
    return (
        raw.join(winners, (raw["dt"] == winners["_dt"]) & (raw["run_id"] == winners["_run"]), "inner")
        .withColumnRenamed("run_id", "source_run_id")
        .drop("_dt", "_run", "dt")
    )


def typed_column(dataset: str, column: str) -> Column:
    kind = schemas.column_kind(dataset, column)
    if kind == "date":
        return S.strict_date(column).alias(column)
    if kind == "measure":
        return F.col(column).cast(S.MEASURE).alias(column)
    return S.clean_text(column).alias(column)


def stage(dataset: str, selected: DataFrame) -> DataFrame:
    """Declared columns, trimmed and typed; columns an old artifact lacks are NULL."""
    keep_methods_compiled(selected.sparkSession)
    keep_tasks_small(selected.sparkSession)
    have = set(selected.columns)
    columns = []
    for name in schemas.RAW_COLUMNS[dataset]:
        if name in have:
            columns.append(typed_column(dataset, name))
        else:
            to = {"date": "date", "measure": S.MEASURE}.get(schemas.column_kind(dataset, name), "string")
            columns.append(F.lit(None).cast(to).alias(name))
    if dataset == "stock_basic":
        listed = S.is_listed("list_status") if "list_status" in have else F.lit(None).cast("boolean")
        columns.append(listed.alias("is_active"))
    return selected.select(
        *columns,
        F.col("source_run_id").cast("string").alias("source_run_id"),
        F.col("raw_loaded_at").cast("timestamp_ntz").alias("raw_loaded_at"),
    )


def staging_table(dataset: str, raw: DataFrame, artifacts: DataFrame) -> DataFrame:
    partitioned, request_scoped = schemas.selection_mode(dataset)
    return stage(dataset, select_latest(raw, artifacts, partitioned, request_scoped))
