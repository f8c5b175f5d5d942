"""Cycle tables as append-only datasets: freezing writes the selection, then the cycle row."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions import scalar as S
from lakemart.operators.ordering import latest_per_key, newest_first
from lakemart.plans import cycle as C
from lakemart.sources.raw_zone import read_or_empty
from lakemart.sources.snapshots import now_ntz

SELECTION_SCHEMA = T.StructType(
    [
        T.StructField("candidate_id", T.LongType()),
        T.StructField("selected_at", T.TimestampNTZType()),
        T.StructField("cycle_id", T.StringType()),
        T.StructField("freeze_id", T.StringType()),
    ]
)
CYCLE_SCHEMA = T.StructType(
    [
        T.StructField("cycle_id", T.StringType()),
        T.StructField("cycle_date", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("cutoff_submitted_at", T.TimestampNTZType()),
        T.StructField("cutoff_ingest_seq", T.LongType()),
        T.StructField("candidate_count", T.IntegerType()),
        T.StructField("selection_frozen_at", T.TimestampNTZType()),
        T.StructField("freeze_id", T.StringType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)


def selections(spark: SparkSession, root: str) -> DataFrame:
    """Selections of frozen cycles; an unfinished freeze is not one."""
    rows = read_or_empty(spark, f"{root}/selections", SELECTION_SCHEMA)
    frozen = cycles(spark, root).where(F.col("freeze_id").isNotNull()).select(F.col("freeze_id").alias("_frozen"))
    return rows.join(frozen, rows["freeze_id"] == frozen["_frozen"], "left_semi").drop("freeze_id")


def cycle_history(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/cycles", CYCLE_SCHEMA)


def cycles(spark: SparkSession, root: str) -> DataFrame:
    """The current row of every cycle."""
    return latest_per_key(cycle_history(spark, root), ["cycle_id"], newest_first("updated_at"))


def _append_cycle(spark: SparkSession, root: str, rows: DataFrame) -> None:
    rows.select(*CYCLE_SCHEMA.fieldNames()).coalesce(1).write.mode("append").parquet(f"{root}/cycles")


def open_cycle(spark: SparkSession, root: str, cycle_id: str, at: datetime | None = None) -> None:
    if not cycles(spark, root).where(F.col("cycle_id") == cycle_id).isEmpty():
        raise ValueError(f"cycle already exists: {cycle_id}")
    stamp = F.lit(at or now_ntz()).cast("timestamp_ntz")
    row = spark.range(1).select(
        F.lit(cycle_id).alias("cycle_id"), S.cycle_date_of(F.lit(cycle_id)).alias("cycle_date"), F.lit("pending").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("cutoff_submitted_at"), F.lit(None).cast("long").alias("cutoff_ingest_seq"),
        F.lit(0).alias("candidate_count"), F.lit(None).cast("timestamp_ntz").alias("selection_frozen_at"),
        F.lit(None).cast("string").alias("freeze_id"), stamp.alias("updated_at"),
    )
    _append_cycle(spark, root, row)


def freeze(
    spark: SparkSession,
    root: str,
    queue: DataFrame,
    cycle_id: str,
    submitted_by: str | None = None,
    payload_type: str | None = None,
    at: datetime | None = None,
) -> DataFrame:
    """Freezes the accepted, unselected candidates of ``queue`` into a pending cycle.

    ``queue`` must read one committed version, and one freeze may run at a time.  Each
    attempt writes its own selection folder, cutoffs are taken from what was written,
    and the cycle row that names the folder comes last.
    """
    current = cycles(spark, root).where(F.col("cycle_id") == cycle_id).collect()
    if not current:
        raise LookupError(f"cycle not found: {cycle_id}")
    if current[0]["status"] != "pending" or current[0]["selection_frozen_at"] is not None:
        raise C.CycleAlreadyFrozen(f"{cycle_id} is {current[0]['status']}")
    stamp = at or now_ntz()
    frozen_at = F.lit(stamp).cast("timestamp_ntz")
    chosen = C.eligible_candidates(queue, selections(spark, root), submitted_by, payload_type)
    freeze_id = uuid.uuid4().hex
    path = f"{root}/selections/freeze_id={freeze_id}"
    chosen.select(
        F.col("id").alias("candidate_id"), frozen_at.alias("selected_at"), F.lit(cycle_id).alias("cycle_id")
    ).write.mode("errorifexists").parquet(path)
    written = spark.read.parquet(path)
    rows = queue.join(written.select("candidate_id"), queue["id"] == written["candidate_id"], "left_semi")
    row = C.freeze_cutoffs(rows).select(
        F.lit(cycle_id).alias("cycle_id"), S.cycle_date_of(F.lit(cycle_id)).alias("cycle_date"), F.lit("phase0").alias("status"),
        "cutoff_submitted_at", "cutoff_ingest_seq", F.col("candidate_count").cast("int").alias("candidate_count"),
        frozen_at.alias("selection_frozen_at"), F.lit(freeze_id).alias("freeze_id"), frozen_at.alias("updated_at"),
    )
    _append_cycle(spark, root, row)
    return cycles(spark, root).where(F.col("cycle_id") == cycle_id)


def step(spark: SparkSession, root: str, cycle_id: str, status: str, at: datetime | None = None) -> None:
    """Moves a cycle one step forward, or to failed."""
    current = cycles(spark, root).where(F.col("cycle_id") == cycle_id)
    rows = current.collect()
    if not rows:
        raise LookupError(f"cycle not found: {cycle_id}")
    if f"{rows[0]['status']}>{status}" not in C.allowed_steps():
        raise ValueError(f"invalid cycle transition for {cycle_id}: {rows[0]['status']} -> {status}")
    moved = current.withColumns({"status": F.lit(status), "updated_at": F.lit(at or now_ntz()).cast("timestamp_ntz")})
    _append_cycle(spark, root, moved)


def freeze_current_cycle(
    spark: SparkSession, root: str, queue: DataFrame, symbols: DataFrame, calendar: DataFrame,
    daily: DataFrame, basics: DataFrame,
) -> DataFrame:
    """Freezes the cycle of the latest open trading day, if all symbols have their data."""
    ready = C.readiness(symbols, calendar, daily, basics).first()
    if not ready["ready"]:
        raise RuntimeError(f"{ready['reason']}: {ready['missing_symbols']} symbols missing for {ready['trade_date']}")
    return freeze(spark, root, queue, ready["cycle_id"])
