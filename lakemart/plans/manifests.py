"""Publish manifests: which snapshot of each formal table a cycle published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.ordering import latest_per_key, newest_first

MANIFEST_ROWS = T.StructType(
    [
        T.StructField("published_cycle_id", T.StringType()),
        T.StructField("published_at", T.TimestampNTZType()),
        T.StructField(
            "formal_table_snapshots",
            T.MapType(T.StringType(), T.StructType([T.StructField("snapshot_id", T.LongType())])),
        ),
    ]
)

# Formal object names, and the four every formal set must hold.
REQUIRED_OBJECTS = ("world_state_snapshot", "official_alpha_pool", "alpha_result_snapshot", "recommendation_snapshot")
FORMAL_OBJECTS = REQUIRED_OBJECTS + ("dashboard_snapshot", "report", "audit_record", "replay_record")
FORMAL_NAMESPACE = "formal"

NEWEST = ("published_at", "published_cycle_id")


def published_tables(manifests: DataFrame) -> DataFrame:
    """One row per (cycle, formal table) with its snapshot id."""
    return manifests.select(
        "published_cycle_id", "published_at", F.explode("formal_table_snapshots").alias("table_name", "_s")
    ).select("published_cycle_id", "published_at", "table_name", F.col("_s.snapshot_id").alias("snapshot_id"))


def latest_manifest(manifests: DataFrame) -> DataFrame:
    return manifests.orderBy(*newest_first(*NEWEST)).limit(1)


def by_cycle(manifests: DataFrame, cycle_id: str) -> DataFrame:
    return manifests.where(F.col("published_cycle_id") == cycle_id)


def by_snapshot(manifests: DataFrame, table_name: str, snapshot_id: int) -> DataFrame:
    """The newest manifest that published the table at the snapshot; empty if none did."""
    rows = published_tables(manifests)
    hits = rows.where((F.col("table_name") == table_name) & (F.col("snapshot_id") == snapshot_id))
    return latest_manifest(hits)


def newest_publication(manifests: DataFrame) -> DataFrame:
    """For every published (table, snapshot), the newest cycle that published it."""
    return latest_per_key(published_tables(manifests), ["table_name", "snapshot_id"], newest_first(*NEWEST))
