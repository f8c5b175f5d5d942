from __future__ import annotations

from datetime import date, datetime

from lakemart.plans import schemas
from lakemart.plans.staging import select_latest, stage
from lakemart.session import SETTINGS, keep_methods_compiled

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_staging_limits_the_methods_of_a_session_of_ones_own(spark):
    own = spark.newSession()
    own.conf.set(LIMIT, "65535")
    columns = ", ".join(f"{c} string" for c in schemas.RAW_COLUMNS["daily_basic"])
    stage("daily_basic", own.createDataFrame([], f"{columns}, source_run_id string, raw_loaded_at timestamp"))
    assert own.conf.get(LIMIT) == SETTINGS[LIMIT]
    own.conf.set(LIMIT, "4000")
    keep_methods_compiled(own)
    assert own.conf.get(LIMIT) == "4000"


def test_rows_are_not_shuffled_to_the_winners_of_dates(spark, frame, rows):
    raw = frame("dt string, run_id string, v int", ("20240101", "a", 1), ("20240101", "b", 2), ("20240102", "a", 3), ("20240102", "a", 3), (None, "a", 4))
    artifacts = frame(
        "partition_date date, run_id string, request_params_hash string, written_at timestamp",
        (date(2024, 1, 1), "a", "", datetime(2024, 1, 3)),
        (date(2024, 1, 1), "b", "", datetime(2024, 1, 4)),
        (date(2024, 1, 2), "a", "", datetime(2024, 1, 3)),
        (None, "a", "", datetime(2024, 1, 3)),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        chosen = select_latest(raw, artifacts)
        plan = chosen._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert rows(chosen, "v", "source_run_id") == [(2, "b"), (3, "a"), (3, "a")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
