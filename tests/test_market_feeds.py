"""How the market queries read the driver tables, on rows of their own."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest

from lakemart.checks import market_queries as Q
from lakemart.checks.market_feeds import StagedFeeds
from lakemart.plans import intermediate as I
from lakemart.plans.staging import stage
from lakemart.session import keep_tasks_small


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("driver"))
    day = lambda i: datetime(2024, 1 + i % 12, 1 + i % 28, i % 24)
    made = {
        "lineitem": ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_shipdate timestamp_ntz",
                     [(i // 3, i % 3, i % 7 or None, i % 5, i * 1.25, day(i % 40)) for i in range(240)]),
        "orders": ("o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz", [(i, i % 6, i * 2.5, day(i)) for i in range(60)]),
        "events": ("event_id long, user_id long, event_type string, value double, ts timestamp_ntz", [(i, i % 4, "abc"[i % 3], i * 0.5, day(i)) for i in range(80)]),
    }
    for name, (schema, rows) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_groups_of_few_rows_are_not_combined_before_they_are_dealt(spark, tables):
    daily = StagedFeeds(spark, tables)["daily"]
    plan = daily._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("hashpartitioning(l_partkey")]
    assert "partial_sum" in above and "partial_sum" not in plan[len(above) :]
    lines = spark.read.parquet(f"{tables}/lineitem.parquet")
    groups = lines.selectExpr("l_partkey", "cast(l_shipdate as date) as d").distinct().count()
    assert daily.count() == groups


@pytest.mark.parametrize("name", ["deriv_top_holder_qoq_change", "deriv_lineage_top_holder_qoq_change", "deriv_lineage_northbound_holding_z_score"])
def test_derivations_of_one_reading_write_no_positions(spark, tables, name):
    written = Path(spark.conf.get("spark.checkpoint.dir")) / "lakemart-tables"
    here = lambda: set(written.iterdir()) if written.exists() else set()
    before = here()
    rows = Q.__dict__[name](spark, tables).count()
    assert rows and here() == before


def test_copies_of_a_bars_columns_are_not_joined(frame):
    bar = frame("ts_code string, trade_date date, close string, source_run_id string, raw_loaded_at timestamp_ntz")
    factor = frame("ts_code string, trade_date date, adj_factor string, source_run_id string, raw_loaded_at timestamp_ntz")
    bars = I.price_bars_adjusted({"daily": bar, "weekly": bar, "monthly": bar, "adj_factor": factor})
    plan = bars._jdf.queryExecution().optimizedPlan().toString()
    assert "price_bar_source_run_id" in plan[: plan.index("Join LeftOuter")]
    assert "price_bar_source_run_id" not in plan[plan.index("Join LeftOuter") :]
    assert bars.columns == (
        "ts_code trade_date close source_run_id raw_loaded_at freq price_source_interface_id price_bar_source_run_id "
        "price_bar_raw_loaded_at adj_factor adj_factor_source_run_id adj_factor_raw_loaded_at"
    ).split()


def test_staging_keeps_tasks_small_unless_the_session_says_otherwise(spark, frame):
    names = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n in names:
            spark.conf.unset(n)
        stage("index_member", frame("index_code string, source_run_id string, raw_loaded_at timestamp_ntz"))
        assert [spark.conf.get(n, None) for n in names] == [str(4 * int(spark.conf.get("spark.sql.shuffle.partitions"))), "16MB"]
        spark.conf.set(names[1], "8MB")
        keep_tasks_small(spark)
        assert spark.conf.get(names[1]) == "8MB"
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)
