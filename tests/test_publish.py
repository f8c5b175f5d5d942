from __future__ import annotations

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.plans import contracts as C
from lakemart.plans import manifests as M
from lakemart.plans import schemas
from lakemart.plans.staging import stage
from lakemart.session import shuffles_dropped
from lakemart.sources import cycle_store as Y
from lakemart.sources import snapshots as S


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "tables")


def pair(frame, *codes, lineage=None):
    mart = frame("security_id string, symbol string, is_active boolean", *[(c, c[:3], c != "c") for c in codes])
    side = frame("security_id string, source_run_id string", *[(c, "r") for c in (lineage or codes)])
    return {"stock_basic": (mart, side)}


MART = "canonical_v2.stock_basic"


def publish(*given, **named):
    """Tables of a few columns, so without the declared schemas."""
    return S.publish_pairs(*given, **named, expected={})


def test_publish_read_and_pin(spark, root, frame, rows):
    stamp = datetime(2026, 5, 1)
    results = publish(spark, root, pair(frame, "a", "c"), loaded_at=stamp)
    assert [(r.table, r.row_count) for r in results] == [(MART, 2), ("canonical_lineage.lineage_stock_basic", 2)]
    first = S.current_snapshot_id(spark, root, MART)
    publish(spark, root, pair(frame, "a", "b", "c"))
    assert rows(S.read_table(spark, root, MART, columns=["security_id"])) == [("a",), ("b",), ("c",)]
    assert rows(S.read_table(spark, root, MART, first, ["security_id", "canonical_loaded_at"])) == [("a", stamp), ("c", stamp)]
    assert rows(S.read_table(spark, root, MART, filters=[("security_id", "in", ["b", "x"])]), "security_id") == [("b",)]
    assert rows(S.read_table(spark, root, MART, filters=[("security_id", "in", [])]), "security_id") == []
    assert rows(S.stock_basic(spark, root), "ts_code") == [("a",), ("b",)]
    with pytest.raises(ValueError):
        S.read_table(spark, root, MART, filters=[("security_id", ">", "a")])


@pytest.mark.parametrize(
    "codes,lineage", [(["a", "b"], ["a"]), (["a", "b"], ["a", "c"]), (["a", "a"], ["a", "a"]), (["a"], ["a", "a"])]
)
def test_failed_pairing_leaves_the_previous_set(spark, root, frame, rows, codes, lineage):
    publish(spark, root, pair(frame, "old"))
    with pytest.raises(S.PairingError):
        publish(spark, root, pair(frame, *codes, lineage=lineage))
    assert rows(S.read_table(spark, root, MART), "security_id") == [("old",)]


def test_empty_and_unpublished(spark, root, frame):
    with pytest.raises(S.SnapshotNotPublished):
        S.read_table(spark, root, MART)
    with pytest.raises(S.EmptyResult):
        publish(spark, root, {"stock_basic": tuple(df.where("false") for df in pair(frame, "a")["stock_basic"])})
    with pytest.raises(S.SnapshotNotPublished):
        S.read_table(spark, root, MART)


def test_month_partitions_prune(spark, root, frame, rows):
    bars = frame("security_id string, trade_date date, freq string", ("a", date(2026, 1, 5), "daily"), ("a", date(2026, 2, 5), "daily"))
    side = bars.withColumn("source_run_id", F.lit("r"))
    publish(spark, root, {"fact_price_bar": (bars, side)}, month_of={"fact_price_bar": "trade_date"})
    january = S.read_table(spark, root, "canonical_v2.fact_price_bar", columns=["security_id", "trade_date"], filters=[("trade_month", "=", "202601")])
    assert rows(january) == [("a", date(2026, 1, 5))]
    assert "trade_month" not in S.read_table(spark, root, "canonical_v2.fact_price_bar").columns


def test_contract_rejects_forbidden_and_drifting_columns(spark, root, frame):
    leak = frame("security_id string, source_run_id string", ("a", "r"))
    with pytest.raises(C.ContractError):
        S.write_snapshot(leak, root, MART, 1)
    S.write_snapshot(leak, root, "canonical_lineage.lineage_stock_basic", 1)
    with pytest.raises(C.ContractError):
        S.write_snapshot(frame("a int", (1,)), root, MART, 1, T.StructType([T.StructField("a", T.LongType())]))
    nested = T.StructType([T.StructField("x", T.ArrayType(T.StructType([T.StructField("provider_id", T.StringType())])))])
    assert C.forbidden_formal_fields(nested) == ["x[].provider_id"]
    assert C.forbidden_fields(T.StructType([T.StructField("Body", T.StringType())]), event=True) == ["Body"]


def fields(*specs):
    return T.StructType([T.StructField(n, t, null) for n, t, null in specs])


I, L, D, X = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


@pytest.mark.parametrize(
    "target,changes,rejected",
    [
        (fields(("a", L, True), ("b", X, True)), ["widen_type"], 0),
        (fields(("a", I, True), ("b", X, True), ("c", D, True)), ["add_column"], 0),
        (fields(("a", I, True), ("c", D, True), ("b", X, True)), ["add_column"], 1),
        (fields(("b", X, True), ("a", I, True)), [], 1),
        (fields(("a", I, True)), [], 2),  # a dropped column also breaks the order
        (fields(("a", I, True), ("z", X, True)), ["add_column"], 3),
        (fields(("a", X, True), ("b", X, True)), [], 1),
        (fields(("a", I, False), ("b", X, True)), [], 1),
        (fields(("a", I, True), ("b", X, True), ("c", D, False)), [], 1),
        (fields(("a", I, True), ("b", X, True), ("c", T.BinaryType(), True)), [], 1),
    ],
)
def test_evolution_rules(target, changes, rejected):
    plan = C.plan_evolution(fields(("a", I, True), ("b", X, True)), target)
    assert [c.kind for c in plan.changes] == changes and len(plan.rejections) == rejected


def test_evolution_keeps_older_snapshots(spark, root, frame, rows):
    publish(spark, root, pair(frame, "a"))
    first = S.current_snapshot_id(spark, root, MART)
    current = S.read_table(spark, root, MART).schema
    target = T.StructType([*current.fields, T.StructField("note", X)])
    assert S.evolve_table(spark, root, MART, target).requires_backfill
    assert "note" not in S.read_table(spark, root, MART).columns
    S.evolve_table(spark, root, MART, target, dry_run=False)
    assert rows(S.read_table(spark, root, MART), "security_id", "note") == [("a", None)]
    assert "note" not in S.read_table(spark, root, MART, first).columns


def test_backfill_from_select(spark, root, frame, rows):
    publish(spark, root, pair(frame, "a"))
    sql = "select 'a' as security_id, 'zz' as symbol, true as is_active"
    assert S.backfill_from_select(spark, root, MART, sql, dry_run=True) is None
    S.backfill_from_select(spark, root, MART, sql)
    assert rows(S.read_table(spark, root, MART), "security_id", "symbol") == [("a", "zz")]
    with pytest.raises(S.PairingError):  # the lineage still holds the key a
        S.backfill_from_select(spark, root, MART, sql.replace("'a'", "'z'"))
    assert rows(S.read_table(spark, root, MART), "security_id", "symbol") == [("a", "zz")]
    for bad in ("", "select 1; select 2", "drop table x", "create view v as select 1", "with t as (select 1) insert into x select 1"):
        with pytest.raises(Exception):
            S.backfill_from_select(spark, root, MART, bad)
    with pytest.raises(C.ContractError):
        S.backfill_from_select(spark, root, MART, "select 'z' as security_id")


def declared_pair(spark, frame, name="stock_basic", codes=("a", "b")):
    """One row per code in the declared columns of a mart and its lineage."""
    sides = []
    for schema, key in ((schemas.mart_schema(name), "security_id"), (schemas.lineage_schema(name), "security_id")):
        df = frame(f"{key} string", *[(c,) for c in codes])
        sides.append(df.select(*[(F.col(key) if f.name == key else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]))
    return {name: tuple(sides)}


def test_marts_meet_their_declared_schema_by_default(spark, root, frame, rows):
    mart, lineage = declared_pair(spark, frame)["stock_basic"]
    with pytest.raises(C.ContractError, match="missing column: area"):
        S.publish_pairs(spark, root, {"stock_basic": (mart.drop("area"), lineage)})
    with pytest.raises(C.ContractError, match="type of list_date"):
        S.publish_pairs(spark, root, {"stock_basic": (mart.withColumn("list_date", F.lit("x")), lineage)})
    with pytest.raises(C.ContractError, match="forbidden"):
        S.publish_pairs(spark, root, {"own": (frame("security_id string, source_run_id string", ("a", "r")), lineage)}, {"own": ["security_id"]})
    with pytest.raises(S.SnapshotNotPublished):
        S.read_table(spark, root, MART)
    # Order and undeclared columns are put right, a column that is never NULL counts as declared.
    shuffled = mart.select(*reversed(mart.columns)).withColumns({"is_active": F.lit(True), "helper": F.lit(1)})
    S.publish_pairs(spark, root, {"stock_basic": (shuffled, lineage)})
    assert S.read_table(spark, root, MART).columns == [*schemas.MART_COLUMNS["stock_basic"].split(), "canonical_loaded_at"]
    assert S.contract_violations(spark, root).isEmpty()
    publish(spark, root, {"stock_basic": (shuffled, lineage)})
    found = {r["problem"] for r in S.contract_violations(spark, root).collect()}
    assert found == {"unexpected column: helper", "nullability of is_active", "nullability of canonical_loaded_at"}


@pytest.mark.parametrize("mart, lineage", [(["a", None], ["a", None]), (["a", "a", "b"], ["a", "a", "b"]), (["a", "a", "b"], ["a", "b", "b"])])
def test_keys_are_proved_from_the_write(spark, root, frame, mart, lineage):
    sides = [frame("security_id string, n int", *[(c, 1) for c in codes]) for codes in (mart, lineage)]
    with pytest.raises(S.PairingError):
        publish(spark, root, {"stock_basic": tuple(sides)})
    with pytest.raises(S.SnapshotNotPublished):
        S.read_table(spark, root, MART)


def test_vacuum_takes_what_no_manifest_names(spark, root, frame, rows):
    publish(spark, root, pair(frame, "old"))
    first = S.current_snapshot_id(spark, root, MART)
    publish(spark, root, pair(frame, "new"))
    S.publish_formal(spark, root, "CYCLE_20260414", formal(frame, 1), 11, datetime(2026, 4, 14))
    with pytest.raises(S.PairingError):
        publish(spark, root, pair(frame, "a", lineage=["b"]))
    before = {(r["table_name"], r["snapshot_id"]) for r in S.stored_versions(spark, root).collect()}
    assert S.leftovers(spark, root).isEmpty() and S.vacuum(spark, root) == 0
    lost = S.leftovers(spark, root, timedelta(0)).collect()
    assert {r["table_name"] for r in lost} == {MART, "canonical_lineage.lineage_stock_basic"} and len(lost) == 2
    assert S.vacuum(spark, root, timedelta(0)) == 2
    after = {(r["table_name"], r["snapshot_id"]) for r in S.stored_versions(spark, root).collect()}
    assert before - after == {(r["table_name"], r["snapshot_id"]) for r in lost}
    assert rows(S.read_table(spark, root, MART, first), "security_id") == [("old",)]
    assert S.read_formal(spark, root, "official_alpha_pool")[2].first()["score"] == 1


def test_a_failed_formal_publish_can_be_repeated(spark, root, frame):
    left = f"{root}/formal/official_alpha_pool/v=11"
    frame("score int", (9,), (9,)).write.parquet(left)
    S.publish_formal(spark, root, "CYCLE_20260414", formal(frame, 1), 11)
    assert [r["score"] for r in S.read_formal(spark, root, "official_alpha_pool")[2].collect()] == [1]
    with pytest.raises(S.AlreadyPublished):
        S.publish_formal(spark, root, "CYCLE_20260415", formal(frame, 2), 11)


def formal(frame, value):
    return {n: frame("score int", (value,)) for n in M.REQUIRED_OBJECTS}


def test_formal_objects(spark, root, frame):
    S.publish_formal(spark, root, "CYCLE_20260414", formal(frame, 1), 11, datetime(2026, 4, 14))
    S.publish_formal(spark, root, "CYCLE_20260415", formal(frame, 2), 12, datetime(2026, 4, 15))
    name = "official_alpha_pool"
    got = [S.read_formal(spark, root, name, **how) for how in ({}, {"cycle_id": "CYCLE_20260414"}, {"snapshot_id": 11})]
    assert [(c, s, df.first()["score"]) for c, s, df in got] == [
        ("CYCLE_20260415", 12, 2), ("CYCLE_20260414", 11, 1), ("CYCLE_20260414", 11, 1)
    ]
    with pytest.raises(S.AlreadyPublished):
        S.publish_formal(spark, root, "CYCLE_20260415", formal(frame, 3), 13)
    with pytest.raises(S.SnapshotNotPublished):
        S.read_formal(spark, root, name, snapshot_id=99)
    with pytest.raises(ValueError):
        S.publish_formal(spark, root, "CYCLE_20260416", {name: frame("score int", (1,))}, 14)
    leaking = {**formal(frame, 1), name: frame("ts_code string", ("a",))}
    with pytest.raises(C.ContractError):
        S.publish_formal(spark, root, "CYCLE_20260416", leaking, 14)


QUEUE = "id long, payload_type string, submitted_by string, submitted_at timestamp_ntz, ingest_seq long, validation_status string"


def queue_rows(frame):
    statuses = ["accepted"] * 4 + ["rejected"] * 3 + ["pending"] * 2
    return frame(QUEUE, *[(i, "Ex-3", "u", datetime(2026, 4, 15, i), i * 10, s) for i, s in enumerate(statuses, 1)])


def test_freeze_once_and_never_twice(spark, root, frame, rows):
    queue = queue_rows(frame)
    Y.open_cycle(spark, root, "CYCLE_20260415", datetime(2026, 4, 15))
    row = Y.freeze(spark, root, queue, "CYCLE_20260415", at=datetime(2026, 4, 15, 12)).first()
    assert (row["candidate_count"], row["cutoff_ingest_seq"], row["status"]) == (4, 40, "phase0")
    assert row["cutoff_submitted_at"] == datetime(2026, 4, 15, 4)
    with pytest.raises(Y.C.CycleAlreadyFrozen):
        Y.freeze(spark, root, queue, "CYCLE_20260415")
    later = queue.union(frame(QUEUE, (99, "Ex-1", "v", datetime(2026, 4, 16), 990, "accepted")))
    Y.open_cycle(spark, root, "CYCLE_20260416", datetime(2026, 4, 16))
    assert Y.freeze(spark, root, later, "CYCLE_20260416", at=datetime(2026, 4, 16, 1)).first()["candidate_count"] == 1
    assert rows(Y.selections(spark, root).where("cycle_id = 'CYCLE_20260416'"), "candidate_id") == [(99,)]
    with pytest.raises(ValueError):
        Y.open_cycle(spark, root, "CYCLE_20260416")
    Y.step(spark, root, "CYCLE_20260415", "phase1", datetime(2026, 4, 15, 13))
    with pytest.raises(ValueError):
        Y.step(spark, root, "CYCLE_20260415", "phase3")


def test_current_cycle_needs_every_symbol(spark, root, frame):
    calendar = frame("cal_date date, is_open string", (date(2026, 4, 15), "1"), (date(2026, 4, 16), "0"))
    daily = frame("ts_code string, trade_date date", ("A", date(2026, 4, 15)))
    basics = frame("ts_code string", ("a",), ("b",))
    Y.open_cycle(spark, root, "CYCLE_20260415", datetime(2026, 4, 15))
    with pytest.raises(RuntimeError):
        Y.freeze_current_cycle(spark, root, queue_rows(frame), basics, calendar, daily, basics)
    done = Y.freeze_current_cycle(spark, root, queue_rows(frame), basics.where("ts_code = 'a'"), calendar, daily, basics)
    assert done.first()["candidate_count"] == 4


def staged_rows(spark, dataset):
    """One staged row of a dataset, all texts the digit 1."""
    values = {c: F.lit("20260415" if schemas.column_kind(dataset, c) == "date" else "1").alias(c) for c in schemas.RAW_COLUMNS[dataset]}
    raw = spark.range(1).select(*values.values(), F.lit("run").alias("source_run_id"), F.lit(datetime(2026, 4, 16)).alias("raw_loaded_at"))
    return stage(dataset, raw)


def test_one_intermediate_lies_on_disk_at_a_time(spark, root, monkeypatch):
    tables = Path(spark.conf.get("spark.checkpoint.dir")) / "lakemart-tables"
    here = lambda: set(tables.iterdir()) if tables.exists() else set()
    before, beside, write = here(), [], S.written

    def counted(*given, **named):
        beside.append(len(here() - before))
        return write(*given, **named)

    monkeypatch.setattr(S, "written", counted)
    staged = {name: staged_rows(spark, name) for name in ("forecast", "hsgt_top10")}
    results = S.publish_marts(spark, root, staged, ["fact_northbound_turnover", "fact_forecast_event"])
    assert beside == [0, 0] and here() == before
    assert [r.table.split(".")[1].removeprefix("lineage_") for r in results] == ["fact_northbound_turnover"] * 2 + ["fact_forecast_event"] * 2
    assert S.read_table(spark, root, "canonical_v2.fact_forecast_event").count() == 1


def test_nothing_is_published_where_a_later_mart_breaks_its_contract(spark, root, monkeypatch):
    staged = {name: staged_rows(spark, name) for name in ("forecast", "hsgt_top10")}
    build, project = S.marts.MARTS["fact_northbound_turnover"]
    broken = lambda df: tuple(side.withColumn("rank", F.lit("first")) for side in project(df))
    monkeypatch.setitem(S.marts.MARTS, "fact_northbound_turnover", (build, broken))
    with pytest.raises(C.ContractError):
        S.publish_marts(spark, root, staged, ["fact_forecast_event", "fact_northbound_turnover"])
    assert not Path(root).exists()


def test_shuffle_files_go_with_the_query(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
        df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        assert df.count() == 7 and df.count() == 7
    assert spark.conf.get(name) == before
