from __future__ import annotations

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.plans import schemas
from lakemart.plans.staging import stage, staging_table
from lakemart.sources import raw_health as H
from lakemart.sources import raw_zone as R

RUN = "{:012x}4{:03x}8{:015x}".format


def text_rows(spark, dataset, *records):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in schemas.RAW_COLUMNS[dataset]])
    return spark.createDataFrame([tuple(r.get(c) for c in schema.fieldNames()) for r in records], schema)


def land(spark, root, dataset, day, run, at, *records, params=None):
    R.write_raw(text_rows(spark, dataset, *records), root, "tushare", dataset, day, run, params, written_at=at)


def staged(spark, root, dataset):
    return stage(dataset, R.read_latest(spark, root, "tushare", dataset))


@pytest.fixture
def zone(tmp_path):
    return str(tmp_path / "zone")


def test_latest_artifact_per_partition(spark, zone, rows):
    d14, d15 = date(2026, 4, 14), date(2026, 4, 15)
    for day, run, hour, code in ((d14, "old", 1, "000000.SZ"), (d14, "new", 2, "000001.SZ"), (d15, "one", 1, "000002.SZ")):
        land(spark, zone, "daily", day, run, datetime(2026, 4, 15, hour), {"ts_code": f" {code} ", "trade_date": f"{day:%Y%m%d}", "open": " "})
    expected = [("000001.SZ", d14, None, "new"), ("000002.SZ", d15, None, "one")]
    columns = ("ts_code", "trade_date", "open", "source_run_id")
    assert rows(staged(spark, zone, "daily"), *columns) == expected
    # The scan takes its partitions from the winners at run time.
    plan = staged(spark, zone, "daily")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


@pytest.mark.parametrize("winners", [3, 60])
def test_a_winner_without_files_is_an_error_at_any_number(spark, zone, winners):
    days = [date(2026, 1, 1) + timedelta(days=i) for i in range(winners)]
    bars = text_rows(spark, "daily", *[{"ts_code": "a", "trade_date": f"{d:%Y%m%d}"} for d in days])
    R.land_many(bars, zone, "tushare", "daily", "trade_date", "r1", datetime(2026, 4, 1))
    assert staged(spark, zone, "daily").count() == winners
    lost = R.artifacts(spark, zone).limit(1).withColumns(
        {"run_id": F.lit("r2"), "written_at": F.lit(datetime(2026, 4, 2)).cast("timestamp_ntz"), "path": F.replace("path", F.lit("r1"), F.lit("r2"))}
    )
    R._enter(spark.createDataFrame(lost.collect(), R.ARTIFACT_SCHEMA), zone)
    for rows in (R.read_latest(spark, zone, "tushare", "daily"), R.read_latest(spark, zone, "tushare", "daily").groupBy().count()):
        with pytest.raises(Exception, match="without data files: .*run_id=r2"):
            rows.collect()


def test_json_and_parquet_winners_in_one_read(spark, zone, rows):
    for i, write in enumerate((R.write_raw, R.write_raw_json, R.write_raw)):
        day = date(2026, 4, 14 + i)
        df = text_rows(spark, "daily", {"ts_code": f"c{i}", "trade_date": f"{day:%Y%m%d}", "close": "1.5"})
        write(df, zone, "tushare", "daily", day, f"r{i}", written_at=datetime(2026, 4, 20, i))
    # A newer JSON artifact replaces a Parquet one.
    newer = text_rows(spark, "daily", {"ts_code": "new", "trade_date": "20260414"}, {"ts_code": "new2", "trade_date": "20260414"})
    R.write_raw_json(newer, zone, "tushare", "daily", date(2026, 4, 14), "r9", written_at=datetime(2026, 4, 21))
    found = staged(spark, zone, "daily")
    assert rows(found, "ts_code", "source_run_id") == [("c1", "r1"), ("c2", "r2"), ("new", "r9"), ("new2", "r9")]
    assert found.where("ts_code = 'c1'").first()["close"] == "1.5"
    assert R.read_latest(spark, zone, "tushare", "block_trade").count() == 0


def test_bulk_landing_keeps_its_request_scope(spark, zone, rows):
    for run, code, hour in (("r1", "a", 1), ("r2", "a", 2), ("r3", "b", 1)):
        df = text_rows(spark, "top10_holders", *[{"ts_code": code, "end_date": d, "holder_name": run} for d in ("20260331", "20260630")])
        R.land_many(df, zone, "tushare", "top10_holders", "end_date", run, datetime(2026, 7, 1, hour), {"ts_code": code})
    found = rows(staged(spark, zone, "top10_holders"), "ts_code", "holder_name", "end_date")
    assert found == [(c, r, d) for c, r in (("a", "r2"), ("b", "r3")) for d in (date(2026, 3, 31), date(2026, 6, 30))]


def test_request_scoped_latest_keeps_one_artifact_per_request(spark, zone, rows):
    day = date(2026, 3, 31)
    for i, (run, code) in enumerate((("r1", "000001.SZ"), ("r2", "000001.SZ"), ("r3", "600000.SH"))):
        land(
            spark, zone, "top10_holders", day, run, datetime(2026, 4, 1, i),
            {"ts_code": code, "end_date": "20260331", "holder_name": run}, params={"ts_code": code, "period": "20260331"},
        )
    assert rows(staged(spark, zone, "top10_holders"), "ts_code", "holder_name") == [("000001.SZ", "r2"), ("600000.SH", "r3")]


def test_static_dataset_keeps_the_newest_artifact_only(spark, zone, rows):
    for i, code in enumerate(("000001.SZ", "000002.SZ")):
        land(spark, zone, "stock_basic", date(2026, 4, 14 + i), f"r{i}", datetime(2026, 4, 16, i), {"ts_code": code, "list_status": " l "})
    assert rows(staged(spark, zone, "stock_basic"), "ts_code", "is_active") == [("000002.SZ", True)]


def test_narrow_artifact_reads_with_null_columns(spark, zone, frame):
    R.write_raw(frame("ts_code string, list_date string", ("000001.SZ", "19910403")), zone, "tushare", "stock_basic", date(2026, 4, 15), "narrow")
    row = staged(spark, zone, "stock_basic").first()
    assert (row["ts_code"], row["list_date"], row["name"], row["is_active"]) == ("000001.SZ", date(1991, 4, 3), None, None)


def test_every_dataset_stages_its_declared_columns(spark):
    art = spark.createDataFrame([("r", date(2026, 4, 15), datetime(2026, 4, 15, 1), "")], "run_id string, partition_date date, written_at timestamp_ntz, request_params_hash string")
    for dataset, columns in schemas.RAW_COLUMNS.items():
        values = {"date": F.lit("20260415"), "measure": F.lit("1.123456789012345678").cast("decimal(38,18)"), "text": F.lit(" x ")}
        raw = spark.range(1).select(
            *[values[schemas.column_kind(dataset, c)].alias(c) for c in columns], F.lit("20260415").alias("dt"), F.lit("r").alias("run_id")
        )
        out = staging_table(dataset, raw, art)
        extra = ["is_active"] if dataset == "stock_basic" else []
        assert out.columns == [*columns, *extra, "source_run_id", "raw_loaded_at"]
        kinds = {f.name: f.dataType.simpleString() for f in out.schema.fields}
        assert all(kinds[c] == {"date": "date", "measure": "decimal(38,18)", "text": "string"}[schemas.column_kind(dataset, c)] for c in columns)


def test_run_ids_land_once_and_leftovers_are_replaced(spark, zone):
    day = date(2026, 4, 15)
    leftover = R.artifact_path(zone, "tushare", "adj_factor", day, "r1")
    text_rows(spark, "adj_factor", {"ts_code": "stale"}).write.parquet(leftover)
    land(spark, zone, "adj_factor", day, "r1", datetime(2026, 4, 15, 1), {"ts_code": "a"}, {"ts_code": "b"})
    assert spark.read.parquet(leftover).count() == 2
    with pytest.raises(R.RunAlreadyLanded):
        land(spark, zone, "adj_factor", day, "r1", datetime(2026, 4, 15, 2), {"ts_code": "c"})
    listed = R.list_artifacts(spark, zone, "tushare", "adj_factor", day).collect()
    assert [(r["run_id"], r["row_count"]) for r in listed] == [("r1", 2)]


def test_json_artifacts_and_new_run_ids(spark, zone, frame):
    R.write_raw_json(frame("a int, b string", (1, "x"), (2, "y")), zone, "other", "notes", date(2026, 4, 15), "j1")
    landed = R.artifacts(spark, zone)
    assert landed.first()["row_count"] == 2
    assert spark.read.json(landed.first()["path"]).count() == 2
    incoming = landed.union(landed.withColumn("run_id", F.lit("j2")))
    assert [r["run_id"] for r in R.new_artifacts(incoming, landed).collect()] == ["j2"]


def test_csv_corpus_lands_its_good_rows_and_reports_the_others(spark, zone, tmp_path, rows):
    csv = tmp_path / "corpus.csv"
    csv.write_text(
        "ts_code,trade_date,adj_factor,unused\na,20260414,1.0,z\nb, 20260414 ,2.0,\nc,20260415,3.0,z\n"
        "d,20260230,4.0,z\ne,,5.0,z\nf,15 April,6.0,z\ng,20260415\nh,20260415,8.0,z,more\n"
    )
    report = R.land_csv(spark, str(csv), zone, "tushare", "adj_factor", "trade_date", "c1", datetime(2026, 4, 16), {"corpus": 1})
    assert rows(report) == [("malformed_line", None, 2), ("no_calendar_date", None, 3), ("undeclared_column", "unused", 6)]
    aside = R.quarantined(spark, zone, "tushare", "adj_factor")
    assert rows(aside, "fault", "detail") == [
        ("malformed_line", "g,20260415"), ("malformed_line", "h,20260415,8.0,z,more"),
        ("no_calendar_date", "15 April"), ("no_calendar_date", "20260230"), ("no_calendar_date", "NULL"),
    ]
    assert {json.loads(r["record"])["ts_code"] for r in aside.where("fault = 'no_calendar_date'").collect()} == set("def")
    R.land_csv(spark, str(csv), zone, "tushare", "adj_factor", "trade_date", "c1", datetime(2026, 4, 17))
    listed = R.list_artifacts(spark, zone, "tushare", "adj_factor").orderBy("partition_date").collect()
    assert [(f"{r['partition_date']:%d}", r["row_count"], r["request_params_hash"]) for r in listed] == [
        (d, n, R.params_hash({"corpus": 1})) for d, n in (("14", 2), ("15", 1))
    ]
    assert sorted(r["adj_factor"] for r in staged(spark, zone, "adj_factor").collect()) == ["1.0", "2.0", "3.0"]
    assert H.health_report(spark, zone, deep=True).isEmpty()


def test_health_report_names_each_kind_of_damage(spark, zone):
    day = date(2026, 4, 15)
    land(spark, zone, "adj_factor", day, "good", datetime(2026, 4, 15, 1), {"ts_code": "a"})
    assert H.health_report(spark, zone, deep=True).isEmpty()
    text_rows(spark, "adj_factor", {"ts_code": "x"}).write.parquet(R.artifact_path(zone, "tushare", "adj_factor", day, "orphan"))
    good = R.artifacts(spark, zone).first()
    entry = good.asDict()
    bad = [
        {**entry, "run_id": "gone", "path": entry["path"].replace("good", "gone")},
        {**entry, "row_count": 7},
    ]
    R._enter(spark.createDataFrame([tuple(b[c] for c in R.ARTIFACT_SCHEMA.fieldNames()) for b in bad], R.ARTIFACT_SCHEMA), zone)
    codes = {r["code"] for r in H.health_report(spark, zone, deep=True).collect()}
    assert codes == {"no_such_artifact", "not_in_manifest", "run_id_repeated", "row_count_differs"}


def test_a_compacted_manifest_tells_the_same(spark, zone, rows):
    for i in range(4):
        land(spark, zone, "adj_factor" if i % 2 else "daily", date(2026, 4, 15), f"r{i}", datetime(2026, 4, 15, i), {"ts_code": "a"})
    columns = [c for c in R.ARTIFACT_SCHEMA.fieldNames() if c != "metadata"]
    before = rows(R.artifacts(spark, zone), *columns)
    # A run that stops before it deletes leaves entries twice on disk and once in what is read.
    R._enter(R.artifacts(spark, zone), zone)
    assert rows(R.artifacts(spark, zone), *columns) == before
    assert R.compact_manifest(spark, zone) == 6
    assert len(R.artifacts(spark, zone).inputFiles()) == 2 and R.compact_manifest(spark, zone) == 2
    assert rows(R.artifacts(spark, zone), *columns) == before
    assert staged(spark, zone, "daily").count() == 1 and H.health_report(spark, zone, deep=True).isEmpty()


def older_zone(spark, root):
    """Single-file artifacts and a JSON manifest a day; each day but the first has one fault. Returns {day: codes}."""
    import gzip

    table = root / "made"
    text_rows(spark, "adj_factor", {"ts_code": "a", "adj_factor": "1"}).coalesce(1).write.parquet(str(table))
    body = next(table.glob("part-*.parquet")).read_bytes()
    zone, expected = root / "zone", {}

    def day(number, *codes, header=(), entry=(), entries=None, folder=None, text=None, data=body, extension="parquet", write=True):
        stamp = f"202604{number:02d}"
        part = zone / "src" / "adj_factor" / (folder or f"dt={stamp}")
        part.mkdir(parents=True)
        run = RUN(number, 1, 1)
        if write:
            (part / f"{run}.{extension}").write_bytes(data)
        one = dict(source_id="src", dataset="adj_factor", partition_date=f"2026-04-{number:02d}", run_id=run,
                   path=f"src/adj_factor/{part.name}/{run}.{extension}", row_count=1, written_at="2026-04-30T01:00:00+00:00")
        one.update(entry)
        top = dict(manifest_version=1, source_id="src", dataset="adj_factor", partition_date=one["partition_date"], artifacts=[one] if entries is None else entries(one))
        top.update(header)
        (part / "manifest.json").write_text(json.dumps(top) if text is None else text)
        expected[part.name] = sorted(codes)

    lost = "not_in_manifest"
    day(1)
    day(2, data=gzip.compress(b'[{"a": 1}]'), extension="json.gz")
    day(3, data=gzip.compress(b'{"a": 1}'), extension="json.gz")
    day(4, "manifest_unreadable", lost, text="{")
    day(5, "manifest_unreadable", lost, text="[1]")
    day(6, "header_differs", header={"dataset": "other"})
    day(7, "header_type", header={"partition_key": "a", "doc_api": 3})
    day(8, "no_entry_list", lost, header={"artifacts": {}})
    day(9, "entry_no_object", entries=lambda e: [e, 5])
    day(10, "entry_type", lost, entry={"row_count": True})
    day(11, "entry_optional_type", entry={"schema_hash": []})
    day(12, "entry_differs", entry={"source_id": "other"})
    day(13, "path_empty", lost, entry={"path": " "})
    day(14, "path_outside_zone", lost, entry={"path": "src/../../x.parquet"})
    day(15, "run_id_form", "path_not_of_run", entry={"run_id": "r"})
    day(16, "row_count_negative", "row_count_differs", entry={"row_count": -1})
    day(17, "written_at_no_time", entry={"written_at": "noon"})
    day(18, "path_not_of_day", lost, entry={"path": f"src/adj_factor/dt=20260401/{RUN(18, 1, 1)}.parquet"}, )
    expected["dt=20260418"].append("no_such_artifact")
    day(19, "no_such_artifact", write=False)
    day(20, "run_id_repeated", entries=lambda e: [e, e])
    day(21, "row_count_differs", entry={"row_count": 4})
    day(22, "artifact_unreadable", data=b"PAR1 broken")
    day(23, "day_folder_name", "header_differs", "entry_differs", folder="dt=20260431x")
    day(24, entry={"path": f"src/adj_factor/./x/../dt=20260424/{RUN(24, 1, 1)}.parquet"})
    day(25, "row_count_differs", data=gzip.compress(b'{"a": 1}\n{"a": 2}\n'), extension="json.gz")
    day(26, entry={"path": str(zone / "src" / "adj_factor" / "dt=20260426" / f"{RUN(26, 1, 1)}.parquet")})
    return str(zone), {k: sorted(v) for k, v in expected.items()}


def test_every_rule_finds_its_planted_fault_in_an_older_zone(spark, tmp_path):
    zone, expected = older_zone(spark, tmp_path)
    found = {name: [] for name in expected}
    for r in H.zone_report(spark, zone, deep=True).collect():
        # A path that leaves its day is reported where the entry says it lies.
        name = next((n for n in sorted(found, key=len, reverse=True) if n in r["path"]), None)
        if r["code"] == "path_outside_zone":
            assert r["path"].endswith("/x.parquet") and "/zone/" not in r["path"]
            name = "dt=20260414"
        elif RUN(18, 1, 1) in r["path"]:
            name = "dt=20260418"
        found[name].append(r["code"])
    assert {k: sorted(v) for k, v in found.items()} == expected


def test_load_times_do_not_depend_on_the_session_zone(spark, frame):
    times = frame("t string", ("2026-04-15T01:00:00Z",), ("2026-04-15T03:00:00+02:00",), ("2026-04-15T01:00:00",), ("soon",))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Shanghai"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in times.select(R.utc_wall(F.col("t"))).collect()]
            assert got == [datetime(2026, 4, 15, 1)] * 3 + [None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_older_zone_with_single_files_and_json_manifests(spark, tmp_path, rows):
    folder = tmp_path / "tushare" / "adj_factor"
    run = RUN(1, 2, 3)
    part = folder / "dt=20260415"
    part.mkdir(parents=True)
    text_rows(spark, "adj_factor", {"ts_code": "a", "adj_factor": "1"}).coalesce(1).write.parquet(str(tmp_path / "out"))
    source = next((tmp_path / "out").glob("part-*.parquet"))
    (part / f"{run}.parquet").write_bytes(source.read_bytes())
    entry = dict(source_id="tushare", dataset="adj_factor", partition_date="2026-04-15", run_id=run, path=str(part / f"{run}.parquet"), row_count=1, written_at="2026-04-15T01:00:00", request_params_hash="")
    broken = {**entry, "run_id": "not-a-run", "path": "tushare/none.parquet", "row_count": -1, "dataset": "daily"}
    manifest = tmp_path / "manifest.json"
    manifest.write_text(json.dumps({"manifest_version": 1, "source_id": "tushare", "dataset": "adj_factor", "partition_date": "2026-04-15", "artifacts": [entry, broken]}))
    with pytest.raises(ValueError):
        R.read_json_manifests(spark, [str(tmp_path / "_manifest.json")])
    entries = R.explode_manifests(R.read_json_manifests(spark, [str(manifest)]))
    found = H.manifest_violations(entries, spark.createDataFrame([(entry["path"],)], "path string"), str(tmp_path))
    assert rows(found, "run_id", "violations") == [("not-a-run", "header_mismatch,bad_run_id,artifact_missing,bad_row_count")]
    raw = R.read_single_files(spark, str(folder), schemas.raw_schema("adj_factor"))
    out = staging_table("adj_factor", raw, R.artifact_rows(entries.where(F.col("run_id") == run)))
    assert rows(out, "ts_code", "source_run_id") == [("a", run)]
