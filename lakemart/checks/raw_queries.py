"""Raw zone operators over zones that are landed from the driver tables."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.checks.registry import query, table
from lakemart.operators.shaping import portable
from lakemart.plans.staging import stage
from lakemart.session import shared_folder
from lakemart.sources import raw_health as H
from lakemart.sources import raw_zone as R

SOURCE = "shop"
FIRST, SECOND, THIRD = (datetime(2024, 1, d) for d in (1, 2, 3))


def new_zone(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/lakemart-zones/{label}-{uuid.uuid4().hex}"


# --------------------------------------------------------------- landing and latest artifacts
# Orders are daily bars of their month's last day.  The second landing sends the even months again
# with other prices; a third sends the two newest months as JSON.


def _bars(spark, sf, close: Column) -> DataFrame:
    orders = table(spark, sf, "orders")
    day = F.date_format(F.last_day("o_orderdate"), "yyyyMMdd")
    return orders.select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ts_code"),
        day.alias("trade_date"),
        close.cast("string").alias("close"),
        F.col("o_orderkey").cast("string").alias("vol"),
        F.col("o_orderstatus").alias("undeclared"),
    )


def _bar_zone(spark, sf, label: str) -> str:
    zone = new_zone(spark, label)
    price = F.col("o_totalprice").cast("decimal(18,2)")
    R.land_many(_bars(spark, sf, price), zone, SOURCE, "daily", "trade_date", "first", FIRST)
    even = F.substring("trade_date", 5, 2).cast("int") % 2 == 0
    R.land_many(_bars(spark, sf, price * 2).where(even), zone, SOURCE, "daily", "trade_date", "second", SECOND)
    return zone


_BARS_SQL = """
with b as (
    select 'C' || o_custkey as ts_code, last_day(cast(o_orderdate as date)) as d, cast(o_totalprice as decimal(18,2)) as price, cast(o_orderkey as varchar) as vol
    from orders
), newest as (select distinct d from b order by d desc limit 2)
"""


def _typed(spark, zone) -> DataFrame:
    rows = stage("daily", R.read_latest(spark, zone, SOURCE, "daily"))
    return rows.select(
        "ts_code", F.col("trade_date").cast("string").alias("trade_date"), F.round(F.col("close").cast("double"), 2).alias("close"), "vol",
        "source_run_id", F.date_format("raw_loaded_at", "yyyy-MM-dd").alias("loaded"),
    )


@query(
    "raw_latest",
    _BARS_SQL + """
    select ts_code, cast(d as varchar) as trade_date, round(cast(case when month(d) % 2 = 0 then price * 2 else price end as double), 2) as close, vol,
           case when month(d) % 2 = 0 then 'second' else 'first' end as source_run_id, case when month(d) % 2 = 0 then '2024-01-02' else '2024-01-01' end as loaded
    from b
    """,
)
def raw_latest(spark, sf):
    return _typed(spark, _bar_zone(spark, sf, "latest"))


@query(
    "raw_latest_json",
    _BARS_SQL + """
    select ts_code, cast(d as varchar) as trade_date, vol,
           round(cast(case when d in (from newest) then price * 3 when month(d) % 2 = 0 then price * 2 else price end as double), 2) as close,
           case when d in (from newest) then 'third' when month(d) % 2 = 0 then 'second' else 'first' end as source_run_id,
           case when d in (from newest) then '2024-01-03' when month(d) % 2 = 0 then '2024-01-02' else '2024-01-01' end as loaded
    from b
    """,
)
def raw_latest_json(spark, sf):
    zone = _bar_zone(spark, sf, "json")
    again = _bars(spark, sf, F.col("o_totalprice").cast("decimal(18,2)") * 3)
    for row in again.select("trade_date").distinct().orderBy(F.desc("trade_date")).limit(2).collect():
        day = datetime.strptime(row["trade_date"], "%Y%m%d").date()
        R.write_raw_json(again.where(F.col("trade_date") == row["trade_date"]), zone, SOURCE, "daily", day, "third", written_at=THIRD)
    return _typed(spark, zone)


@query(
    "raw_manifest",
    _BARS_SQL + """
    select run_id, cast(d as varchar) as partition_date, count(*) as row_count, cast(1 as bigint) as entries from (
        select 'first' as run_id, d from b union all select 'second', d from b where month(d) % 2 = 0
    ) group by all
    """,
)
def raw_manifest(spark, sf):
    """The manifest after a run was sent a second time: nothing of it is landed again."""
    zone = _bar_zone(spark, sf, "manifest")
    R.land_many(_bars(spark, sf, F.lit(0)), zone, SOURCE, "daily", "trade_date", "first", THIRD)
    listed = R.list_artifacts(spark, zone, SOURCE, "daily")
    return portable(listed.groupBy("run_id", "partition_date").agg(F.max("row_count").alias("row_count"), F.count("*").alias("entries")))


@query(
    "raw_new_artifacts",
    _BARS_SQL + "select distinct 'third' as run_id, cast(d as varchar) as partition_date from b where month(d) % 2 = 0",
)
def raw_new_artifacts(spark, sf):
    """Of the artifacts on offer (all of the second landing, and the same days as a third run), those not landed yet."""
    landed = R.artifacts(spark, _bar_zone(spark, sf, "new"))
    second = landed.where(F.col("run_id") == "second")
    return portable(R.new_artifacts(second.union(second.withColumn("run_id", F.lit("third"))), landed).select("run_id", "partition_date"))


_HOLDERS_SQL = """
with c as (
    select 'C' || c_custkey as ts_code, c_name as holder_name, n_regionkey as region, cast(c_acctbal as double) as balance,
           last_day(make_date(2024, 3 * (c_custkey % 4)::int + 3, 1)) as d
    from customer join nation on c_nationkey = n_nationkey
)
"""


@query(
    "raw_latest_scoped",
    _HOLDERS_SQL + """
    select ts_code, holder_name, cast(d as varchar) as end_date, case when region < 2 then 'b' else 'a' end || region as source_run_id
    from c where region >= 2 or balance > 0
    """,
)
def raw_latest_scoped(spark, sf):
    """Holders requested by region, two regions a second time: the newest artifact of each day and request wins."""
    zone = new_zone(spark, "scoped")
    holders = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    quarter = F.last_day(F.make_date(F.lit(2024), (3 * (F.col("c_custkey") % 4) + 3).cast("int"), F.lit(1)))
    rows = holders.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ts_code"), F.date_format(quarter, "yyyyMMdd").alias("end_date"),
        F.col("c_name").alias("holder_name"), "n_regionkey", "c_acctbal",
    )
    requests = [("a", region, FIRST, F.lit(True)) for region in range(5)] + [("b", region, SECOND, F.col("c_acctbal") > 0) for region in range(2)]
    for run, region, at, kept in requests:
        some = rows.where((F.col("n_regionkey") == region) & kept).drop("n_regionkey", "c_acctbal")
        R.land_many(some, zone, SOURCE, "top10_holders", "end_date", f"{run}{region}", at, {"region": region})
    staged = stage("top10_holders", R.read_latest(spark, zone, SOURCE, "top10_holders"))
    return portable(staged.select("ts_code", "holder_name", "end_date", "source_run_id"))


# --------------------------------------------------------------- intake


@query(
    "raw_intake",
    """
    with c as (select case when o_orderstatus = 'P' then 'no_calendar_date' when o_orderpriority = '1-URGENT' then 'no_calendar_date' else 'landed' end as fault from orders)
    select fault, null as detail, count(*) as row_count from c group by fault
    union all select 'undeclared_column', 'undeclared', count(*) from orders
    union all select 'quarantined', o_orderstatus, count(*) from orders where o_orderstatus = 'P' or o_orderpriority = '1-URGENT' group by o_orderstatus
    """,
)
def raw_intake(spark, sf):
    """A CSV corpus with days that are none: what is set aside, what lands, and the records in quarantine."""
    zone = new_zone(spark, "intake")
    bad = F.when(F.col("o_orderstatus") == "P", "pending").when(F.col("o_orderpriority") == "1-URGENT", "20230231")
    orders = table(spark, sf, "orders")
    corpus = orders.select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ts_code"),
        F.coalesce(bad, F.date_format(F.last_day("o_orderdate"), "yyyyMMdd")).alias("trade_date"),
        F.col("o_orderkey").cast("string").alias("vol"),
        F.col("o_orderstatus").alias("undeclared"),
    )
    corpus.write.option("header", True).csv(f"{zone}-corpus")
    report = R.land_csv(spark, f"{zone}-corpus", zone, SOURCE, "daily", "trade_date", "corpus", FIRST)
    landed = R.read_latest(spark, zone, SOURCE, "daily").agg(F.lit("landed").alias("fault"), F.lit(None).cast("string").alias("detail"), F.count("*").alias("row_count"))
    records = R.quarantined(spark, zone, SOURCE, "daily").groupBy(F.get_json_object("record", "$.undeclared").alias("detail")).agg(F.count("*").alias("row_count"))
    return report.unionByName(landed).unionByName(records.select(F.lit("quarantined").alias("fault"), "detail", "row_count"))


# --------------------------------------------------------------- health
# An older zone with one artifact and one JSON manifest a month; the month's number decides which
# one fault, if any, is planted.

_MONTHS_SQL = """
with o as (select last_day(cast(o_orderdate as date)) as d, count(*) as n from orders group by 1),
m as (select d, n, (row_number() over (order by d) - 1) % 20 as fault from o)
"""


def _run_of(text: Column) -> Column:
    """A run id of one of the generated forms, made from a text."""
    h = F.md5(text)
    return F.concat(F.substring(h, 1, 12), F.lit("4"), F.substring(h, 14, 3), F.lit("a"), F.substring(h, 18, 15))


_RUN_SQL = "(substr(md5({0}), 1, 12) || '4' || substr(md5({0}), 14, 3) || 'a' || substr(md5({0}), 18, 15))"


def _numbered(spark, sf) -> DataFrame:
    months = table(spark, sf, "orders").groupBy(F.last_day("o_orderdate").alias("d")).agg(F.count("*").alias("n"))
    # A row per month of the calendar: the window is over the catalogue of days, not over rows.
    earlier = months.select(F.col("d").alias("_e"))
    placed = months.join(earlier, F.col("_e") < F.col("d"), "left").groupBy("d", "n").agg(F.count("_e").alias("place"))
    dt = F.date_format("d", "yyyyMMdd")
    return placed.select("d", "n", (F.col("place") % 20).cast("int").alias("fault"), dt.alias("dt"), _run_of(dt).alias("run"))


def _folder() -> Column:
    return F.when(F.col("fault") == 18, F.concat(F.lit("day-"), "dt")).otherwise(F.col("dt"))


def _manifest_text(root: str) -> Column:
    """The JSON text of a month's manifest with its fault."""
    fault = F.col("fault")

    def planted(number: int, value, otherwise) -> Column:
        return F.when(fault == number, F.lit(value) if isinstance(value, str) else value).otherwise(otherwise)

    day = F.col("d").cast("string")
    run = planted(11, "run-1", planted(15, _run_of(F.concat("dt", F.lit("x"))), F.col("run")))
    inside = F.concat(F.lit(f"{SOURCE}/daily/dt="), _folder(), F.lit("/run_id="), planted(15, _run_of(F.concat("dt", F.lit("x"))), F.col("run")))
    path = planted(9, " ", planted(10, "../../../elsewhere", planted(14, F.concat(F.lit(f"{SOURCE}/daily/dt=19000101/run_id="), "run"), inside)))
    # Every second path is absolute.
    path = F.when((F.month("d") % 2 == 0) & ~fault.isin(9, 10), F.concat(F.lit(root + "/"), path)).otherwise(path)
    count = F.col("n") + planted(17, F.lit(1), F.lit(0))
    quoted = lambda text: F.concat(F.lit('"'), text, F.lit('"'))
    entry = F.concat(
        F.lit('{"source_id":'), quoted(planted(8, "other", F.lit(SOURCE))), F.lit(',"dataset":"daily","partition_date":'), quoted(day),
        F.lit(',"run_id":'), quoted(run), F.lit(',"path":'), quoted(path),
        F.lit(',"row_count":'), planted(6, '"many"', planted(12, "-1", count.cast("string"))),
        F.lit(',"written_at":'), quoted(planted(13, "soon", F.lit("2024-01-01T00:00:00+00:00"))),
        planted(7, ',"provider":7', F.lit("")), F.lit("}"),
    )
    entries = planted(5, '"an entry"', planted(16, F.concat(entry, F.lit(","), entry), entry))
    text = F.concat(
        F.lit('{"manifest_version":1,"source_id":'), quoted(planted(2, "other", F.lit(SOURCE))), F.lit(',"dataset":"daily","partition_date":'), quoted(day),
        planted(3, ',"provider":7', F.lit("")), planted(4, "}", F.concat(F.lit(',"artifacts":['), entries, F.lit("]}"))),
    )
    return planted(1, "not json", text)


def _planted_zone(spark, sf, without: tuple[int, ...] = ()) -> str:
    zone = new_zone(spark, "health")
    months = _numbered(spark, sf).where(~F.col("fault").isin(*without))
    base = R.dataset_path(zone, SOURCE, "daily")
    bars = _bars(spark, sf, F.col("o_totalprice")).drop("undeclared")
    # The artifact of fault 19 is not there.
    rows = bars.join(months.where(F.col("fault") != 19), F.col("trade_date") == F.col("dt")).select(*bars.columns, _folder().alias("dt"), F.col("run").alias("run_id"))
    rows.repartition("dt").write.partitionBy("dt", "run_id").parquet(base)
    months.select(_manifest_text(zone).alias("value"), _folder().alias("dt")).write.mode("append").partitionBy("dt").text(base)
    return zone


@query(
    "raw_health",
    _MONTHS_SQL + """
    , found as (select unnest(case fault
        when 1 then ['manifest_unreadable', 'not_in_manifest'] when 2 then ['header_differs'] when 3 then ['header_type']
        when 4 then ['no_entry_list', 'not_in_manifest'] when 5 then ['entry_no_object', 'not_in_manifest'] when 6 then ['entry_type', 'not_in_manifest']
        when 7 then ['entry_optional_type'] when 8 then ['entry_differs'] when 9 then ['path_empty', 'not_in_manifest']
        when 10 then ['path_outside_zone', 'not_in_manifest'] when 11 then ['run_id_form', 'path_not_of_run'] when 12 then ['row_count_negative', 'row_count_differs']
        when 13 then ['written_at_no_time'] when 14 then ['path_not_of_day', 'no_such_artifact', 'not_in_manifest']
        when 15 then ['no_such_artifact', 'not_in_manifest'] when 16 then ['run_id_repeated'] when 17 then ['row_count_differs']
        when 18 then ['day_folder_name', 'header_differs', 'entry_differs'] when 19 then ['no_such_artifact'] else [] end) as code from m)
    select code, count(*) as findings from found group by code
    """,
)
def raw_health(spark, sf):
    found = H.zone_report(spark, _planted_zone(spark, sf), "*.txt", deep=True)
    return found.groupBy("code").agg(F.count("*").alias("findings"))


@query(
    "raw_manifest_violations",
    _MONTHS_SQL + """
    , e as (select strftime(d, '%Y%m%d') as dt, fault, """ + _RUN_SQL.format("strftime(d, '%Y%m%d')") + """ as run from m)
    select case fault when 11 then 'run-1' when 15 then """ + _RUN_SQL.format("dt || 'x'") + """ else run end as run_id,
           case when fault in (2, 8) then 'header_mismatch' when fault = 9 then 'missing_path,artifact_missing' when fault in (10, 14, 15, 19) then 'artifact_missing'
                when fault = 11 then 'bad_run_id' when fault = 12 then 'bad_row_count' when fault = 13 then 'bad_written_at' end as violations
    from e where fault in (2, 8, 9, 10, 11, 12, 13, 14, 15, 19)
    """,
)
def raw_manifest_violations(spark, sf):
    """The manifests of the planted zone that fit their schema, exploded and held against the listed artifacts."""
    zone = _planted_zone(spark, sf, without=(1, 5, 6))
    entries = R.explode_manifests(R.read_json_manifests(spark, [R.dataset_path(zone, SOURCE, "daily")], "*.txt"))
    files = H.listed_files(spark, zone).where(F.col("artifact").isNotNull()).select(F.col("artifact").alias("path"))
    return H.manifest_violations(entries, files, zone).select("run_id", "violations")
