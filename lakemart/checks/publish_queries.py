"""Publishing, pinned reads, evolution, formal objects and cycles over sets built from the driver tables."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.checks import cycle_queries, market_queries  # noqa: F401
from lakemart.checks.market_feeds import StagedFeeds
from lakemart.checks.registry import ORACLES, query, table
from lakemart.plans import marts as M
from lakemart.plans import schemas
from lakemart.session import shared_folder
from lakemart.sources import cycle_store as Y
from lakemart.sources import snapshots as S

STAMP = datetime(2024, 2, 1)


def new_root(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/lakemart-published/{label}-{uuid.uuid4().hex}"


# --------------------------------------------------------------- whole sets


def _counts_sql() -> str:
    """Rows with a whole key of every mart and lineage, counted over their own queries' SQL."""
    parts = []
    for name in M.MARTS:
        for label, sql in ((f"{S.MART_SPACE}.{name}", f"mart_{name}"), (f"{S.LINEAGE_SPACE}.lineage_{name}", f"lineage_{name}")):
            complete = " and ".join(f"{k} is not null" for k in schemas.mart_key(name))
            parts.append(f"select '{label}' as table_name, count(*) as row_count, '2024-02-01' as loaded from ({ORACLES[sql]}) where {complete}")
    return "\nunion all\n".join(parts)


@query("publish_marts", _counts_sql())
def publish_marts(spark, sf):
    """All marts and lineages published as one set, and read back from it: rows and load time of each table."""
    root = new_root(spark, "marts")
    S.publish_marts(spark, root, StagedFeeds(spark, sf), loaded_at=STAMP, complete_keys=True)
    found = None
    for row in S.published_sets(spark, root).select(F.explode("tables").alias("name", "entry")).select("name").collect():
        df = S.read_table(spark, root, row["name"])
        counted = df.agg(
            F.lit(row["name"]).alias("table_name"), F.count("*").alias("row_count"), F.date_format(F.max("canonical_loaded_at"), "yyyy-MM-dd").alias("loaded")
        )
        found = counted if found is None else found.unionByName(counted)
    return found


# --------------------------------------------------------------- customers as securities
# Customers are listed securities, those with a positive balance active.  The first set holds
# all of them; the second leaves out nation 0.


def _securities(spark, sf) -> tuple[DataFrame, DataFrame]:
    customers = table(spark, sf, "customer")
    values = {
        "security_id": F.concat(F.lit("C"), F.col("c_custkey").cast("string")),
        "symbol": F.col("c_custkey").cast("string"),
        "display_name": F.col("c_name"),
        "market": F.col("c_mktsegment"),
        "is_active": F.col("c_acctbal") > 0,
        "source_provider": F.lit("shop"),
        "source_interface_id": F.lit("customer"),
        "source_run_id": F.concat(F.lit("n"), F.col("c_nationkey").cast("string")),
    }

    def shaped(schema: T.StructType) -> DataFrame:
        return customers.select("c_nationkey", *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])

    return shaped(schemas.mart_schema("stock_basic")), shaped(schemas.lineage_schema("stock_basic"))


STOCK = f"{S.MART_SPACE}.stock_basic"
STOCK_LINEAGE = f"{S.LINEAGE_SPACE}.lineage_stock_basic"


def _two_sets(spark, sf, label: str) -> tuple[str, int]:
    """A root with two published sets, and the snapshot id of the first."""
    root = new_root(spark, label)
    mart, lineage = _securities(spark, sf)
    S.publish_pairs(spark, root, {"stock_basic": (mart, lineage)}, loaded_at=STAMP)
    first = S.current_snapshot_id(spark, root, STOCK)
    kept = F.col("c_nationkey") != 0
    S.publish_pairs(spark, root, {"stock_basic": (mart.where(kept), lineage.where(kept))}, loaded_at=datetime(2024, 2, 2))
    return root, first


@query(
    "publish_pinned_read",
    """
    select 'first' as version, c_mktsegment as market, count(*) as securities, '2024-02-01' as loaded from customer group by all
    union all select 'newest', c_mktsegment, count(*), '2024-02-02' from customer where c_nationkey <> 0 group by all
    union all select 'building', c_mktsegment, count(*), '2024-02-01' from customer where c_mktsegment in ('BUILDING', 'MACHINERY') group by all
    """,
)
def publish_pinned_read(spark, sf):
    """The newest version, a pinned one, and a pinned one through a reader's filter."""
    root, first = _two_sets(spark, sf, "pinned")
    reads = {
        "first": S.read_table(spark, root, STOCK, first),
        "newest": S.read_table(spark, root, STOCK),
        "building": S.read_table(spark, root, STOCK, first, ["market", "canonical_loaded_at"], [("market", "in", ["BUILDING", "MACHINERY"])]),
    }
    counts = [
        df.groupBy("market").agg(F.count("*").alias("securities"), F.date_format(F.max("canonical_loaded_at"), "yyyy-MM-dd").alias("loaded")).withColumn("version", F.lit(name))
        for name, df in reads.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("publish_active_stocks", "select 'C' || c_custkey as ts_code, c_name as name from customer where c_nationkey <> 0 and c_acctbal > 0")
def publish_active_stocks(spark, sf):
    return S.stock_basic(spark, _two_sets(spark, sf, "active")[0]).select("ts_code", "name")


@query(
    "publish_refusals",
    """
    select 'empty' as refused, cast(0 as bigint) as row_count union all select 'pairing', count(*) from customer where c_nationkey <> 0
    union all select 'contract', count(*) from customer where c_nationkey <> 0 union all select 'in force', count(*) from customer where c_nationkey <> 0
    """,
)
def publish_refusals(spark, sf):
    """Publishes that must fail (no rows; lineage of other keys; a column of another type), and the rows of the set that stays in force after each."""
    root, _ = _two_sets(spark, sf, "refused")
    mart, lineage = _securities(spark, sf)
    tries = {
        "empty": ((mart.where("false"), lineage.where("false")), S.EmptyResult),
        "pairing": ((mart, lineage.where("c_nationkey <> 3")), S.PairingError),
        "contract": ((mart.withColumn("list_date", F.lit("soon")), lineage), S.contracts.ContractError),
    }
    refused = {"in force": None}
    for name, (pair, error) in tries.items():
        try:
            S.publish_pairs(spark, root, {"stock_basic": pair})
        except error:
            refused[name] = error
    rows = S.read_table(spark, root, STOCK).agg(F.count("*").alias("row_count"))
    named = rows.select(F.explode(F.array(*[F.lit(n) for n in refused])).alias("refused"), "row_count")
    return named.withColumn("row_count", F.when(F.col("refused") == "empty", F.lit(0).cast("long")).otherwise(F.col("row_count")))


@query(
    "publish_contract_violations",
    f"""
    select * from (values ('{STOCK}', 'missing column: area'), ('{STOCK}', 'unexpected column: helper'),
        ('{STOCK}', 'type of symbol: bigint != string'), ('{STOCK}', 'nullability of canonical_loaded_at'),
        ('{STOCK_LINEAGE}', 'nullability of canonical_loaded_at'), ('{STOCK_LINEAGE}', 'nullability of source_provider'),
        ('{STOCK_LINEAGE}', 'nullability of source_interface_id')) v(table_name, problem)
    where exists (select 1 from customer)
    """,
)
def publish_contract_violations(spark, sf):
    """A set published without the declared schemas, held against them."""
    root = new_root(spark, "contract")
    mart, lineage = _securities(spark, sf)
    drifted = mart.drop("area").withColumns({"helper": F.lit(None).cast("int"), "symbol": F.col("symbol").cast("long")}).drop("c_nationkey")
    S.publish_pairs(spark, root, {"stock_basic": (drifted, lineage.drop("c_nationkey").withColumn("source_provider", F.lit("shop")))}, expected={})
    return S.contract_violations(spark, root)


@query(
    "publish_vacuum",
    f"""
    select 'leftover' as state, '{STOCK}' as table_name, cast(1 as bigint) as versions union all select 'leftover', '{STOCK_LINEAGE}', 1
    union all select 'kept', '{STOCK}', 2 union all select 'kept', '{STOCK_LINEAGE}', 2
    """,
)
def publish_vacuum(spark, sf):
    """What a failed publish leaves is found and deleted; the versions of both published sets stay."""
    root, _ = _two_sets(spark, sf, "vacuum")
    mart, lineage = _securities(spark, sf)
    try:
        S.publish_pairs(spark, root, {"stock_basic": (mart, lineage.where("c_nationkey <> 3"))})
    except S.PairingError:
        pass
    lost = [r["table_name"] for r in S.leftovers(spark, root, timedelta(0)).collect()]
    S.vacuum(spark, root, timedelta(0))
    stay = S.stored_versions(spark, root).select(F.lit("kept").alias("state"), "table_name")
    gone = spark.createDataFrame([("leftover", name) for name in lost], "state string, table_name string")
    return stay.unionByName(gone).groupBy("state", "table_name").agg(F.count("*").alias("versions"))


# --------------------------------------------------------------- evolution


@query(
    "evolve_and_backfill",
    """
    select 'first' as version, cast(null as varchar) as note, count(*) as securities from customer
    union all select 'evolved', null, count(*) from customer where c_nationkey <> 0
    union all select 'filled', upper(c_mktsegment) || '!', count(*) from customer where c_nationkey <> 0 group by c_mktsegment
    """,
)
def evolve_and_backfill(spark, sf):
    """A column is added, then filled by a SELECT; the first version keeps its columns."""
    root, first = _two_sets(spark, sf, "evolve")
    schema = S.read_table(spark, root, STOCK).schema
    S.evolve_table(spark, root, STOCK, T.StructType([*schema.fields, T.StructField("note", T.StringType())]), dry_run=False)
    evolved = S.current_snapshot_id(spark, root, STOCK)
    view = f"stocks_{uuid.uuid4().hex}"
    S.read_table(spark, root, STOCK).drop("canonical_loaded_at", "note").createOrReplaceTempView(view)
    S.backfill_from_select(spark, root, STOCK, f"select *, upper(market) || '!' as note from {view}")
    versions = {"first": S.read_table(spark, root, STOCK, first).withColumn("note", F.lit(None).cast("string")), "evolved": S.read_table(spark, root, STOCK, evolved), "filled": S.read_table(spark, root, STOCK)}
    found = None
    for name, df in versions.items():
        counted = df.groupBy("note").agg(F.count("*").alias("securities")).withColumn("version", F.lit(name))
        found = counted if found is None else found.unionByName(counted)
    return found


@query(
    "evolution_steps",
    """
    select * from (values ('add', 'add_column', 'note'), ('widen', 'widen_type', 'rank'), ('narrow', 'rejected', null), ('drop', 'rejected', null),
        ('rename', 'rejected', null), ('reorder', 'rejected', null), ('required', 'rejected', null)) v(change, step, column_name)
    where exists (select 1 from nation)
    """,
)
def evolution_steps(spark, sf):
    """What the rules say to seven changes of a published table of nations."""
    have = table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("int").alias("rank"), F.col("n_regionkey").cast("double").alias("weight")).schema
    name, rank, weight = have.fields
    field = T.StructField
    targets = {
        "add": [name, rank, weight, field("note", T.StringType())],
        "widen": [name, field("rank", T.LongType(), rank.nullable), weight],
        "narrow": [name, rank, field("weight", T.FloatType(), weight.nullable)],
        "drop": [name, rank],
        "rename": [name, rank, field("mass", T.DoubleType())],
        "reorder": [rank, name, weight],
        "required": [name, rank, weight, field("note", T.StringType(), False)],
    }
    rows = []
    for change, fields in targets.items():
        plan = S.contracts.plan_evolution(have, T.StructType(fields))
        rows += [(change, "rejected", None)] if plan.rejections else [(change, s.kind, s.column) for s in plan.changes]
    return spark.createDataFrame(rows, "change string, step string, column_name string")


# --------------------------------------------------------------- formal objects and cycles
# Each order priority is a cycle; its formal objects hold the priority's orders of one status.


@query(
    "formal_reads",
    """
    with g as (select o_orderpriority as p, o_orderstatus as st, count(*) as c from orders group by all),
    o as (select p, st, c, dense_rank() over (order by p) as n from g),
    v as (select p, n, max(n) over () as last_n, st, c from o)
    select 'latest' as how, 'CYCLE_2024010' || n as cycle_id, n::bigint as snapshot_id, sum(c)::bigint as score from v where n = last_n and st = 'F' group by all
    union all select 'cycle', 'CYCLE_2024010' || n, n::bigint, sum(c)::bigint from v where n = 2 and st = 'F' group by all
    union all select 'snapshot', 'CYCLE_2024010' || n, n::bigint, sum(c)::bigint from v where n = 3 and st = 'F' group by all
    """,
)
def formal_reads(spark, sf):
    """One formal object as of the newest cycle, of a cycle, and at a published snapshot."""
    root = new_root(spark, "formal")
    counts = table(spark, sf, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("score"))
    priorities = [r[0] for r in counts.select("o_orderpriority").distinct().orderBy("o_orderpriority").collect()]
    statuses = dict(zip(S.manifests.REQUIRED_OBJECTS, ("P", "F", "O", "O"), strict=True))
    for n, priority in enumerate(priorities, 1):
        mine = counts.where(F.col("o_orderpriority") == priority)
        objects = {name: mine.where(F.col("o_orderstatus") == status).select("score") for name, status in statuses.items()}
        S.publish_formal(spark, root, f"CYCLE_2024010{n}", objects, n, datetime(2024, 1, n))
    found = None
    for how, which in {"latest": {}, "cycle": {"cycle_id": "CYCLE_20240102"}, "snapshot": {"snapshot_id": 3}}.items():
        cycle, snapshot, df = S.read_formal(spark, root, "official_alpha_pool", **which)
        row = df.select(F.lit(how).alias("how"), F.lit(cycle).alias("cycle_id"), F.lit(snapshot).cast("long").alias("snapshot_id"), "score")
        found = row if found is None else found.unionByName(row)
    return found


@query(
    "cycle_freeze_twice",
    cycle_queries._FREEZE_SQL.replace(" and event_type <> 'purchase'", "") + """
    select 'CYCLE_20240131' as cycle_id, count(*) as candidate_count, max(ingest_seq) as cutoff_ingest_seq from s where event_type <> 'purchase'
    union all select 'CYCLE_20240201', count(*), max(ingest_seq) from s where event_type = 'purchase'
    """,
)
def cycle_freeze_twice(spark, sf):
    """Two cycles frozen one after the other: the second takes what arrived since and nothing the first took."""
    root = new_root(spark, "cycles")
    queue = cycle_queries._validated(spark, sf)
    kinds = table(spark, sf, "events").select(F.col("event_id").alias("_e"), "event_type")
    typed = queue.join(kinds, queue["id"] == kinds["_e"]).drop("_e")
    for cycle, arrived in (("CYCLE_20240131", typed.where("event_type <> 'purchase'")), ("CYCLE_20240201", typed)):
        day = datetime.strptime(cycle[6:], "%Y%m%d")
        Y.open_cycle(spark, root, cycle, day)
        Y.freeze(spark, root, arrived.drop("event_type"), cycle, at=day + timedelta(hours=12))
    chosen = Y.selections(spark, root).join(queue.select("id", "ingest_seq"), F.col("candidate_id") == F.col("id"))
    return chosen.groupBy("cycle_id").agg(F.count("*").alias("candidate_count"), F.max("ingest_seq").alias("cutoff_ingest_seq"))
