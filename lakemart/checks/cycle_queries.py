"""Queue, cycle, publish and backfill operators on the driver tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.checks.core_queries import day, money
from lakemart.checks.registry import query, table
from lakemart.functions import scalar as S
from lakemart.operators.shaping import portable
from lakemart.plans import backfill as B
from lakemart.plans import cycle as C
from lakemart.plans import manifests as P
from lakemart.plans import queue as K
from lakemart.streaming import queue_stream as Q

# --------------------------------------------------------------- queue
# Every event is one submission.  What is wrong with it follows from its type and its
# "k" property; users resend a delta id whenever the same k comes up again.

_QUEUE_SQL = """
with e as (
    select event_id as id, cast(json_extract_string(props, '$.k') as integer) as k, user_id, event_type, ts from events
), q as (
    select id, 'Ex-' || (k % 4) as payload_type, 'user-' || user_id as submitted_by, ts as submitted_at, id as ingest_seq,
           'd' || k as delta_id, k, event_type,
           case when k > 95 then 'candidate payload must be a JSON object mapping'
                when event_type = 'click' then 'producer payload must not include PostgreSQL ingest metadata fields: [''dsn'', ''ingest_seq'']'
                when event_type = 'error' then 'payload_type must be one of [''Ex-0'', ''Ex-1'', ''Ex-2'', ''Ex-3'']'
                when event_type = 'signup' then
                    case when k % 2 = 0 then 'submitted_by is required and must be a non-empty string'
                         else 'candidate submitted_by does not match candidate_queue submitted_by: robot != user-' || user_id end
           end as reason
    from e
), v as (select *, case when reason is null then 'accepted' else 'rejected' end as status from q)
"""


def _queue_rows(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    keyed = events.select("event_id", k.alias("k"), "user_id", "event_type", "ts")
    kind = F.concat(F.lit("Ex-"), (F.col("k") % 4).cast("string"))
    by = F.concat(F.lit("user-"), F.col("user_id").cast("string"))
    is_click, is_error, is_signup = [F.col("event_type") == t for t in ("click", "error", "signup")]
    payload = F.to_json(
        F.struct(
            F.when(is_error, "Ex-9").otherwise(kind).alias("payload_type"),
            F.when(is_signup, F.when(F.col("k") % 2 == 0, F.lit(" ")).otherwise(F.lit("robot"))).otherwise(by).alias("submitted_by"),
            F.concat(F.lit("d"), F.col("k").cast("string")).alias("delta_id"),
            F.when(is_click, 1).alias("ingest_seq"),
            F.when(is_click, "x").alias("dsn"),
            F.col("k").alias("weight"),
        )
    )
    return keyed.select(
        F.col("event_id").alias("id"),
        kind.alias("payload_type"),
        F.when(F.col("k") > 95, "[1, 2]").otherwise(payload).alias("payload"),
        by.alias("submitted_by"),
        F.col("ts").alias("submitted_at"),
        F.col("event_id").alias("ingest_seq"),
        F.lit("pending").alias("validation_status"),
        F.lit(None).cast("string").alias("rejection_reason"),
    )


def _validated(spark, sf) -> DataFrame:
    return K.validate(_queue_rows(table(spark, sf, "events")))


@query(
    "queue_validate",
    _QUEUE_SQL + "select id, status as validation_status, reason as rejection_reason from v",
)
def queue_validate(spark, sf):
    return _validated(spark, sf).select("id", "validation_status", "rejection_reason")


@query(
    "queue_counts",
    _QUEUE_SQL + """
    select status as validation_status, reason as rejection_reason,
           case when reason like 'producer payload%' then 'ForbiddenIngestMetadataError' when reason is not null then 'CandidateValidationError' end as rejection_type,
           count(*) as row_count from v group by all
    """,
)
def queue_counts(spark, sf):
    return K.validation_counts(_validated(spark, sf))


@query("queue_pending", _QUEUE_SQL + "select id, submitted_by from v order by ingest_seq limit 100")
def queue_pending(spark, sf):
    return K.pending(_queue_rows(table(spark, sf, "events")), 100).select("id", "submitted_by")


@query(
    "queue_receipts",
    _QUEUE_SQL + """
    , d as (select id, submitted_by, case when payload_type = 'Ex-3' and k <= 95 then delta_id end as delta from v),
    f as (select submitted_by, delta, min(id) as first_id from d where delta is not null group by all)
    select d.id as submission_id, coalesce(first_id, d.id) as candidate_id, coalesce(first_id, d.id) as ingest_seq,
           coalesce(first_id <> d.id, false) as replayed
    from d left join f on d.submitted_by = f.submitted_by and d.delta = f.delta
    """,
)
def queue_receipts(spark, sf):
    return K.submission_receipts(_queue_rows(table(spark, sf, "events")))


# Purchases were already selected by an earlier cycle.
_FREEZE_SQL = _QUEUE_SQL + ", s as (select * from v where status = 'accepted' and event_type <> 'purchase')"


def _frozen(spark, sf) -> tuple[DataFrame, DataFrame]:
    queue = _validated(spark, sf)
    earlier = table(spark, sf, "events").where(F.col("event_type") == "purchase").select(F.col("event_id").alias("candidate_id"))
    return queue, C.eligible_candidates(queue, earlier)


@query("freeze_selection", _FREEZE_SQL + "select 'CYCLE_20240131' as cycle_id, id as candidate_id from s")
def freeze_selection(spark, sf):
    return C.selected_rows(_frozen(spark, sf)[1], "CYCLE_20240131")


@query(
    "freeze_cutoffs",
    _FREEZE_SQL + """
    select strftime(max(submitted_at), '%Y-%m-%d %H:%M:%S.%f') as cutoff_submitted_at, max(ingest_seq) as cutoff_ingest_seq, count(*) as candidate_count from s
    """,
)
def freeze_cutoffs(spark, sf):
    return portable(C.freeze_cutoffs(_frozen(spark, sf)[1]))


@query(
    "freeze_filtered",
    _FREEZE_SQL + "select id as candidate_id, submitted_by from s where payload_type = 'Ex-3' and submitted_by = 'user-7'",
)
def freeze_filtered(spark, sf):
    queue = _validated(spark, sf)
    earlier = table(spark, sf, "events").where(F.col("event_type") == "purchase").select(F.col("event_id").alias("candidate_id"))
    rows = C.eligible_candidates(queue, earlier, submitted_by="user-7", payload_type="Ex-3")
    return rows.select(F.col("id").alias("candidate_id"), "submitted_by")


@query(
    "cycle_deltas",
    _FREEZE_SQL + """
    select id, ingest_seq, '{"delta_id":"' || delta_id || '","weight":' || k || '}' as delta from s where payload_type = 'Ex-3'
    """,
)
def cycle_deltas(spark, sf):
    queue, selected = _frozen(spark, sf)
    return C.cycle_deltas(queue, C.selected_rows(selected, "CYCLE_20240131"), "CYCLE_20240131")


@query(
    "cycle_transitions",
    """
    with h as (
        select user_id, event_id, case event_type when 'view' then 'pending' when 'click' then 'phase0' when 'signup' then 'phase1'
                                       when 'purchase' then 'phase2' else 'failed' end as status from events
    ), s as (select *, lag(status) over (partition by user_id order by event_id) as previous_status from h)
    select user_id, event_id, status, previous_status from s
    where case when previous_status is null then status <> 'pending'
               else previous_status || '>' || status not in ('pending>phase0', 'phase0>phase1', 'phase1>phase2', 'phase2>phase3', 'phase3>published',
                    'pending>failed', 'phase0>failed', 'phase1>failed', 'phase2>failed', 'phase3>failed') end
    """,
)
def cycle_transitions(spark, sf):
    names = {"view": "pending", "click": "phase0", "signup": "phase1", "purchase": "phase2", "error": "failed"}
    status = F.lit(None).cast("string")
    for kind, name in names.items():
        status = F.when(F.col("event_type") == kind, name).otherwise(status)
    history = table(spark, sf, "events").select("user_id", "event_id", status.alias("status"))
    return C.illegal_transitions(history, "user_id", "status", "event_id", F.floor(F.col("event_id") / 4096))


_CURRENT_SQL = """
with cal as (select distinct cast(o_orderdate as date) as d from orders where o_orderstatus = 'O'),
     t as (select max(d) as d from cal),
     bars as (select distinct o_custkey from orders where cast(o_orderdate as date) = (select d from t)),
     m as (select c_custkey, c_custkey in (select o_custkey from bars) as has_bar, c_acctbal > 0 as has_basic from customer)
"""


def _current(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    code = F.concat(F.lit(" c"), F.col("c_custkey").cast("string")).alias("ts_code")
    customers, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    flag = F.when(F.col("o_orderstatus") == "O", "1").otherwise("0")
    calendar = orders.select(day("o_orderdate").alias("cal_date"), flag.alias("is_open")).distinct()
    daily = orders.select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ts_code"), day("o_orderdate").alias("trade_date"))
    listed = F.when(F.col("c_acctbal") > 0, F.lit(" c")).otherwise(F.lit("closed-c"))
    return customers.select(code), calendar, daily, customers.select(F.concat(listed, F.col("c_custkey").cast("string")).alias("ts_code"))


@query(
    "current_cycle",
    _CURRENT_SQL + """
    select cast(d as varchar) as trade_date, 'CYCLE_' || strftime(d, '%Y%m%d') as cycle_id,
           (select count(*) from m where not (has_bar and has_basic)) as missing_symbols,
           'missing_symbol_data' as reason, false as ready from t
    """,
)
def current_cycle(spark, sf):
    return portable(C.readiness(*_current(spark, sf)))


@query(
    "current_cycle_ready",
    _CURRENT_SQL + """
    select cast(d as varchar) as trade_date, 'CYCLE_' || strftime(d, '%Y%m%d') as cycle_id, cast(0 as bigint) as missing_symbols,
           cast(null as varchar) as reason, true as ready from t where exists (select 1 from m where has_bar and has_basic)
    """,
)
def current_cycle_ready(spark, sf):
    """The same day for the symbols that miss nothing."""
    symbols, calendar, daily, basics = _current(spark, sf)
    missing = C.missing_symbols(symbols, calendar, daily, basics).select("symbol")
    whole = symbols.join(missing, F.upper(F.trim("ts_code")) == F.col("symbol"), "left_anti")
    return portable(C.readiness(whole, calendar, daily, basics))


@query(
    "current_cycle_missing",
    _CURRENT_SQL + "select 'C' || c_custkey as symbol, has_bar, has_basic from m where not (has_bar and has_basic)",
)
def current_cycle_missing(spark, sf):
    return C.missing_symbols(*_current(spark, sf))


# --------------------------------------------------------------- entities
# Nations are entities, customers their aliases (a customer alias is listed twice, the
# newer row naming its own nation); candidates are customers, nations and strangers.

_ENTITY_SQL = """
with cust as (select 'c' || c_custkey as alias, 'n' || c_nationkey as entity, c_acctbal, c_mktsegment from customer),
     ent as (select 'n' || n_nationkey as entity from nation where n_nationkey < 20),
     px as (select 'c' || o_custkey as alias, max(cast(o_totalprice as decimal(18,2))) as close, min(cast(o_totalprice as decimal(18,2))) as pre
            from orders where o_orderstatus = 'O' group by 1),
     usable as (select cust.alias, entity, close, pre, c_mktsegment from cust join px using (alias) where c_acctbal > 0),
     best as (select entity, min(alias) as alias from usable group by 1),
     cand as (select alias as id, alias as own, entity from cust union all select 'n' || n_nationkey, null, 'n' || n_nationkey from nation
              union all select 'x' || r_regionkey, null, null from region),
     res as (
        select id, ent.entity, case when ent.entity is not null then coalesce(u.alias, best.alias) end as alias
        from cand left join ent on cand.entity = ent.entity left join usable u on u.alias = own left join best on best.entity = ent.entity
     )
"""


def _entities(spark, sf):
    customers, nations = table(spark, sf, "customer"), table(spark, sf, "nation")
    alias = F.concat(F.lit("c"), F.col("c_custkey").cast("string"))
    nation = F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))
    known = F.when(F.col("n_nationkey") < 20, F.lit("n")).otherwise(F.lit("retired-n"))
    entities = nations.select(F.concat(known, F.col("n_nationkey").cast("string"), F.lit(" ")).alias("canonical_entity_id"))
    padded = F.concat(F.lit(" "), alias, F.lit(" "))
    listed = customers.select(padded.alias("alias"), nation.alias("canonical_entity_id"), F.lit(2).alias("created_at"))
    candidates = (
        customers.select(alias.alias("candidate_id"))
        .union(nations.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))))
        .union(table(spark, sf, "region").select(F.concat(F.lit("x"), F.col("r_regionkey").cast("string"))))
    )
    traded = F.when(F.col("c_acctbal") > 0, alias).otherwise(F.concat(F.lit("closed-"), alias))
    securities = customers.select(traded.alias("security_id"), F.col("c_mktsegment").alias("market"), F.lit(" ").alias("industry"))
    priced = F.when(F.col("o_orderstatus") == "O", F.lit("c")).otherwise(F.concat(F.lit("old-"), "o_orderstatus", F.lit("-c")))
    bars = (
        table(spark, sf, "orders")
        .groupBy(F.concat(priced, F.col("o_custkey").cast("string")).alias("security_id"))
        .agg(F.max(money("o_totalprice")).alias("close"), F.min(money("o_totalprice")).alias("pre_close"))
        .select(
            "*", F.lit(date(2024, 1, 31)).alias("trade_date"), F.lit("Daily").alias("freq"),
            *[F.lit(None).cast("double").alias(c) for c in ("pct_chg", "vol", "amount")],
        )
    )
    return candidates, entities, listed, securities, bars


@query(
    "entity_resolve",
    _ENTITY_SQL + """
    select id as candidate_id, res.entity as entity_id, round(cast(close as double), 6) as close,
           round((cast(close as double) - cast(pre as double)) / nullif(cast(pre as double), 0), 6) as return_1d, c_mktsegment as market,
           'cycle:CYCLE_20240131,selection:sel-1,candidate:' || id || ',canonical:security_master@3,canonical:price_bar@4' as refs
    from res join usable using (alias) where res.alias is not null
    """,
)
def entity_resolve(spark, sf):
    rows, _ = C.current_cycle_inputs("CYCLE_20240131", "sel-1", *_entities(spark, sf), {"security_master": 3, "price_bar": 4})
    return portable(
        rows.select("candidate_id", "entity_id", "close", "return_1d", "market", F.array_join("lineage_refs", ",").alias("refs"))
    )


@query(
    "entity_complete_cycle",
    _ENTITY_SQL + """
    select id as candidate_id, res.entity as entity_id, round(cast(close as double), 6) as close, c_mktsegment as market
    from res join usable using (alias) where res.alias is not null
    """,
)
def entity_complete_cycle(spark, sf):
    """The inputs of a cycle of resolvable candidates, in the form that gives all of them or an error."""
    candidates, *others = _entities(spark, sf)
    snapshots = {"security_master": 3, "price_bar": 4}
    _, missing = C.current_cycle_inputs("CYCLE_20240131", "sel-1", candidates, *others, snapshots)
    complete = candidates.join(missing.select("candidate_id"), "candidate_id", "left_anti")
    inputs = C.all_or_error(*C.current_cycle_inputs("CYCLE_20240131", "sel-1", complete, *others, snapshots))
    return portable(inputs.select("candidate_id", "entity_id", "close", "market"))


@query(
    "entity_missing",
    _ENTITY_SQL + """
    select id as candidate_id, case when entity is null then 'canonical_entity_missing' else 'canonical_candidate_rows_missing' end as reason
    from res where alias is null
    """,
)
def entity_missing(spark, sf):
    _, missing = C.current_cycle_inputs("CYCLE_20240131", "sel-1", *_entities(spark, sf), {"security_master": 3, "price_bar": 4})
    return missing.select("candidate_id", "reason")


@query(
    "entity_alias_lookup",
    "select 'c' || c_custkey as alias, 'n' || c_nationkey as canonical_entity_id from customer where c_nationkey < 20",
)
def entity_alias_lookup(spark, sf):
    _, entities, aliases, _, _ = _entities(spark, sf)
    older = aliases.select("alias", F.lit("n0").alias("canonical_entity_id"), F.lit(1).alias("created_at"))
    trimmed = entities.select(F.trim("canonical_entity_id").alias("canonical_entity_id"))
    return C.existing_entities(C.alias_entities(aliases.union(older)), trimmed, "canonical_entity_id")


# --------------------------------------------------------------- manifests
# Each order day is a cycle that publishes one table per order priority.

_MANIFEST_SQL = """
with m as (
    select 'CYCLE_' || strftime(o_orderdate, '%Y%m%d') as cycle, max(o_orderdate) as pub, 'formal.' || o_orderpriority as tab,
           max(o_custkey) as snap from orders group by 1, 3
)
"""


def _manifests(spark, sf) -> DataFrame:
    per_table = (
        table(spark, sf, "orders")
        .groupBy(
            S.cycle_id_of("o_orderdate").alias("published_cycle_id"), F.col("o_orderdate").alias("published_at"),
            F.concat(F.lit("formal."), "o_orderpriority").alias("_table"),
        )
        .agg(F.max("o_custkey").alias("_snapshot"))
    )
    # A cycle's map holds one entry per formal table, a fixed handful.
    entry = F.struct(F.col("_table").alias("key"), F.struct(F.col("_snapshot").alias("snapshot_id")).alias("value"))
    return per_table.groupBy("published_cycle_id", "published_at").agg(
        F.map_from_entries(F.collect_list(entry)).alias("formal_table_snapshots")
    )


@query(
    "manifest_lookup",
    _MANIFEST_SQL + """
    select tab as table_name, snap as snapshot_id, arg_max(cycle, pub) as published_cycle_id from m group by all
    """,
)
def manifest_lookup(spark, sf):
    return P.newest_publication(_manifests(spark, sf)).select("table_name", "snapshot_id", "published_cycle_id")


@query(
    "manifest_latest",
    _MANIFEST_SQL + "select tab as table_name, snap as snapshot_id, cycle as published_cycle_id from m where cycle = (select max(cycle) from m)",
)
def manifest_latest(spark, sf):
    newest = P.latest_manifest(_manifests(spark, sf))
    return P.published_tables(newest).select("table_name", "snapshot_id", "published_cycle_id")


@query(
    "manifest_by_snapshot",
    _MANIFEST_SQL + """
    select tab as table_name, snap as snapshot_id, arg_max(cycle, pub) as published_cycle_id from m
    where tab = 'formal.2-HIGH' and snap = (select min(snap) from m where tab = 'formal.2-HIGH') group by all
    """,
)
def manifest_by_snapshot(spark, sf):
    """The cycle that published the smallest snapshot id of a table last."""
    rows = _manifests(spark, sf)
    least = P.published_tables(rows).where("table_name = 'formal.2-HIGH'").agg(F.min("snapshot_id")).first()[0]
    return P.by_snapshot(rows, "formal.2-HIGH", least).select("table_name", "snapshot_id", "published_cycle_id")


@query(
    "recent_cycles",
    """
    select 'CYCLE_' || strftime(o_orderdate, '%Y%m%d') as cycle_id, count(*) as n from orders where o_orderstatus = 'P'
    group by 1 order by 1 desc limit 30
    """,
)
def recent_cycles(spark, sf):
    cycles = table(spark, sf, "orders").groupBy(day("o_orderdate").alias("cycle_date"), F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))
    return C.recent_cycles(cycles.withColumn("cycle_id", S.cycle_id_of("cycle_date")), 30, "P").select("cycle_id", "n")


# --------------------------------------------------------------- backfill
# Suppliers are the codes, months of shipping the calendar; the feed stops in mid-2000.

_CUTOFF = date(2000, 8, 20)
_PLAN_SQL = """
with me as (select distinct last_day(cast(l_shipdate as date)) as d from lineitem),
     plan as (
        select 'hsgt_hold_top10' as dataset, s_suppkey as code, d, ex as exchange, case when d > date '2000-08-20' then 'skipped' else 'planned' end as status,
               case when d > date '2000-08-20' then 'post_publication_cutoff' end as reason_type
        from supplier, me, (values ('SH'), ('SZ')) x(ex)
     )
"""


def _plan(spark, sf) -> DataFrame:
    ends = table(spark, sf, "lineitem").select(F.last_day("l_shipdate").alias("d")).distinct()
    codes = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("s_suppkey"))
    return B.plan_items(B.NORTHBOUND_DATASET, codes, "s_suppkey", ends, "d", ("SH", "SZ"), "exchange", _CUTOFF)


@query(
    "backfill_plan",
    _PLAN_SQL + "select dataset, cast(code as varchar) as code, cast(d as varchar) as partition_date, exchange, status, reason_type from plan",
)
def backfill_plan(spark, sf):
    return portable(_plan(spark, sf))


@query(
    "backfill_gaps",
    _PLAN_SQL + """
    select cast(code as varchar) as code, cast(d as varchar) as partition_date, exchange from plan
    where status = 'planned' and not exists (select 1 from lineitem where l_suppkey = code and last_day(cast(l_shipdate as date)) = d
          and case when l_returnflag = 'R' then 'SH' else 'SZ' end = exchange)
    """,
)
def backfill_gaps(spark, sf):
    landed = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("code"), F.last_day("l_shipdate").alias("partition_date"),
        F.when(F.col("l_returnflag") == "R", "SH").otherwise("SZ").alias("exchange"),
    )
    gaps = B.coverage_gaps(_plan(spark, sf), landed, ["code", "partition_date", "exchange"])
    return portable(gaps.select("code", "partition_date", "exchange"))


@query(
    "backfill_limit",
    _PLAN_SQL + """
    select 'rejected' as status, 'plan_item_limit_exceeded' as reason_type, count(*) as planned_count, 5000 as max_plan_items
    from plan where status = 'planned' having count(*) > 5000
    """,
)
def backfill_limit(spark, sf):
    return B.plan_limit(_plan(spark, sf), 5000)


@query(
    "backfill_window",
    """
    with m as (select last_day(cast(x as date)) as d from (
        select unnest(generate_series((select date_trunc('month', max(l_shipdate)) - interval 119 month from lineitem),
                                      (select date_trunc('month', max(l_shipdate)) from lineitem), interval 1 month)) as x))
    select cast(d as varchar) as month_end,
           cast(case when d <= date '2000-08-20' then d when d = date '2000-08-31' then date '2000-08-20' end as varchar) as provider_date,
           case when d <= date '2000-08-20' then null when d = date '2000-08-31' then 'partial_month_provider_cutoff' else 'post_publication_cutoff' end as gap_reason,
           month(d) in (3, 6, 9, 12) as is_period
    from m
    """,
)
def backfill_window(spark, sf):
    bounds = table(spark, sf, "lineitem").agg(F.max(day("l_shipdate")).alias("last"))
    dated = B.provider_dates(B.month_end_window(bounds, "last"), cutoff=_CUTOFF)
    return portable(dated.withColumn("is_period", S.is_quarter_end(F.col("month_end"))))


# --------------------------------------------------------------- streams
# Candidates are appended to a queue folder three times and read as three batches: by event id in
# order (resubmissions follow), or every third row (most rows are then behind the watermark).

_FILES = 4


def _arrived(spark, sf, label: str, turn) -> tuple[str, DataFrame]:
    """A run folder, and the stream of all candidates, which arrive in the order of ``turn`` (0, 1, 2)."""
    root = Q.new_run_folder(spark, label)
    rows = _queue_rows(table(spark, sf, "events")).withColumn("_turn", turn)
    for number in range(3):
        Q.append_candidates(rows.where(F.col("_turn") == number).drop("_turn").repartition(_FILES, "id"), f"{root}/in")
    return root, Q.queue_source(spark, f"{root}/in", files_per_batch=_FILES)


def _thirds(spark, sf):
    last = table(spark, sf, "events").agg(F.max("event_id")).scalar()
    return F.least(F.floor(F.col("id") * 3 / (last + 1)), F.lit(2))


@query("stream_queue_validate", _QUEUE_SQL + "select id, status as validation_status, reason as rejection_reason from v")
def stream_queue_validate(spark, sf):
    root, queue = _arrived(spark, sf, "validate", _thirds(spark, sf))
    Q.validate_stream(queue, root).awaitTermination()
    schema = _validated(spark, sf).schema
    accepted = Q.read_part(spark, root, "accepted", schema)
    rejected = Q.read_part(spark, root, "rejected", schema)
    return accepted.unionByName(rejected).select("id", "validation_status", "rejection_reason")


_DELTA_SQL = _QUEUE_SQL + """
    , d as (select id, submitted_by, payload_type, case when payload_type = 'Ex-3' and k <= 95 then delta_id end as delta from v)
"""
_RECEIPTS_SQL = _DELTA_SQL + """
    , f as (select submitted_by, delta, min(id) as first_id from d where delta is not null group by all)
    select d.id as submission_id, coalesce(first_id, d.id) as candidate_id, coalesce(first_id, d.id) as ingest_seq,
           coalesce(first_id <> d.id, false) as replayed
    from d left join f on d.submitted_by = f.submitted_by and d.delta = f.delta
"""


@query(
    "stream_dedup",
    _DELTA_SQL + """
    select id, submitted_by, delta as delta_id from d
    qualify delta is null or row_number() over (partition by submitted_by, delta order by id) = 1
    """,
)
def stream_dedup(spark, sf):
    root, queue = _arrived(spark, sf, "dedup", _thirds(spark, sf))
    Q.dedup_stream(queue, root).awaitTermination()
    schema = K.with_idempotency_key(_queue_rows(table(spark, sf, "events"))).schema
    return Q.read_part(spark, root, "first", schema).select("id", "submitted_by", "delta_id")


_RECEIPT = "submission_id long, candidate_id long, ingest_seq long, replayed boolean"


@query("stream_receipts", _RECEIPTS_SQL)
def stream_receipts(spark, sf):
    root, queue = _arrived(spark, sf, "receipts", _thirds(spark, sf))
    Q.dedup_stream(queue, root).awaitTermination()
    return Q.read_part(spark, root, "receipts", T.StructType.fromDDL(_RECEIPT)).drop("batch_id")


def _rates(spark, sf, label: str) -> tuple[str, DataFrame]:
    root, queue = _arrived(spark, sf, label, F.col("id") % 3)
    # Windows need an instant, so the wall-clock time is read as UTC.
    timed = K.validate(queue).withColumn("submitted_at", F.to_utc_timestamp(F.col("submitted_at").cast("timestamp"), F.current_timezone()))
    Q.rates_stream(timed, root).awaitTermination()
    return root, timed


# A row is late if its day ended an hour or more before the newest row of an earlier third.
_LATE_SQL = _QUEUE_SQL + """
    , newest as (select id % 3 as turn, max(submitted_at) as newest_at from v group by 1),
    w as (select v.*, cast(submitted_at as date) as day,
          coalesce(cast(cast(submitted_at as date) + 1 as timestamp) <= (select max(newest_at) from newest where turn < id % 3) - interval 1 hour, false) as late from v)
"""


@query(
    "stream_windowed_counts",
    _LATE_SQL + """
    select cast(day as varchar) as window_day, submitted_by, count(*) filter (where status = 'accepted') as accepted, count(*) as total,
           count(*) filter (where late) as late_rows
    from w group by all
    """,
)
def stream_windowed_counts(spark, sf):
    root, _ = _rates(spark, sf, "rates")
    latest = Q.latest_rates(spark, root)
    return latest.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_day"), "submitted_by", "accepted", "total", "late_rows")


@query("stream_late_rows", _LATE_SQL + "select id, submitted_by, cast(day as varchar) as window_day from w where late")
def stream_late_rows(spark, sf):
    root, timed = _rates(spark, sf, "late")
    late = Q.late_rows(spark, root, timed.schema)
    return late.select("id", "submitted_by", F.date_format(F.col("window_end") - F.expr("interval 1 second"), "yyyy-MM-dd").alias("window_day"))
