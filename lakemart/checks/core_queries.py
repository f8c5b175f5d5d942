"""Operators shown directly on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.checks.registry import query, table
from lakemart.functions import scalar as S
from lakemart.operators import quality as Q
from lakemart.operators.joins import interval_pairs, spine_join
from lakemart.operators.ordering import latest_per_key, newest_first, top_rows
from lakemart.operators.rolling import rolling_zscore, with_next, with_previous
from lakemart.operators.shaping import (
    matching,
    only,
    portable,
    rename,
    union_by_name,
)
from lakemart.plans import derivations as D
from lakemart.plans import intermediate as I
from lakemart.plans import marts as M
from lakemart.plans.staging import select_latest

MONEY = "decimal(18,2)"


def day(column: str):
    return F.col(column).cast("date")


def money(column: str):
    return F.col(column).cast(MONEY)


# --------------------------------------------------------------- latest artifact
# An artifact is what one user sent of one event type on one day; its load time is
# the newest event in it and its request scope is the event type.

_RAW_SQL = """
with raw as (
    select *, cast(ts as date) as d, concat(event_type, '-', user_id) as run_id from events
), art as (
    select d, run_id, event_type as scope, max(ts) as written_at from raw group by all
), win as (
    select d, run_id, written_at from art
    qualify row_number() over ({keys} order by written_at desc, d desc, run_id desc) = 1
)
select event_id, run_id as source_run_id, cast(d as varchar) as day, value,
       strftime(written_at, '%Y-%m-%d %H:%M:%S.%f') as raw_loaded_at
from raw join win using (d, run_id)
"""


def _latest(spark: SparkSession, sf: str, partitioned: bool, scoped: bool) -> DataFrame:
    raw = table(spark, sf, "events").select(
        "event_id",
        "value",
        "ts",
        "event_type",
        day("ts").alias("day"),
        F.date_format("ts", "yyyyMMdd").alias("dt"),
        F.concat_ws("-", "event_type", "user_id").alias("run_id"),
    )
    artifacts = raw.groupBy(
        F.col("day").alias("partition_date"), "run_id", F.col("event_type").alias("request_params_hash")
    ).agg(F.max("ts").alias("written_at"))
    chosen = select_latest(raw, artifacts, partitioned, scoped)
    return portable(chosen.select("event_id", "source_run_id", "day", "value", "raw_loaded_at"))


@query("latest_partitioned", _RAW_SQL.format(keys="partition by d"))
def latest_partitioned(spark, sf):
    return _latest(spark, sf, True, False)


@query("latest_request_scoped", _RAW_SQL.format(keys="partition by d, scope"))
def latest_request_scoped(spark, sf):
    return _latest(spark, sf, True, True)


@query("latest_static", _RAW_SQL.format(keys=""))
def latest_static(spark, sf):
    return _latest(spark, sf, False, False)


@query("latest_static_scoped", _RAW_SQL.format(keys="partition by scope"))
def latest_static_scoped(spark, sf):
    return _latest(spark, sf, False, True)


@query(
    "unnest_tokens",
    """
    with t as (select lang, unnest(string_split(text, ' ')) as token from documents)
    select lang, count(*) as token_count, count(distinct token) as distinct_tokens
    from t where token <> '' group by lang
    """,
)
def unnest_tokens(spark, sf):
    words = table(spark, sf, "documents").select("lang", F.explode(F.split("text", " ")).alias("token"))
    per_word = words.where(F.col("token") != "").groupBy("lang", "token").agg(F.count("*").alias("n"))
    return per_word.groupBy("lang").agg(F.sum("n").alias("token_count"), F.count("*").alias("distinct_tokens"))


# --------------------------------------------------------------- scalar functions


@query(
    "union_missing_cols",
    """
    select 'customer' as kind, c_custkey as party, c_name as name, c_mktsegment as segment,
           cast(cast(c_acctbal as decimal(18,2)) as varchar) as balance from customer
    union all
    select 'supplier', s_suppkey, s_name, null, cast(cast(s_acctbal as decimal(18,2)) as varchar) from supplier
    """,
)
def union_missing_cols(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("party"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), money("c_acctbal").alias("balance"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("party"), F.col("s_name").alias("name"),
        money("s_acctbal").alias("balance"),
    )
    return portable(union_by_name([customers, suppliers], allow_missing=True))


@query(
    "scalar_normalise",
    """
    select p_partkey, nullif(trim('  ' || p_name || ' '), '') as name,
           nullif(trim(case when p_type = 'SMALL' then '   ' else p_type end), '') as part_type,
           nullif(trim(cast(p_size as varchar)), '') as size_text
    from part
    """,
)
def scalar_normalise(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        S.clean_text(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("name"),
        S.clean_text(F.when(F.col("p_type") == "SMALL", "   ").otherwise(F.col("p_type"))).alias("part_type"),
        S.clean_text("p_size").alias("size_text"),
    )


@query(
    "scalar_dates",
    """
    select o_orderkey, cast(cast(o_orderdate as date) as varchar) as strict,
           case when o_orderstatus in ('O', 'F') then cast(cast(o_orderdate as date) as varchar) end as lenient
    from orders
    """,
)
def scalar_dates(spark, sf):
    mixed = (
        F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyyMMdd"))
        .otherwise(F.date_format("o_orderdate", "yyyyMM"))
    )
    return portable(
        table(spark, sf, "orders").select(
            "o_orderkey",
            S.strict_date(F.date_format("o_orderdate", "yyyyMMdd")).alias("strict"),
            S.lenient_date(mixed).alias("lenient"),
        )
    )


@query(
    "scalar_decimal",
    """
    select o_orderkey,
           cast(cast(cast(o_totalprice as decimal(18,2)) as decimal(38,18)) as varchar) as strict,
           case when o_orderstatus <> 'P'
                then cast(cast(cast(o_totalprice as decimal(18,2)) as decimal(38,18)) as varchar) end as lenient,
           try_cast(substr(o_orderpriority, 1, 1) as integer) as rank,
           o_orderstatus = 'P' as unparsable
    from orders
    """,
)
def scalar_decimal(spark, sf):
    text = F.concat(F.lit(" "), money("o_totalprice").cast("string"))
    odd = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("about "), text)).otherwise(F.trim(text))
    orders = table(spark, sf, "orders").withColumn("price_text", odd)
    bad = F.col("price_text").isNotNull() & S.lenient_measure("price_text").isNull()
    return portable(
        orders.select(
            "o_orderkey",
            S.strict_measure(text).alias("strict"),
            S.lenient_measure("price_text").alias("lenient"),
            S.lenient_int(F.substring("o_orderpriority", 1, 1)).alias("rank"),
            bad.alias("unparsable"),
        )
    )


@query(
    "scalar_flags",
    """
    select o_orderkey,
           case o_orderstatus when 'O' then true when 'F' then false end as flag,
           o_orderstatus = 'O' as listed,
           o_orderstatus in ('O', 'P') as open_day
    from orders
    """,
)
def scalar_flags(spark, sf):
    def spell(o: str, f: str, p: str):
        status = F.col("o_orderstatus")
        return F.when(status == "O", o).when(status == "F", f).when(status == "P", p)

    return table(spark, sf, "orders").select(
        "o_orderkey",
        S.tri_state(spell(" 1", "0 ", "2")).alias("flag"),
        S.is_listed(spell(" l ", "D", "P")).alias("listed"),
        S.is_open_day(spell(" Yes", "no", "T")).alias("open_day"),
    )


_CODE_SQL = "lpad(cast({k} as varchar), 6, '0') || case {k} % 4 when 0 then '.SH' when 1 then '.sz' when 2 then '.BJ' else '.HK' end"


def _code(key: str):
    suffix = F.element_at(F.array(*[F.lit(x) for x in (".SH", ".sz", ".BJ", ".HK")]), (F.col(key) % 4 + 1).cast("int"))
    return F.concat(F.lpad(F.col(key).cast("string"), 6, "0"), suffix)


@query(
    "scalar_case",
    f"""
    select c_custkey, {_CODE_SQL.format(k='c_custkey')} as code,
           case c_custkey % 4 when 0 then 'SSE' when 1 then 'SZSE' when 2 then 'BSE' end as exchange
    from customer
    """,
)
def scalar_case(spark, sf):
    coded = table(spark, sf, "customer").select("c_custkey", _code("c_custkey").alias("code"))
    return coded.withColumn("exchange", S.exchange_of("code"))


@query(
    "scalar_concat",
    """
    select p_partkey, concat('part:', nullif(p_type, 'SMALL')) as holder,
           md5(concat_ws('|', p_brand, nullif(p_type, 'SMALL'), cast(p_size as varchar))) as key,
           concat('brand=', coalesce(p_brand, ''), ';type=', coalesce(nullif(p_type, 'SMALL'), '')) as label
    from part
    """,
)
def scalar_concat(spark, sf):
    kind = F.nullif(F.col("p_type"), F.lit("SMALL"))
    return table(spark, sf, "part").select(
        "p_partkey",
        S.glue(F.lit("part:"), kind).alias("holder"),
        S.row_hash(F.col("p_brand"), kind, F.col("p_size")).alias("key"),
        S.labelled("brand=", F.col("p_brand"), ";type=", kind).alias("label"),
    )


@query(
    "rename_map",
    "select p_partkey as security_id, p_name as display_name, p_brand as industry, p_type as market from part",
)
def rename_map(spark, sf):
    mapping = {"p_partkey": "security_id", "p_name": "display_name", "p_brand": "industry", "p_type": "market"}
    return only(rename(table(spark, sf, "part"), mapping), list(mapping.values()))


@query(
    "read_filters",
    """
    select 'equal' as filter, c_custkey, c_name from customer where c_mktsegment = 'MACHINERY'
    union all
    select 'in', c_custkey, c_name from customer where c_nationkey in (1, 2, 3) and c_mktsegment = 'FURNITURE'
    """,
)
def read_filters(spark, sf):
    customers = table(spark, sf, "customer")
    cases = {
        "equal": [("c_mktsegment", "=", "MACHINERY")],
        "in": [("c_nationkey", "in", [1, 2, 3]), ("c_mktsegment", "=", "FURNITURE")],
        "empty": [("c_nationkey", "in", [])],
    }
    return union_by_name(
        [
            only(matching(customers, filters), ["c_custkey", "c_name"]).select(F.lit(name).alias("filter"), "*")
            for name, filters in cases.items()
        ]
    )


@query(
    "json_props",
    """
    select event_type, cast(json_extract_string(props, '$.k') as integer) as k, count(*) as n
    from events group by all
    """,
)
def json_props(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int").alias("k")
    return table(spark, sf, "events").groupBy("event_type", k).agg(F.count("*").alias("n"))


@query(
    "cycle_id",
    """
    select 'CYCLE_' || strftime(o_orderdate, '%Y%m%d') as cycle_id,
           cast(cast(o_orderdate as date) as varchar) as cycle_date, count(*) as n
    from orders group by all
    """,
)
def cycle_id(spark, sf):
    ids = table(spark, sf, "orders").groupBy(S.cycle_id_of("o_orderdate").alias("cycle_id")).agg(F.count("*").alias("n"))
    return portable(ids.withColumn("cycle_date", S.cycle_date_of("cycle_id")))


@query(
    "calendar_spine",
    """
    with m as (
        select last_day(cast(x as date)) as month_end from (
            select unnest(generate_series(
                (select date_trunc('month', min(o_orderdate)) from orders),
                (select date_trunc('month', max(o_orderdate)) from orders), interval 1 month)) as x)
    ), o as (select last_day(cast(o_orderdate as date)) as month_end, count(*) as n from orders group by 1)
    select cast(m.month_end as varchar) as month_end, month(m.month_end) in (3, 6, 9, 12) as is_period,
           coalesce(o.n, 0) as order_count
    from m left join o using (month_end)
    """,
)
def calendar_spine(spark, sf):
    orders = table(spark, sf, "orders")
    bounds = orders.agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    months = backfill.month_ends(bounds, "first", "last")
    counts = orders.groupBy(F.last_day("o_orderdate").alias("_end")).agg(F.count("*").alias("n"))
    joined = months.join(counts, months["month_end"] == counts["_end"], "left")
    return portable(
        joined.select(
            "month_end",
            S.is_quarter_end(F.col("month_end")).alias("is_period"),
            F.coalesce("n", F.lit(0)).alias("order_count"),
        )
    )


from lakemart.plans import backfill  # noqa: E402  (used by the calendar and backfill queries)

# --------------------------------------------------------------- event timeline


@query(
    "event_timeline",
    """
    with e as (
        select 'order' as event_type, 'orders' as src, o_custkey as entity, cast(o_orderdate as date) as d,
               'Order' as title,
               concat('status=', o_orderstatus, ';price=', cast(cast(o_totalprice as decimal(18,2)) as varchar)) as summary,
               o_orderpriority as sub, cast(o_orderdate as date) as rel
        from orders
        union all
        select 'shipment', 'lineitem', l_suppkey, cast(l_shipdate as date), 'Shipment',
               concat('qty=', cast(cast(l_quantity as decimal(18,2)) as varchar), ';band=[', l_returnflag, ',', l_linestatus, ']'),
               l_linestatus, null
        from lineitem
        union all
        select 'action', 'events', user_id, cast(ts as date), event_type, props, null, null from events
    )
    select event_type, entity, cast(d as varchar) as event_date,
           md5(concat_ws('|', src, event_type, title, coalesce(summary, ''), coalesce(sub, ''),
                         coalesce(cast(rel as varchar), ''), '', '')) as event_key, count(*) as n
    from e group by all
    """,
)
def event_timeline(spark, sf):
    none = [F.lit(None).cast("string").alias("source_run_id"), F.lit(None).cast("timestamp_ntz").alias("raw_loaded_at")]
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("ts_code"), day("o_orderdate").alias("at"), F.col("o_orderstatus").alias("status"),
        money("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"), *none,
    )
    lines = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("ts_code"), day("l_shipdate").alias("at"), money("l_quantity").alias("qty"),
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("line"), *none,
    )
    actions = table(spark, sf, "events").select(
        F.col("user_id").alias("ts_code"), day("ts").alias("at"), "event_type", "props", *none
    )
    shaped = [
        I.event_shape(orders, "order", dict(source="orders", date="at", title="=Order", summary="status=status price=price", subtype="priority", related="at")),
        I.event_shape(lines, "shipment", dict(source="lineitem", date="at", title="=Shipment", summary="qty=qty band=flag..line", subtype="line")),
        I.event_shape(actions, "action", dict(source="events", date="at", title="event_type", summary="props")),
    ]
    keyed = union_by_name(shaped).select(
        "event_type", F.col("ts_code").alias("entity"), "event_date", M.event_key().alias("event_key")
    )
    return portable(keyed.groupBy(*keyed.columns).agg(F.count("*").alias("n")))


@query(
    "return_1d",
    """
    with c as (
        select event_type, cast(ts as date) as d, arg_max(value, (ts, event_id)) as close, max(value) as high from events group by all
    ), p as (
        select *, lag(close) over (partition by event_type order by d) as pre_close,
               case when day(d) % 2 = 0 then high end as pct from c
    )
    select event_type, cast(d as varchar) as day, close, pre_close,
           round(coalesce(pct / 100.0, (close - pre_close) / nullif(pre_close, 0)), 6) as return_1d
    from p
    """,
)
def return_1d(spark, sf):
    daily = (
        table(spark, sf, "events")
        .groupBy("event_type", day("ts").alias("day"))
        .agg(F.max_by("value", F.struct("ts", "event_id")).alias("close"), F.max("value").alias("high"))
    )
    lagged = with_previous(daily, ["event_type"], "day", ["close"], "pre_")
    stated = F.when(F.dayofmonth("day") % 2 == 0, F.col("high"))
    return portable(
        lagged.select(
            "event_type", "day", "close", "pre_close",
            S.one_day_return(stated, F.col("close"), F.col("pre_close")).alias("return_1d"),
        )
    )


_BAR_SQL = """
select event_type as code, cast({period} as date) as d, '{freq}' as freq, min(cast(value as decimal(18,2))) as low,
       max(cast(value as decimal(18,2))) as high, sum(cast(value as decimal(18,2))) as amount, max(event_id) as run
from events group by all
"""


@query(
    "bars_adjusted",
    f"""
    with bars as (
        {_BAR_SQL.format(period="ts", freq="daily")} union all
        {_BAR_SQL.format(period="date_trunc('week', ts)", freq="weekly")} union all
        {_BAR_SQL.format(period="date_trunc('month', ts)", freq="monthly")}
    ), factor as (
        select event_type as code, cast(ts as date) as d, count(*) as n, max(event_id) as run from events
        where event_type in ('view', 'click') group by all
    )
    select bars.code, cast(bars.d as varchar) as trade_date, bars.freq, cast(low as varchar) as low, cast(high as varchar) as high,
           cast(amount as varchar) as amount, cast(factor.n as varchar) as adj_factor,
           cast(bars.run as varchar) as bar_run, cast(factor.run as varchar) as factor_run
    from bars left join factor using (code, d)
    """,
)
def bars_adjusted(spark, sf):
    events = table(spark, sf, "events").withColumn("value", money("value"))

    def bars(period) -> DataFrame:
        return events.groupBy(F.col("event_type").alias("ts_code"), period.cast("date").alias("trade_date")).agg(
            F.min("value").alias("low"), F.max("value").alias("high"), F.sum("value").alias("amount"),
            F.max("event_id").cast("string").alias("source_run_id"), F.max("ts").alias("raw_loaded_at"),
        )

    factor = (
        events.where(F.col("event_type").isin("view", "click"))
        .groupBy(F.col("event_type").alias("ts_code"), day("ts").alias("trade_date"))
        .agg(F.count("*").cast("string").alias("adj_factor"), F.max("event_id").cast("string").alias("source_run_id"), F.max("ts").alias("raw_loaded_at"))
    )
    joined = I.price_bars_adjusted(
        {
            "daily": bars(F.col("ts")),
            "weekly": bars(F.date_trunc("week", "ts")),
            "monthly": bars(F.date_trunc("month", "ts")),
            "adj_factor": factor,
        }
    )
    return portable(
        joined.select(
            F.col("ts_code").alias("code"), "trade_date", "freq", "low", "high", "amount", "adj_factor",
            F.col("price_bar_source_run_id").alias("bar_run"), F.col("adj_factor_source_run_id").alias("factor_run"),
        )
    )


@query(
    "security_master",
    """
    with latest as (
        select * from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1
    )
    select c_custkey, c_name, n_name, o_orderkey, cast(cast(o_orderdate as date) as varchar) as last_order
    from customer left join nation on c_nationkey = n_nationkey left join latest on c_custkey = o_custkey
    """,
)
def security_master(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    latest = latest_per_key(orders, ["o_custkey"], newest_first("o_orderdate", "o_orderkey"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    wide = customers.join(nations, customers["c_nationkey"] == nations["n_nationkey"], "left").join(
        latest, customers["c_custkey"] == latest["o_custkey"], "left"
    )
    return portable(wide.select("c_custkey", "c_name", "n_name", "o_orderkey", day("o_orderdate").alias("last_order")))


@query(
    "spine_join",
    """
    with a as (select l_orderkey as k, sum(cast(l_quantity as bigint)) as qty from lineitem group by 1),
         b as (select l_orderkey as k, max(l_shipdate) as last_ship from lineitem where l_returnflag = 'R' group by 1),
         c as (select o_orderkey as k, cast(o_totalprice as decimal(18,2)) as price from orders where o_orderstatus <> 'P'),
         s as (select k from a union select k from b union select k from c)
    select k as orderkey, cast(qty as bigint) as qty, cast(cast(last_ship as date) as varchar) as last_ship,
           cast(price as varchar) as price, coalesce('a' || a.k, 'b' || b.k, 'c' || c.k) as source
    from s left join a using (k) left join b using (k) left join c using (k)
    """,
)
def spine_join_query(spark, sf):
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    key = F.col("l_orderkey").alias("orderkey")
    sources = {
        "a": lines.groupBy(key).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("qty")),
        "b": lines.where(F.col("l_returnflag") == "R").groupBy(key).agg(F.max(day("l_shipdate")).alias("last_ship")),
        "c": orders.where(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").alias("orderkey"), money("o_totalprice").alias("price")),
    }
    tagged = {n: df.withColumn("tag", F.concat(F.lit(n), F.col("orderkey").cast("string"))) for n, df in sources.items()}
    wide = spine_join(tagged, ["orderkey"])
    return portable(
        wide.select(
            "orderkey", F.col("a__qty").alias("qty"), F.col("b__last_ship").alias("last_ship"), F.col("c__price").alias("price"),
            F.coalesce("a__tag", "b__tag", "c__tag").alias("source"),
        )
    )


@query(
    "report_latest",
    """
    with v as (
        select o_custkey as cust, cast(date_trunc('quarter', o_orderdate) as date) as period, o_orderstatus as src,
               o_orderdate as ann, substr(o_orderpriority, 1, 1) as flag, o_orderkey as run, cast(o_totalprice as decimal(18,2)) as price
        from orders
    ), one as (
        select *, case src when 'O' then 1 when 'F' then 2 else 3 end as prio from v
        qualify row_number() over (partition by cust, period, src order by ann desc, flag desc, run desc) = 1
    ), top as (
        select * from one qualify row_number() over (partition by cust, period order by ann desc, flag desc, prio) = 1
    )
    select top.cust, cast(top.period as varchar) as period, cast(cast(top.ann as date) as varchar) as ann_date, top.flag as update_flag,
           cast(o.price as varchar) as o_price, cast(f.price as varchar) as f_price, cast(p.price as varchar) as p_price,
           coalesce(o.run, f.run, p.run) as source_run_id
    from top
    left join one o on o.cust = top.cust and o.period = top.period and o.src = 'O'
    left join one f on f.cust = top.cust and f.period = top.period and f.src = 'F'
    left join one p on p.cust = top.cust and p.period = top.period and p.src = 'P'
    """,
)
def report_latest(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("cust"), F.date_trunc("quarter", "o_orderdate").cast("date").alias("period"),
        "o_orderstatus", day("o_orderdate").alias("ann_date"), F.substring("o_orderpriority", 1, 1).alias("update_flag"),
        F.col("o_orderkey").alias("run"), money("o_totalprice").alias("price"),
    )
    sources = {s: orders.where(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in ("O", "F", "P")}
    wide = I.latest_of_sources(
        sources, ("cust", "period"), ("ann_date", "update_flag", "run"), ("ann_date", "update_flag"), (),
        {s: ["price"] for s in sources},
    )
    return portable(
        wide.select(
            "cust", "period", "ann_date", "update_flag",
            *[F.col(f"{s}__price").alias(f"{s.lower()}_price") for s in sources],
            F.coalesce(*[F.col(f"{s}__run") for s in sources]).alias("source_run_id"),
        )
    )


# --------------------------------------------------------------- interval joins
# A customer's order is valid until the day before its next order day; lines of any of
# the customer's orders are placed by ship date.

_INTERVAL_SQL = """
with d as (select distinct o_custkey as cust, cast(o_orderdate as date) as valid_from from orders),
     v as (select cust, valid_from, lead(valid_from) over (partition by cust order by valid_from) - 1 as valid_to from d),
     l as (select o_custkey as cust, cast(l_shipdate as date) as ship, cast(l_quantity as bigint) as qty
           from lineitem join orders on l_orderkey = o_orderkey)
"""


def _validity(spark, sf) -> DataFrame:
    days = table(spark, sf, "orders").select(F.col("o_custkey").alias("cust"), day("o_orderdate").alias("valid_from")).distinct()
    following = with_next(days, ["cust"], "valid_from", "valid_from", "_next")
    return following.select("cust", "valid_from", F.date_sub("_next", 1).alias("valid_to"))


def _shipped(spark, sf) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", day("l_shipdate").alias("ship"), F.col("l_quantity").cast("bigint").alias("qty"))
    owners = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("cust"))
    return lines.join(owners, lines["l_orderkey"] == owners["o_orderkey"], "inner").select("cust", "ship", "qty")


@query(
    "membership_interval",
    _INTERVAL_SQL + """
    select v.cust, cast(valid_from as varchar) as valid_from, cast(valid_to as varchar) as valid_to,
           count(*) as line_count, cast(sum(qty) as bigint) as qty
    from l join v on l.cust = v.cust and ship >= valid_from and (valid_to is null or ship <= valid_to)
    group by all
    """,
)
def membership_interval(spark, sf):
    pairs = interval_pairs(_shipped(spark, sf), _validity(spark, sf), ["cust"], "ship", "valid_from", "valid_to")
    grouped = pairs.groupBy("cust", "valid_from", "valid_to").agg(F.count("*").alias("line_count"), F.sum("qty").alias("qty"))
    return portable(grouped)


@query(
    "membership_unmatched",
    _INTERVAL_SQL + """
    select l.cust, cast(ship as varchar) as ship, qty from l
    where not exists (select 1 from v where v.cust = l.cust and ship >= valid_from and (valid_to is null or ship <= valid_to))
    """,
)
def membership_unmatched(spark, sf):
    rows = interval_pairs(
        _shipped(spark, sf), _validity(spark, sf), ["cust"], "ship", "valid_from", "valid_to", "left_anti"
    )
    return portable(rows.select("cust", "ship", "qty"))


@query(
    "calendar_join",
    """
    with cal as (
        select cast(o_orderdate as date) as d, upper(n_name) as exch, o_orderkey, o_orderstatus
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
        qualify row_number() over (partition by cast(o_orderdate as date), upper(n_name) order by o_totalprice desc, o_orderkey desc) = 1
    ), ship as (
        select cast(l_shipdate as date) as d, upper(n_name) as exch, count(*) as n
        from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by all
    )
    select cast(ship.d as varchar) as trade_date, ship.exch as exchange, n as line_count, o_orderstatus as is_open, o_orderkey as calendar_run
    from ship left join cal on ship.d = cal.d and ship.exch = cal.exch
    """,
)
def calendar_join(spark, sf):
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    orders = table(spark, sf, "orders")
    calendar = I.deduped_calendar(
        orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
        .join(nations, F.col("c_nationkey") == nations["n_nationkey"])
        .select(
            F.col("n_name").alias("exchange"), day("o_orderdate").alias("cal_date"), F.col("o_orderstatus").alias("is_open"),
            F.col("o_totalprice").alias("raw_loaded_at"), F.col("o_orderkey").alias("source_run_id"),
        )
    )
    # Lines are counted per supplier and day before the small dimensions are joined on.
    counted = table(spark, sf, "lineitem").groupBy("l_suppkey", day("l_shipdate").alias("trade_date")).agg(F.count("*").alias("n"))
    shipped = (
        counted.join(suppliers, counted["l_suppkey"] == suppliers["s_suppkey"])
        .join(nations, F.col("s_nationkey") == nations["n_nationkey"])
        .groupBy("trade_date", F.upper("n_name").alias("exchange_name"))
        .agg(F.sum("n").alias("line_count"))
    )
    on = (shipped["trade_date"] == calendar["cal_date"]) & (shipped["exchange_name"] == calendar["calendar_exchange"])
    return portable(
        shipped.join(calendar, on, "left").select(
            "trade_date", F.col("exchange_name").alias("exchange"), "line_count", "is_open",
            F.col("source_run_id").alias("calendar_run"),
        )
    )


# --------------------------------------------------------------- holdings
# Shape of the position mart: customers hold their order value per quarter, suppliers
# are funds holding the parts they shipped per quarter, users hold event types per day.


def _quarter_end(column: str):
    return F.last_day(F.add_months(F.date_trunc("quarter", column).cast("date"), 2))


def order_holdings(spark, sf) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf, "orders").select(
        F.lit("top_holder").alias("holding_source"),
        F.concat(F.lit("h"), F.col("o_custkey").cast("string")).alias("holder_id"),
        F.lit("s1").alias("security_id"),
        _quarter_end("o_orderdate").alias("report_date"), day("o_orderdate").alias("announced_date"),
        money("o_totalprice").cast(S.MEASURE).alias("holding_amount"),
        F.substring("o_orderpriority", 1, 1).cast(S.MEASURE).alias("holding_ratio"),
        F.concat(F.lit("orders_"), "o_orderstatus").alias("source_interface_id"),
        F.concat(F.lit("run-"), F.substring("o_orderpriority", 1, 1)).alias("source_run_id"),
        F.col("o_orderdate").alias("raw_loaded_at"),
    )
    return rows, rows


_HOLD_SQL = """
with h as (
    select 'h' || o_custkey as holder_id, last_day(cast(date_trunc('quarter', o_orderdate) as date) + interval 2 month) as report_date,
           cast(o_orderdate as date) as announced_date, cast(o_totalprice as decimal(18,2)) as amount,
           cast(substr(o_orderpriority, 1, 1) as integer) as ratio,
           'orders_' || o_orderstatus as iface, 'run-' || substr(o_orderpriority, 1, 1) as run, o_orderdate as loaded
    from orders
), one as (
    select * from h qualify row_number() over (partition by holder_id, report_date order by announced_date desc, amount desc, ratio desc) = 1
), c as (
    select *, lag(report_date) over w as p_date, lag(announced_date) over w as p_ann, lag(amount) over w as p_amount, lag(ratio) over w as p_ratio
    from one window w as (partition by holder_id order by report_date)
), k as (
    select md5(concat_ws('|', 'top_holder', holder_id, 's1', cast(report_date as varchar), cast(announced_date as varchar))) as mart_key, * from c
)
"""


@query(
    "qoq_change",
    _HOLD_SQL + """
    select mart_key, holder_id, cast(report_date as varchar) as report_date, cast(announced_date as varchar) as announced_date,
           cast(p_date as varchar) as previous_report_date, cast(p_ann as varchar) as previous_announced_date,
           cast(cast(amount - p_amount as decimal(38,18)) as varchar) as holding_amount_delta,
           round(case when coalesce(p_amount, 0) <> 0 then cast(amount - p_amount as double) / cast(p_amount as double) end, 6) as holding_amount_delta_pct,
           cast(cast(ratio - p_ratio as decimal(38,18)) as varchar) as holding_ratio_delta
    from k
    """,
)
def qoq_change(spark, sf):
    positions, _ = order_holdings(spark, sf)
    changes = D.top_holder_qoq_change(positions)
    return portable(
        changes.select(
            "mart_key", "holder_id", "report_date", "announced_date", "previous_report_date", "previous_announced_date",
            "holding_amount_delta", "holding_amount_delta_pct", "holding_ratio_delta",
        )
    )


@query(
    "qoq_lineage",
    _HOLD_SQL + """
    , legs as (
        select mart_key, holder_id, report_date as at, announced_date as ann from k
        union all select mart_key, holder_id, p_date, p_ann from k where p_date is not null
    )
    select mart_key, cast(min(h.report_date) as varchar) as source_window_start_date, cast(max(h.report_date) as varchar) as source_window_end_date,
           string_agg(distinct iface, ',' order by iface) as source_interface_ids, string_agg(distinct run, ',' order by run) as source_run_ids,
           count(*) as source_row_count, 'source_rows=' || count(*) || ';lineage_rows=' || count(*) as source_lineage_summary,
           strftime(min(loaded), '%Y-%m-%d %H:%M:%S.%f') as raw_loaded_at_min, strftime(max(loaded), '%Y-%m-%d %H:%M:%S.%f') as raw_loaded_at_max,
           'top_holder_qoq_change:' || mart_key as snapshot_id
    from legs join h on h.holder_id = legs.holder_id and h.report_date = legs.at and h.announced_date = legs.ann
    group by mart_key
    """,
)
def qoq_lineage(spark, sf):
    positions, lineage = order_holdings(spark, sf)
    rows = D.qoq_lineage(D.top_holder_qoq_change(positions), lineage)
    return portable(
        rows.select(
            "mart_key", "source_window_start_date", "source_window_end_date", "source_interface_ids", "source_run_ids",
            "source_row_count", "source_lineage_summary", "raw_loaded_at_min", "raw_loaded_at_max", "snapshot_id",
        )
    )


def fund_holdings(spark, sf) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf, "lineitem").select(
        F.lit("fund_portfolio").alias("holding_source"),
        F.col("l_suppkey").alias("holder_id"), F.col("l_partkey").alias("security_id"),
        _quarter_end("l_shipdate").alias("report_date"), day("l_shipdate").alias("announced_date"),
        F.concat(F.lit("lines_"), "l_linestatus").alias("source_interface_id"),
        F.concat(F.lit("run-"), "l_returnflag").alias("source_run_id"),
        F.col("l_shipdate").alias("raw_loaded_at"),
    )
    return rows, rows


_FUND_SQL = """
with h as (
    select l_suppkey as holder_id, l_partkey as security_id, last_day(cast(date_trunc('quarter', l_shipdate) as date) + interval 2 month) as report_date,
           cast(l_shipdate as date) as ann, 'lines_' || l_linestatus as iface, 'run-' || l_returnflag as run, l_shipdate as loaded
    from lineitem
), p as (select report_date, holder_id, security_id, max(ann) as ann from h group by all),
pairs as (
    select l.report_date, l.holder_id, l.security_id as a, r.security_id as b, l.ann as l_ann, r.ann as r_ann
    from p l join p r on l.report_date = r.report_date and l.holder_id = r.holder_id and l.security_id < r.security_id
)
"""


@query(
    "co_holding",
    _FUND_SQL + """
    , n as (select report_date, security_id, count(distinct holder_id) as funds from p group by all),
    g as (select report_date, a, b, count(distinct holder_id) as shared, max(greatest(l_ann, r_ann)) as ann from pairs group by all)
    select cast(g.report_date as varchar) as report_date, a as security_id_left, b as security_id_right, shared as co_holding_fund_count,
           na.funds as security_left_fund_count, nb.funds as security_right_fund_count,
           round(shared / nullif(na.funds + nb.funds - shared, 0), 6) as jaccard_score, cast(ann as varchar) as latest_announced_date
    from g join n na on na.report_date = g.report_date and na.security_id = a
           join n nb on nb.report_date = g.report_date and nb.security_id = b
    """,
)
def co_holding(spark, sf):
    positions, _ = fund_holdings(spark, sf)
    return portable(D.fund_co_holding(positions).drop("mart_key", "row_id", "evidence_ref"))


@query(
    "co_holding_lineage",
    _FUND_SQL + """
    , src as (
        select pairs.report_date, a, b, h.* exclude (report_date) from pairs
        join h on h.report_date = pairs.report_date and h.holder_id = pairs.holder_id and h.security_id = a and h.ann = l_ann
        union all
        select pairs.report_date, a, b, h.* exclude (report_date) from pairs
        join h on h.report_date = pairs.report_date and h.holder_id = pairs.holder_id and h.security_id = b and h.ann = r_ann
    )
    select md5(concat_ws('|', cast(report_date as varchar), cast(a as varchar), cast(b as varchar))) as mart_key,
           string_agg(distinct iface, ',' order by iface) as source_interface_ids, string_agg(distinct run, ',' order by run) as source_run_ids,
           count(*) as source_row_count, strftime(min(loaded), '%Y-%m-%d %H:%M:%S.%f') as raw_loaded_at_min,
           strftime(max(loaded), '%Y-%m-%d %H:%M:%S.%f') as raw_loaded_at_max
    from src group by report_date, a, b
    """,
)
def co_holding_lineage(spark, sf):
    positions, lineage = fund_holdings(spark, sf)
    rows = D.co_holding_lineage(positions, lineage)
    return portable(
        rows.select("mart_key", "source_interface_ids", "source_run_ids", "source_row_count", "raw_loaded_at_min", "raw_loaded_at_max")
    )


def north_holdings(spark, sf) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf, "events")
    positions = events.groupBy(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("security_id"),
        F.concat(F.lit("northbound:"), "event_type").alias("holder_id"), day("ts").alias("report_date"),
    ).agg(
        F.lit("northbound_hold").alias("holding_source"),
        F.sum(money("value")).cast(S.MEASURE).alias("holding_amount"), F.count("*").cast(S.MEASURE).alias("holding_ratio"),
    )
    lineage = events.select(
        F.lit("northbound_hold").alias("holding_source"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("security_id"),
        F.concat(F.lit("northbound:"), "event_type").alias("holder_id"), day("ts").alias("report_date"),
        F.col("event_type").alias("source_interface_id"), F.concat(F.lit("run-"), F.dayofmonth("ts").cast("string")).alias("source_run_id"),
        F.col("ts").alias("raw_loaded_at"),
    )
    return positions, lineage


_Z_SQL = """
with p as (
    select 'u' || user_id as security_id, 'northbound:' || event_type as holder_id, cast(ts as date) as report_date,
           sum(cast(value as decimal(18,2))) as holding_amount, count(*) as holding_ratio from events group by all
), m as (
    select security_id, holder_id, report_date, 'holding_amount' as metric, cast(holding_amount as double) as v from p
    union all select security_id, holder_id, report_date, 'holding_ratio', cast(holding_ratio as double) from p
), w as (
    select *, min(report_date) over f as start_date, count(v) over f as n, avg(v) over f as mean, stddev_samp(v) over f as sd
    from m window f as (partition by security_id, holder_id, metric order by report_date rows between 7 preceding and current row)
), z as (
    select md5(concat_ws('|', security_id, holder_id, cast(report_date as varchar), metric)) as mart_key, *, (v - mean) / sd as score
    from w where sd <> 0
)
"""


@query(
    "zscore",
    _Z_SQL + """
    select mart_key, security_id, holder_id, cast(report_date as varchar) as report_date, metric as z_score_metric, 8 as lookback_observations,
           cast(start_date as varchar) as window_start_date, cast(report_date as varchar) as window_end_date, n as observation_count,
           round(mean, 6) as metric_mean, round(sd, 6) as metric_stddev, round(score, 6) as metric_z_score
    from z
    """,
)
def zscore(spark, sf):
    positions, _ = north_holdings(spark, sf)
    scores = D.northbound_holding_z_score(positions)
    return portable(scores.drop("row_id", "evidence_ref", "metric_value"))


@query(
    "zscore_lineage",
    _Z_SQL + """
    , src as (select 'u' || user_id as s, 'northbound:' || event_type as h, cast(ts as date) as d, event_type, 'run-' || day(ts) as run, ts from events)
    select mart_key, z_score_metric, cast(min(d) as varchar) as source_window_start_date, cast(max(d) as varchar) as source_window_end_date,
           string_agg(distinct event_type, ',' order by event_type) as source_interface_ids, string_agg(distinct run, ',' order by run) as source_run_ids,
           count(*) as source_row_count, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as raw_loaded_at_min,
           strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as raw_loaded_at_max
    from (select mart_key, metric as z_score_metric, security_id, holder_id, start_date, report_date from z) z
    join src on s = security_id and h = holder_id and d between start_date and report_date
    group by all
    """,
)
def zscore_lineage(spark, sf):
    positions, lineage = north_holdings(spark, sf)
    rows = D.z_score_lineage(D.northbound_holding_z_score(positions), lineage)
    return portable(
        rows.select(
            "mart_key", "z_score_metric", "source_window_start_date", "source_window_end_date", "source_interface_ids",
            "source_run_ids", "source_row_count", "raw_loaded_at_min", "raw_loaded_at_max",
        )
    )


@query(
    "holding_position",
    """
    with u as (
        select 'top_holder' as src, c_name as holder_id, 's' || c_nationkey as sec, c_acctbal as amount from customer
        union all select 'top_float_holder', s_name, 's' || s_nationkey, s_acctbal from supplier
        union all select 'fund_portfolio', 'f' || l_suppkey, 'p' || l_partkey, null from lineitem
    )
    select md5(concat_ws('|', src, holder_id, sec)) as position_id, src as holding_source, count(*) as row_count,
           cast(sum(cast(amount as decimal(18,2))) as varchar) as amount
    from u group by all
    """,
)
def holding_position(spark, sf):
    def side(df: DataFrame, source: str, holder, security, amount=None) -> DataFrame:
        columns = [F.lit(source).alias("holding_source"), holder.alias("holder_id"), security.alias("security_id")]
        return df.select(*columns, *([amount.alias("amount")] if amount is not None else []))

    def label(prefix: str, key: str):
        return F.concat(F.lit(prefix), F.col(key).cast("string"))

    rows = union_by_name(
        [
            side(table(spark, sf, "customer"), "top_holder", F.col("c_name"), label("s", "c_nationkey"), money("c_acctbal")),
            side(table(spark, sf, "supplier"), "top_float_holder", F.col("s_name"), label("s", "s_nationkey"), money("s_acctbal")),
            side(table(spark, sf, "lineitem"), "fund_portfolio", label("f", "l_suppkey"), label("p", "l_partkey")),
        ],
        allow_missing=True,
    )
    key = S.row_hash(F.col("holding_source"), F.col("holder_id"), F.col("security_id")).alias("position_id")
    grouped = rows.groupBy("holding_source", key).agg(
        F.count("*").alias("row_count"), F.sum("amount").cast("decimal(38,2)").alias("amount")
    )
    return portable(grouped)


@query(
    "dim_rollup",
    """
    select l_partkey as index_id, max(p_name) as index_name, cast(min(cast(l_shipdate as date)) as varchar) as first_effective_date,
           cast(max(cast(l_shipdate as date)) as varchar) as latest_effective_date
    from lineitem left join part on l_partkey = p_partkey group by 1
    """,
)
def dim_rollup(spark, sf):
    spans = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("index_id")).agg(
        F.min(day("l_shipdate")).alias("first_effective_date"), F.max(day("l_shipdate")).alias("latest_effective_date")
    )
    names = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("index_name"))
    return portable(spans.join(names, spans["index_id"] == names["p_partkey"], "left").drop("p_partkey"))


@query(
    "lineage_composite",
    """
    with l as (select l_orderkey as k, max(l_shipdate) as ts from lineitem where l_returnflag = 'R' group by 1)
    select o_orderkey, concat_ws('+', 'orders', case when l.k is not null then 'lineitem' end,
                                 case when o_orderstatus = 'O' then 'open' end) as source_interface_id,
           concat_ws('|', 'orders=' || o_custkey, 'lineitem=' || l.k, case when o_orderstatus = 'O' then 'open=' || o_orderkey end) as source_run_id,
           strftime(greatest(o_orderdate, coalesce(l.ts, timestamp '1970-01-01')), '%Y-%m-%d %H:%M:%S.%f') as raw_loaded_at
    from orders left join l on l.k = o_orderkey
    """,
)
def lineage_composite(spark, sf):
    lines = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    shipped = lines.groupBy(F.col("l_orderkey").alias("_k")).agg(F.max("l_shipdate").alias("_ts"))
    orders = table(spark, sf, "orders")
    joined = orders.join(shipped, orders["o_orderkey"] == shipped["_k"], "left")
    runs = {
        "orders": F.col("o_custkey").cast("string"),
        "lineitem": F.col("_k").cast("string"),
        "open": F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey").cast("string")),
    }
    return portable(
        joined.select(
            "o_orderkey", S.present_labels(runs).alias("source_interface_id"), S.present_runs(runs).alias("source_run_id"),
            S.latest_of([F.col("o_orderdate"), F.col("_ts")], S.epoch_ntz()).alias("raw_loaded_at"),
        )
    )


# --------------------------------------------------------------- ordered picks, manifests


@query(
    "topk_recent",
    """
    select o_orderkey, o_custkey, cast(cast(o_orderdate as date) as varchar) as day from orders
    where o_orderstatus = 'O' order by o_orderdate desc, o_orderkey desc limit 25
    """,
)
def topk_recent(spark, sf):
    open_orders = table(spark, sf, "orders").where(F.col("o_orderstatus") == "O")
    top = top_rows(open_orders, newest_first("o_orderdate", "o_orderkey"), 25)
    return portable(top.select("o_orderkey", "o_custkey", day("o_orderdate").alias("day")))


@query(
    "reconcile",
    """
    with l as (select o_orderkey as k, cast(o_totalprice as decimal(18,2)) as price, 1 as rows from orders where o_orderstatus <> 'F'),
         r as (select l_orderkey as k, sum(cast(l_extendedprice as decimal(18,2))) as price, count(*) as rows from lineitem group by 1)
    select case when l.k is null then 'missing_left' when r.k is null then 'missing_right' else 'both' end as coverage,
           count(*) as key_count,
           count(*) filter (where l.rows <> r.rows) as row_count_diff,
           count(*) filter (where l.price <> r.price) as price_diff
    from l full outer join r on l.k = r.k group by 1
    """,
)
def reconcile(spark, sf):
    left = table(spark, sf, "orders").where(F.col("o_orderstatus") != "F").select(F.col("o_orderkey").alias("k"), money("o_totalprice").alias("price"))
    right = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), money("l_extendedprice").alias("price"))
    return Q.reconcile_summary(Q.reconcile(left, right, ["k"], ["price"]))


# --------------------------------------------------------------- data quality


@query(
    "key_parity",
    """
    select o_custkey as k, 'left' as only_in from orders where o_custkey not in (select user_id from events)
    union select user_id, 'right' from events where user_id not in (select o_custkey from orders)
    """,
)
def key_parity(spark, sf):
    left = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    right = table(spark, sf, "events").select(F.col("user_id").alias("k"))
    return Q.key_parity(left, right, ["k"])


@query(
    "pairing_report",
    """
    with l as (select o_custkey as k, count(*) as n from orders group by 1), r as (select user_id as k, count(*) as n from events group by 1)
    select cast(sum(l.n) as bigint) as left_rows, cast(sum(r.n) as bigint) as right_rows, cast(0 as bigint) as null_key_rows,
           count(*) filter (where l.n > 1) as left_duplicate_keys, count(*) filter (where r.n > 1) as right_duplicate_keys,
           count(*) filter (where l.k is not null and r.k is null) as missing_in_right,
           count(*) filter (where l.k is null) as extra_in_right,
           round(count(*) filter (where l.k is not null and r.k is not null) / count(l.k), 6) as coverage
    from l full outer join r on l.k = r.k
    """,
)
def pairing_report(spark, sf):
    left = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    right = table(spark, sf, "events").select(F.col("user_id").alias("k"))
    return portable(Q.pairing_report(left, right, ["k"]))


@query(
    "dq_unique",
    "select l_orderkey, l_partkey, count(*) as row_count from lineitem group by 1, 2 having count(*) > 1",
)
def dq_unique(spark, sf):
    return Q.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"])


@query(
    "dq_not_null",
    """
    select 'quality' as column_name, count(*) filter (where quality is null) as null_count from documents left join labels using (doc_id)
    union all select 'toxic', count(*) filter (where toxic is null) from documents left join labels using (doc_id)
    union all select 'lang', count(*) filter (where lang is null) from documents
    """,
)
def dq_not_null(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang")
    labels = table(spark, sf, "labels")
    return Q.null_counts(documents.join(labels, "doc_id", "left"), ["quality", "toxic", "lang"])


@query(
    "dq_null_rows",
    """
    select doc_id, concat_ws(',', case when quality is null then 'quality' end, case when toxic is null then 'toxic' end) as null_columns
    from documents left join labels using (doc_id) where quality is null or toxic is null
    """,
)
def dq_null_rows(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return Q.nulls(joined, ["quality", "toxic"]).select("doc_id", "null_columns")


@query(
    "dq_accepted",
    "select o_orderpriority, count(*) as row_count from orders where o_orderpriority not in ('1-URGENT', '2-HIGH') group by 1",
)
def dq_accepted(spark, sf):
    return Q.outside_values(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query(
    "dq_relationships",
    "select o_custkey, count(*) as row_count from orders where o_custkey not in (select user_id from events) group by 1",
)
def dq_relationships(spark, sf):
    return Q.orphans(table(spark, sf, "orders"), "o_custkey", table(spark, sf, "events"), "user_id")


@query(
    "dq_format",
    """
    select o_orderkey, case when o_orderstatus = 'P' then strftime(o_orderdate, '%Y%m') else strftime(o_orderdate, '%Y%m%d') || 'x' end as date_text,
           'date_text' as bad_columns
    from orders where o_orderstatus in ('P', 'F')
    """,
)
def dq_format(spark, sf):
    text = (
        F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyyMMdd"))
        .when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyyMM"))
        .otherwise(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("x")))
    )
    typed = table(spark, sf, "orders").select("o_orderkey", text.alias("date_text"))
    return Q.bad_event_dates(Q.unparsable_dates(typed, "date_text"), ["date_text"])


@query(
    "dq_flag_group",
    """
    select o_custkey, cast(year(o_orderdate) as integer) as y, count(*) as row_count from orders where o_orderstatus = 'O'
    group by all having count(*) > 1
    """,
)
def dq_flag_group(spark, sf):
    flagged = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), (F.col("o_orderstatus") == "O").alias("flag"))
    return Q.several_true(flagged, ["o_custkey", "y"], "flag")


@query(
    "dq_latest_ties",
    """
    with a as (select 'orders' as source_id, o_orderstatus as dataset, o_custkey as partition_date, cast(o_orderdate as date) as t from orders),
         m as (select *, max(t) over (partition by dataset, partition_date) as top from a)
    select source_id, dataset, partition_date, cast(t as varchar) as raw_loaded_at, count(*) as latest_artifact_count
    from m where t = top group by all having count(*) > 1
    """,
)
def dq_latest_ties(spark, sf):
    artifacts = table(spark, sf, "orders").select(
        F.lit("orders").alias("source_id"), F.col("o_orderstatus").alias("dataset"), F.col("o_custkey").alias("partition_date"),
        day("o_orderdate").alias("raw_loaded_at"),
    )
    return portable(Q.latest_artifact_ties(artifacts))


@query(
    "dq_identity",
    """
    with t as (
        select c_custkey, case c_custkey % 5 when 0 then null when 1 then '  ' when 2 then lpad(cast(c_custkey as varchar), 6, '0') || '.HK'
                          else lpad(cast(c_custkey as varchar), 6, '0') || '.SZ' end as code,
               case c_nationkey when 3 then '20240230' when 4 then '2024-01-01' else '20240131' end as day_text
        from customer
    ), v as (
        select *, concat_ws(',', case when code is null then 'code:null' when trim(code) = '' then 'code:blank' when code like '%.HK' then 'code:malformed' end,
                            case when day_text <> '20240131' then 'day_text:malformed' end) as violations from t
    )
    select c_custkey, violations from v where violations <> ''
    """,
)
def dq_identity(spark, sf):
    key, digits = F.col("c_custkey"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")
    code = (
        F.when(key % 5 == 0, F.lit(None).cast("string")).when(key % 5 == 1, F.lit("  "))
        .when(key % 5 == 2, F.concat(digits, F.lit(".HK"))).otherwise(F.concat(digits, F.lit(".SZ")))
    )
    dated = F.when(F.col("c_nationkey") == 3, "20240230").when(F.col("c_nationkey") == 4, "2024-01-01").otherwise("20240131")
    typed = table(spark, sf, "customer").select("c_custkey", code.alias("code"), dated.alias("day_text"))
    return Q.identity_violations(typed, ["code", "day_text"], ["code"], ["day_text"]).select("c_custkey", "violations")


@query(
    "dq_partition_date",
    """
    select o_orderkey, strftime(o_orderdate, '%Y%m%d') as day_text from orders
    where strftime(o_orderdate, '%Y%m%d') <> strftime(last_day(cast(o_orderdate as date)), '%Y%m%d')
    """,
)
def dq_partition_date(spark, sf):
    typed = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("day_text"), F.last_day("o_orderdate").alias("part"))
    return Q.wrong_partition_rows(typed, "day_text", F.date_format("part", "yyyyMMdd")).drop("part")


@query(
    "dq_measures",
    """
    select o_orderkey, 'price' as bad_columns from orders where o_orderstatus = 'P'
    """,
)
def dq_measures(spark, sf):
    price = F.when(F.col("o_orderstatus") == "P", "n/a").when(F.col("o_orderstatus") == "F", "  ").otherwise(money("o_totalprice").cast("string"))
    typed = table(spark, sf, "orders").select("o_orderkey", price.alias("price"))
    return Q.bad_measures(typed, ["price"]).select("o_orderkey", "bad_columns")
