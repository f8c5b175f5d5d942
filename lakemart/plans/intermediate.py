"""Joined and version-picked tables between staging and the marts.

Every function takes the staging DataFrames it needs and returns one DataFrame that
carries the run id and load time of each contributing component.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import scalar as S
from lakemart.operators.joins import interval_pairs, spine_join, without_matches
from lakemart.operators.ordering import latest_per_key, newest_first
from lakemart.plans import schemas
from lakemart.session import materialize

Staging = Mapping[str, DataFrame]

LINEAGE = ("source_run_id", "raw_loaded_at")


def price_bars_adjusted(stg: Staging) -> DataFrame:
    """Daily, weekly and monthly bars with their frequency, and the adjustment factor of the day."""
    bars = reduce(
        lambda a, b: a.unionByName(b),
        [stg[freq].select("*", F.lit(freq).alias("freq")) for freq in ("daily", "weekly", "monthly")],
    )
    factor = stg["adj_factor"].select(
        F.col("ts_code").alias("_code"),
        F.col("trade_date").alias("_date"),
        "adj_factor",
        F.col("source_run_id").alias("adj_factor_source_run_id"),
        F.col("raw_loaded_at").alias("adj_factor_raw_loaded_at"),
    )
    on = (bars["ts_code"] == factor["_code"]) & (bars["trade_date"] == factor["_date"])
    # Columns that repeat others of the bar are added to the joined rows, so they are not shuffled.
    return bars.join(factor, on, "left").select(
        *bars.columns,
        F.col("freq").alias("price_source_interface_id"),
        F.col("source_run_id").alias("price_bar_source_run_id"),
        F.col("raw_loaded_at").alias("price_bar_raw_loaded_at"),
        "adj_factor",
        "adj_factor_source_run_id",
        "adj_factor_raw_loaded_at",
    )


def deduped_calendar(calendar: DataFrame) -> DataFrame:
    """One row per (day, upper-cased exchange): the newest load."""
    named = calendar.where(F.col("exchange").isNotNull()).withColumn(
        "calendar_exchange", F.upper("exchange")
    )
    return latest_per_key(named, ["cal_date", "calendar_exchange"], newest_first("raw_loaded_at", "source_run_id"))


def index_price_bars(stg: Staging) -> DataFrame:
    """Index bars with the trading calendar of the exchange their code names."""
    bars = stg["index_daily"].withColumn("_exchange", S.exchange_of("ts_code"))
    calendar = deduped_calendar(stg["trade_cal"]).select(
        "exchange",
        "is_open",
        "pretrade_date",
        F.col("cal_date").alias("_cal_date"),
        F.col("calendar_exchange").alias("_cal_exchange"),
        F.col("source_run_id").alias("_cal_run"),
        F.col("raw_loaded_at").alias("_cal_loaded"),
    )
    on = (bars["trade_date"] == calendar["_cal_date"]) & (bars["_exchange"] == calendar["_cal_exchange"])
    joined = bars.join(calendar, on, "left").withColumns(
        {
            "source_run_id": F.coalesce("source_run_id", "_cal_run"),
            "raw_loaded_at": F.coalesce("raw_loaded_at", "_cal_loaded"),
        }
    )
    return joined.withColumnRenamed("ts_code", "index_code").drop(
        "_exchange", "_cal_date", "_cal_exchange", "_cal_run", "_cal_loaded"
    )


FEATURE_SOURCES = ("daily_basic", "stk_limit", "moneyflow")


def market_daily_features(stg: Staging) -> DataFrame:
    """Valuation, price limits and order flow on the union of their (code, day) keys."""
    keys = ["ts_code", "trade_date"]
    sources = {name: stg[name] for name in FEATURE_SOURCES}
    wide = spine_join(sources, keys)
    figures = [
        F.col(f"{name}__{c}").alias(c)
        for name in FEATURE_SOURCES
        for c in schemas.RAW_COLUMNS[name]
        if c not in keys
    ]
    return wide.select(*keys, *figures, *_component_lineage(FEATURE_SOURCES, "__"))


def _component_lineage(names, separator: str) -> list[Column]:
    columns = [
        F.coalesce(*[F.col(f"{n}{separator}{field}") for n in names]).alias(field) for field in LINEAGE
    ]
    return columns + [
        F.col(f"{n}{separator}{field}").alias(f"{n}_{field}") for field in LINEAGE for n in names
    ]


# Figures of each statement that reach the wide report row, in priority
# order of the statements.
REPORT_FIGURES = {
    "income": "basic_eps diluted_eps total_revenue revenue operate_profit total_profit "
    "n_income n_income_attr_p",
    "balancesheet": "money_cap total_cur_assets total_assets total_cur_liab total_liab "
    "total_hldr_eqy_exc_min_int total_liab_hldr_eqy",
    "cashflow": "net_profit n_cashflow_act n_cashflow_inv_act n_cash_flows_fnc_act "
    "n_incr_cash_cash_equ free_cashflow",
    "fina_indicator": "eps dt_eps grossprofit_margin netprofit_margin roe roa "
    "debt_to_assets or_yoy netprofit_yoy",
}
REPORT_KEY = ("ts_code", "end_date", "report_type")
VERSION_ORDER = ("ann_date", "f_ann_date", "update_flag", "raw_loaded_at", "source_run_id")


def latest_of_sources(
    sources: Mapping[str, DataFrame],
    keys: tuple[str, ...],
    version_order: tuple[str, ...],
    shared_order: tuple[str, ...],
    shared: tuple[str, ...],
    payload: Mapping[str, list[str]],
) -> DataFrame:
    """Latest version of each source per key, and of the key over all sources, as one wide row.

    All sources are stacked and reduced by one aggregation: a source's latest row is
    the greatest struct led by ``version_order`` (NULL lowest, so NULLs last), the
    key's is the greatest of the sources' heads with the earlier source winning ties.
    Rows are combined map-side and shuffled once; nothing is joined.  A key with a
    NULL part keeps its row but carries no values, as it would match nothing in a join.

    Output: keys, ``shared_order`` and ``shared`` of the winning source, and
    ``<source>__<column>`` for each source's payload.
    """

    def packed(name: str) -> DataFrame:
        head = F.struct(*version_order, *shared, *payload[name])
        return sources[name].select(*keys, head.alias(name))

    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [packed(n) for n in sources]
    )
    tops = stacked.groupBy(*keys).agg(*[F.max(n).alias(n) for n in sources])
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    tops = tops.withColumns({n: F.when(complete, F.col(n)) for n in sources})
    heads = [
        F.when(
            F.col(n).isNotNull(),
            F.struct(
                *[F.col(f"{n}.{c}").alias(c) for c in shared_order],
                F.lit(-rank).alias("_priority"),
                *[F.col(f"{n}.{c}").alias(c) for c in shared],
            ),
        )
        for rank, n in enumerate(sources)
    ]
    best = tops.withColumn("_best", F.greatest(*heads) if len(heads) > 1 else heads[0])
    return best.select(
        *keys,
        *[F.col(f"_best.{c}").alias(c) for c in (*shared_order, *shared)],
        *[F.col(f"{n}.{c}").alias(f"{n}__{c}") for n in sources for c in dict.fromkeys([*version_order, *payload[n]])],
    )


def financial_reports_latest(stg: Staging) -> DataFrame:
    """One wide row per (code, period, report type): the latest version of four statements."""
    wide = latest_of_sources(
        {n: stg[n] for n in REPORT_FIGURES},
        REPORT_KEY,
        VERSION_ORDER,
        ("ann_date", "f_ann_date", "update_flag"),
        ("comp_type",),
        {n: figures.split() for n, figures in REPORT_FIGURES.items()},
    )
    return wide.select(
        *REPORT_KEY,
        "ann_date",
        "f_ann_date",
        "comp_type",
        "update_flag",
        F.lit(True).alias("is_latest"),
        *[F.col(f"{n}__{c}").alias(c) for n, figures in REPORT_FIGURES.items() for c in figures.split()],
        *_component_lineage(tuple(REPORT_FIGURES), "__"),
    )


def security_master(stg: Staging) -> DataFrame:
    """Listed securities with company facts and the latest name change."""
    basic = stg["stock_basic"].select(
        *"ts_code symbol name market industry list_date is_active area fullname exchange curr_type "
        "list_status delist_date source_run_id raw_loaded_at".split(),
        F.col("source_run_id").alias("stock_basic_source_run_id"),
        F.col("raw_loaded_at").alias("stock_basic_raw_loaded_at"),
    )
    company = stg["stock_company"].select(
        F.col("ts_code").alias("_company"),
        *"setup_date province city reg_capital employees main_business".split(),
        F.col("source_run_id").alias("stock_company_source_run_id"),
        F.col("raw_loaded_at").alias("stock_company_raw_loaded_at"),
    )
    effective = stg["namechange"].withColumn("_effective", F.coalesce("end_date", "start_date", "ann_date"))
    renamed = latest_per_key(
        effective, ["ts_code"], newest_first("_effective", "raw_loaded_at", "source_run_id")
    ).select(
        F.col("ts_code").alias("_renamed"),
        *[F.col(c).alias(f"latest_namechange_{c}") for c in ("name", "start_date", "end_date", "ann_date")],
        F.col("change_reason").alias("latest_namechange_reason"),
        F.col("source_run_id").alias("namechange_source_run_id"),
        F.col("raw_loaded_at").alias("namechange_raw_loaded_at"),
    )
    return (
        basic.join(company, basic["ts_code"] == company["_company"], "left")
        .join(renamed, basic["ts_code"] == renamed["_renamed"], "left")
        .drop("_company", "_renamed")
    )


def index_membership(stg: Staging) -> DataFrame:
    """Index members with the weights inside their validity, unmatched rows of either side kept."""
    keys = ["index_code", "con_code"]
    members = stg["index_member"].select(
        *keys,
        "index_name",
        "con_name",
        F.col("in_date").alias("valid_from"),
        F.col("out_date").alias("valid_to"),
        "is_new",
        F.col("source_run_id").alias("index_member_source_run_id"),
        F.col("raw_loaded_at").alias("index_member_raw_loaded_at"),
    )
    # Read for the matches and again for the members nobody matched: staged and typed once.
    members = materialize(members, compact=True)
    weights = stg["index_weight"].select(
        *keys,
        "trade_date",
        "weight",
        F.col("source_run_id").alias("index_weight_source_run_id"),
        F.col("raw_loaded_at").alias("index_weight_raw_loaded_at"),
    )
    # Matched pairs and unmatched weights in one left join, executed once; then members nobody matched.
    weighted = materialize(interval_pairs(weights, members, keys, "trade_date", "valid_from", "valid_to", "left"), compact=True)
    idle = without_matches(members, weighted.where(F.col("valid_from").isNotNull()), [*keys, "valid_from", "valid_to"])
    combined = weighted.unionByName(idle, allowMissingColumns=True).withColumns(
        {
            "effective_date": F.coalesce("trade_date", "valid_from"),
            "source_run_id": F.coalesce("index_weight_source_run_id", "index_member_source_run_id"),
            "raw_loaded_at": F.coalesce("index_weight_raw_loaded_at", "index_member_raw_loaded_at"),
        }
    )
    basics = stg["index_basic"].select(
        F.col("ts_code").alias("_index"),
        F.col("name").alias("_name"),
        F.col("market").alias("index_market"),
        F.col("category").alias("index_category"),
        F.col("source_run_id").alias("index_basic_source_run_id"),
        F.col("raw_loaded_at").alias("index_basic_raw_loaded_at"),
    )
    return (
        combined.join(basics, combined["index_code"] == basics["_index"], "left")
        .withColumn("index_name", F.coalesce("index_name", "_name"))
        .drop("_index", "_name")
    )


def forecast_events(stg: Staging) -> DataFrame:
    return stg["forecast"].withColumnRenamed("type", "forecast_type")


def _event_branches() -> dict[str, dict]:
    """How each event source maps to the shared event shape.

    A summary is either a column name or (label, column) pieces joined as
    ``label=value`` with ';'; ``start..end`` prints a bracketed pair.
    """
    return {
        "announcement": dict(source="anns", date="ann_date", title="title", summary="name", reference="url", time="rec_time"),
        "suspend": dict(source="suspend_d", date="trade_date", title="=Trading suspension", summary="suspend_timing", subtype="suspend_type", related="trade_date"),
        "dividend": dict(source="dividend", date="ann_date", title="=Dividend", summary="cash_div=cash_div stk_div=stk_div", subtype="div_proc", related="end_date"),
        "share_float": dict(source="share_float", date="float_date", title="=Share float", summary="holder_name", subtype="share_type", related="ann_date"),
        "holder_number": dict(source="stk_holdernumber", date="ann_date", title="=Holder number", summary="holder_num", related="end_date"),
        "disclosure_date": dict(source="disclosure_date", date="actual_date pre_date ann_date modify_date", title="=Disclosure date", summary="pre_date=pre_date actual_date=actual_date", related="end_date"),
        "name_change": dict(source="namechange", date="start_date", title="=Name change", summary="name", subtype="change_reason", related="ann_date"),
        "block_trade": dict(source="block_trade", date="trade_date", title="=Block trade", summary="buyer=buyer seller=seller price=price vol=vol amount=amount", related="trade_date"),
        "pledge_summary": dict(source="pledge_stat", date="end_date", title="=Pledge summary", summary="count=pledge_count unrest=unrest_pledge rest=rest_pledge total=total_share ratio=pledge_ratio"),
        "pledge_event": dict(source="pledge_detail", date="ann_date", title="=Pledge event", summary="holder=holder_name pledgor=pledgor amount=pledge_amount period=start_date..end_date release=is_release", subtype="is_release", related="end_date"),
        "share_repurchase": dict(source="repurchase", date="ann_date", title="=Share repurchase", summary="proc=proc vol=vol amount=amount exp=exp_date band=low_limit..high_limit", subtype="proc", related="end_date"),
        "shareholder_trade": dict(source="stk_holdertrade", date="ann_date", title="=Shareholder trade", summary="holder=holder_name type=holder_type dir=in_de vol=change_vol ratio=change_ratio avg_price=avg_price", subtype="in_de"),
        "institutional_survey": dict(source="stk_surv", date="surv_date", title="=Institutional survey", summary="org=rece_org type=org_type place=rece_place mode=rece_mode visitors=fund_visitors", subtype="org_type"),
        "price_limit_status": dict(source="limit_list_ths", date="trade_date", title="=Price limit status (THS pool)", summary="pool=limit_type status=status tag=tag order=limit_order amount=limit_amount open_num=open_num", subtype="limit_type"),
        "price_limit_event": dict(source="limit_list_d", date="trade_date", title="=Price limit event", summary="limit=limit times=limit_times fd=fd_amount first=first_time last=last_time up_stat=up_stat", subtype="limit"),
        "hot_money_trade": dict(source="hm_detail", date="trade_date", title="=Hot money trade", summary="hm=hm_name buy=buy_amount sell=sell_amount net=net_amount orgs=hm_orgs"),
    }


EVENT_BRANCHES = _event_branches()


def _summary(rule: str) -> Column:
    if "=" not in rule:
        return F.col(rule)
    pieces: list = []
    for i, item in enumerate(rule.split()):
        label, value = item.split("=")
        pieces.append((";" if i else "") + label + "=")
        if ".." in value:
            low, high = value.split("..")
            pieces += ["[", F.col(low), ",", F.col(high), "]"]
        else:
            pieces.append(F.col(value))
    return S.labelled(*pieces)


def event_shape(df: DataFrame, event_type: str, rule: Mapping[str, str]) -> DataFrame:
    """One source in the shared event columns."""

    def optional(name: str, to: str) -> Column:
        return F.col(rule[name]).cast(to) if name in rule else F.lit(None).cast(to)

    title = rule["title"]
    return df.select(
        F.lit(event_type).alias("event_type"),
        F.lit(rule["source"]).alias("source_interface_id"),
        "ts_code",
        F.coalesce(*[F.col(c) for c in rule["date"].split()]).alias("event_date"),
        (F.lit(title[1:]) if title.startswith("=") else F.col(title)).alias("title"),
        _summary(rule["summary"]).alias("summary"),
        optional("subtype", "string").alias("event_subtype"),
        optional("related", "date").alias("related_date"),
        optional("reference", "string").alias("reference_url"),
        optional("time", "string").alias("rec_time"),
        *LINEAGE,
    )


def event_timeline(stg: Staging) -> DataFrame:
    """Sixteen sources as one event table."""
    return reduce(
        lambda a, b: a.union(b),
        [event_shape(stg[rule["source"]], kind, rule) for kind, rule in EVENT_BRANCHES.items()],
    )
