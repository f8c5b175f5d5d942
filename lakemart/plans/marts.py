"""Provider-neutral marts and their lineage siblings.

A mart and its lineage are two projections of one intermediate table, so their keys
cannot drift apart; cache the intermediate when both are written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import scalar as S
from lakemart.plans import intermediate as I
from lakemart.plans import schemas

# Fixed value: provider named in every lineage row.
PROVIDER = "tushare"

Pair = tuple[DataFrame, DataFrame]
HOLDING_MART = "mart_fact_holding_position_v2"


def _figures(columns, how: Callable[[str], Column] = S.strict_measure) -> list[Column]:
    return [how(c).alias(c) for c in columns]


def _lineage(interface: Column, run: Column, loaded: Column) -> list[Column]:
    return [
        F.lit(PROVIDER).alias("source_provider"),
        interface.alias("source_interface_id"),
        run.alias("source_run_id"),
        loaded.alias("raw_loaded_at"),
    ]


def _single_source(interface: str) -> list[Column]:
    return _lineage(F.lit(interface), F.col("source_run_id"), F.col("raw_loaded_at"))


def _components(names: tuple[str, ...]) -> list[Column]:
    """Lineage of a row assembled from several sources, any of which may be absent."""
    runs = {n: F.col(f"{n}_source_run_id") for n in names}
    loads = [F.col(f"{n}_raw_loaded_at") for n in names]
    return _lineage(S.present_labels(runs), S.present_runs(runs), S.latest_of(loads, S.epoch_ntz()))


def _master_lineage() -> list[Column]:
    names = ("stock_basic", "stock_company", "namechange")
    runs = {n: F.col(f"{n}_source_run_id") for n in names}
    always = F.lit("stock_basic")
    extra = S.present_labels({n: runs[n] for n in names[1:]})
    interface = F.concat_ws("+", always, F.nullif(extra, F.lit("")))
    first = F.col("stock_basic_raw_loaded_at")
    return _lineage(
        interface, S.present_runs(runs), S.latest_of([F.col(f"{n}_raw_loaded_at") for n in names], first)
    )


def dim_security(master: DataFrame) -> Pair:
    plain = (
        "market industry list_date is_active area fullname exchange curr_type list_status "
        "delist_date setup_date province city"
    ).split()
    mart = master.select(
        F.col("ts_code").alias("security_id"),
        "symbol",
        F.col("name").alias("display_name"),
        *plain,
        *_figures(["reg_capital", "employees"]),
        "main_business",
        *[f"latest_namechange_{c}" for c in ("name", "start_date", "end_date", "ann_date", "reason")],
    )
    return mart, master.select(F.col("ts_code").alias("security_id"), *_master_lineage())


def stock_basic(master: DataFrame) -> Pair:
    mart = master.select(
        F.col("ts_code").alias("security_id"),
        "symbol",
        F.col("name").alias("display_name"),
        *"area industry market list_date is_active".split(),
    )
    return mart, master.select(F.col("ts_code").alias("security_id"), *_master_lineage())


INDEX_SOURCES = ("index_basic", "index_member", "index_weight")


def dim_index(membership: DataFrame) -> Pair:
    known = membership.where(F.col("index_code").isNotNull()).groupBy(F.col("index_code").alias("index_id"))
    mart = known.agg(
        *[F.max(c).alias(c) for c in ("index_name", "index_market", "index_category")],
        F.min("effective_date").alias("first_effective_date"),
        F.max("effective_date").alias("latest_effective_date"),
    )
    folded = known.agg(
        *[F.max(f"{n}_{field}").alias(f"{n}_{field}") for n in INDEX_SOURCES for field in I.LINEAGE]
    )
    return mart, folded.select("index_id", *_components(INDEX_SOURCES))


def fact_price_bar(bars: DataFrame) -> Pair:
    key = [F.col("ts_code").alias("security_id"), F.col("trade_date"), F.col("freq")]
    mart = bars.select(*key, *_figures([*schemas.BAR_FIGURES.split(), "adj_factor"]))
    source = F.col("price_source_interface_id")
    factor = {"adj_factor": F.col("adj_factor_source_run_id")}
    bar_load = F.col("price_bar_raw_loaded_at")
    lineage = bars.select(
        *key,
        *_lineage(
            F.concat_ws("+", source, F.nullif(S.present_labels(factor), F.lit(""))),
            F.concat_ws(
                "|",
                S.glue(source, F.lit("="), F.col("price_bar_source_run_id")),
                F.nullif(S.present_runs(factor), F.lit("")),
            ),
            S.latest_of([bar_load, F.col("adj_factor_raw_loaded_at")], bar_load),
        ),
    )
    return mart, lineage


def fact_index_price_bar(bars: DataFrame) -> Pair:
    key = [F.col("index_code").alias("index_id"), F.col("trade_date")]
    mart = bars.select(
        *key,
        *_figures(schemas.BAR_FIGURES.split()),
        "exchange",
        S.tri_state("is_open").alias("is_open"),
        "pretrade_date",
    )
    return mart, bars.select(*key, *_single_source("index_daily"))


def fact_market_daily_feature(features: DataFrame) -> Pair:
    key = [F.col("ts_code").alias("security_id"), F.col("trade_date")]
    figures = [
        c
        for n in I.FEATURE_SOURCES
        for c in schemas.RAW_COLUMNS[n]
        if c not in ("ts_code", "trade_date")
    ]
    return features.select(*key, *_figures(figures)), features.select(*key, *_components(I.FEATURE_SOURCES))


def fact_financial_indicator(reports: DataFrame) -> Pair:
    latest = reports.where(F.col("is_latest"))
    code = F.col("ts_code").alias("security_id")
    figures = [c for names in I.REPORT_FIGURES.values() for c in names.split()]
    mart = latest.select(
        code,
        *"end_date ann_date f_ann_date report_type comp_type update_flag is_latest".split(),
        *[F.col(c).cast(S.MEASURE).alias(c) for c in figures],
    )
    order = ("fina_indicator", "income", "balancesheet", "cashflow")
    return mart, latest.select(code, "end_date", "report_type", *_components(order))


def fact_forecast_event(forecasts: DataFrame) -> Pair:
    key = [
        F.col("ts_code").alias("security_id"),
        F.col("ann_date").alias("announcement_date"),
        F.col("end_date").alias("report_period"),
        F.col("forecast_type"),
        F.col("update_flag"),
    ]
    mart = forecasts.select(
        *key,
        *_figures("p_change_min p_change_max net_profit_min net_profit_max last_parent_net".split()),
        *"first_ann_date summary change_reason".split(),
    )
    return mart, forecasts.select(*key, *_single_source("forecast"))


def event_key() -> Column:
    texts = ["title", "summary", "event_subtype", "related_date", "reference_url", "rec_time"]
    return S.row_hash(
        F.col("source_interface_id"),
        F.col("event_type"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in texts],
    )


def fact_event(timeline: DataFrame) -> Pair:
    key = [
        F.col("event_type"),
        F.col("ts_code").alias("entity_id"),
        F.col("event_date"),
        event_key().alias("event_key"),
    ]
    mart = timeline.select(*key, *"title summary event_subtype related_date reference_url rec_time".split())
    lineage = timeline.select(
        *key, *_lineage(F.col("source_interface_id"), F.col("source_run_id"), F.col("raw_loaded_at"))
    )
    return mart, lineage


def holding_positions(stg: Mapping[str, DataFrame]) -> DataFrame:
    """Four holding sources in one shape, lineage columns included."""

    def shape(dataset: str, source: str, **columns: Column) -> DataFrame:
        def pick(name: str, to: str) -> Column:
            return columns.get(name, F.lit(None)).cast(to).alias(name)

        return stg[dataset].select(
            F.lit(source).alias("holding_source"),
            *[pick(c, "string") for c in ("holder_id", "holder_name", "holder_type", "security_id")],
            *[pick(c, "date") for c in ("report_date", "announced_date")],
            *[
                S.lenient_measure(columns[c]).alias(c) if c in columns else pick(c, S.MEASURE)
                for c in ("holding_amount", "holding_ratio", "holding_float_ratio", "holding_change", "market_value")
            ],
            pick("exchange", "string"),
            F.lit(dataset).alias("source_interface_id"),
            *I.LINEAGE,
        )

    def issuer(dataset: str, source: str) -> DataFrame:
        c = F.col
        return shape(
            dataset, source,
            holder_id=c("holder_name"), holder_name=c("holder_name"), holder_type=c("holder_type"),
            security_id=c("ts_code"), report_date=c("end_date"), announced_date=c("ann_date"),
            holding_amount=c("hold_amount"), holding_ratio=c("hold_ratio"),
            holding_float_ratio=c("hold_float_ratio"), holding_change=c("hold_change"),
        )

    c = F.col
    fund = shape(
        "fund_portfolio", "fund_portfolio",
        holder_id=c("ts_code"), holder_name=c("ts_code"), holder_type=F.lit("fund"), security_id=c("symbol"),
        report_date=c("end_date"), announced_date=c("ann_date"), holding_amount=c("amount"),
        holding_ratio=c("stk_float_ratio"), holding_float_ratio=c("stk_float_ratio"), market_value=c("mkv"),
    )
    north = shape(
        "hsgt_hold_top10", "northbound_hold",
        holder_id=S.glue(F.lit("northbound:"), c("exchange")),
        holder_name=S.glue(F.lit("Northbound "), c("exchange")),
        holder_type=F.lit("northbound"), security_id=c("ts_code"), report_date=c("trade_date"),
        announced_date=c("trade_date"), holding_amount=c("vol"), holding_ratio=c("ratio"),
        holding_float_ratio=c("ratio"), exchange=c("exchange"),
    )
    return (
        issuer("top10_holders", "top_holder")
        .unionByName(issuer("top10_floatholders", "top_float_holder"))
        .unionByName(fund)
        .unionByName(north)
    )


HOLDING_KEY = ("holding_source", "holder_id", "security_id", "report_date", "announced_date")


def fact_holding_position(positions: DataFrame) -> Pair:
    mart = positions.select(
        S.row_hash(*[F.col(k) for k in HOLDING_KEY]).alias("position_id"),
        "holding_source",
        *"holder_id holder_name holder_type security_id report_date announced_date".split(),
        *"holding_amount holding_ratio holding_float_ratio holding_change market_value exchange".split(),
        F.lit("holding_position").alias("dataset"),
        S.glue(F.lit("holding_position:"), F.col("report_date").cast("string")).alias("snapshot_id"),
        F.col("announced_date").alias("as_of_date"),
    )
    lineage = positions.select(
        *HOLDING_KEY, *_lineage(F.col("source_interface_id"), F.col("source_run_id"), F.col("raw_loaded_at"))
    )
    return mart, lineage


def fact_northbound_turnover(turnover: DataFrame) -> Pair:
    key = [
        F.col("ts_code").alias("security_id"),
        F.col("trade_date"),
        F.col("market_type"),
        S.lenient_int("rank").alias("rank"),
    ]
    figures = {"close": "close", "change": "change", "amount": "amount", "net_amount": "net_amount", "buy": "buy_amount", "sell": "sell_amount"}
    mart = turnover.select(
        *key,
        F.col("name").alias("security_name"),
        *[S.lenient_measure(c).alias(name) for c, name in figures.items()],
    )
    return mart, turnover.select(*key, *_single_source("hsgt_top10"))


# mart -> (intermediate builder, projection into the pair)
MARTS: dict[str, tuple[Callable[[Mapping[str, DataFrame]], DataFrame], Callable[[DataFrame], Pair]]] = {
    "dim_security": (I.security_master, dim_security),
    "stock_basic": (I.security_master, stock_basic),
    "dim_index": (I.index_membership, dim_index),
    "fact_price_bar": (I.price_bars_adjusted, fact_price_bar),
    "fact_index_price_bar": (I.index_price_bars, fact_index_price_bar),
    "fact_market_daily_feature": (I.market_daily_features, fact_market_daily_feature),
    "fact_financial_indicator": (I.financial_reports_latest, fact_financial_indicator),
    "fact_forecast_event": (I.forecast_events, fact_forecast_event),
    "fact_event": (I.event_timeline, fact_event),
    "fact_holding_position": (holding_positions, fact_holding_position),
    "fact_northbound_turnover": (lambda stg: stg["hsgt_top10"], fact_northbound_turnover),
}


def mart_pair(name: str, stg: Mapping[str, DataFrame]) -> Pair:
    build, project = MARTS[name]
    return project(build(stg))


def all_pairs(stg: Mapping[str, DataFrame]) -> dict[str, Pair]:
    """Every mart with its lineage; marts over the same intermediate share one plan."""
    built: dict[Callable, DataFrame] = {}
    pairs = {}
    for name, (build, project) in MARTS.items():
        if build not in built:
            built[build] = build(stg)
        pairs[name] = project(built[build])
    return pairs
