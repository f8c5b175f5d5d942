"""Every staging table, intermediate, mart, lineage and derivation over the derived feeds.

All values are compared as text, doubles at six decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.checks.market_feeds import StagedFeeds, staging_ctes
from lakemart.checks.registry import query
from lakemart.plans import derivations as D
from lakemart.plans import intermediate as I
from lakemart.plans import marts as M
from lakemart.plans import schemas
from lakemart.session import materialize


def as_text(df: DataFrame) -> DataFrame:
    def text(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = column.cast("decimal(28,6)")
        return column.cast("string").alias(field.name)

    return df.select(*[text(f) for f in df.schema.fields])


def _sql(datasets: str, body: str, *ctes: str) -> str:
    chain = ",\n".join([staging_ctes(*datasets.split()), *[c for c in ctes if c]])
    return f"with {chain}\nselect cast(columns(*) as varchar) from (\n{body}\n) final"


# --------------------------------------------------------------- staging


def _register_staging(dataset: str) -> None:
    @query(f"stg_{dataset}", _sql(dataset, f"select * from stg_{dataset}"))
    def staged(spark, sf):
        return as_text(StagedFeeds(spark, sf)[dataset])


for _dataset in schemas.RAW_COLUMNS:
    _register_staging(_dataset)


# --------------------------------------------------------------- intermediates, in the checking engine's SQL

_FEATURES = "daily_basic stk_limit moneyflow"
_STATEMENTS = {
    "income": "basic_eps diluted_eps total_revenue revenue operate_profit total_profit n_income n_income_attr_p",
    "balancesheet": "money_cap total_cur_assets total_assets total_cur_liab total_liab total_hldr_eqy_exc_min_int total_liab_hldr_eqy",
    "cashflow": "net_profit n_cashflow_act n_cashflow_inv_act n_cash_flows_fnc_act n_incr_cash_cash_equ free_cashflow",
    "fina_indicator": "eps dt_eps grossprofit_margin netprofit_margin roe roa debt_to_assets or_yoy netprofit_yoy",
}


def _parts(names, alias=str) -> str:
    """Coalesced and per-component lineage columns of several joined sources."""
    names = list(names)
    out = []
    for field in ("source_run_id", "raw_loaded_at"):
        out.append(f"coalesce({', '.join(f'{alias(n)}.{field}' for n in names)}) as {field}")
        out += [f"{alias(n)}.{field} as {n}_{field}" for n in names]
    return ", ".join(out)


_BARS = """
int_price_bars as (
    select b.*, adj_factor, b.source_run_id as price_bar_source_run_id, b.raw_loaded_at as price_bar_raw_loaded_at,
           f.source_run_id as adj_factor_source_run_id, f.raw_loaded_at as adj_factor_raw_loaded_at
    from (select *, 'daily' as freq, 'daily' as price_source_interface_id from stg_daily
          union all by name select *, 'weekly' as freq, 'weekly' as price_source_interface_id from stg_weekly
          union all by name select *, 'monthly' as freq, 'monthly' as price_source_interface_id from stg_monthly) b
    left join stg_adj_factor f using (ts_code, trade_date)
)"""

_INDEX_BARS = """
int_index_bars as (
    select i.* exclude (ts_code, source_run_id, raw_loaded_at), i.ts_code as index_code, c.exchange, c.is_open, c.pretrade_date,
           coalesce(i.source_run_id, c.source_run_id) as source_run_id, coalesce(i.raw_loaded_at, c.raw_loaded_at) as raw_loaded_at
    from stg_index_daily i
    left join (select * from stg_trade_cal where exchange is not null
               qualify row_number() over (partition by cal_date, upper(exchange) order by raw_loaded_at desc, source_run_id desc) = 1) c
      on c.cal_date = i.trade_date
     and upper(c.exchange) = case right(upper(i.ts_code), 3) when '.SH' then 'SSE' when '.SZ' then 'SZSE' when '.BJ' then 'BSE' end
)"""

_DAILY_FEATURES = f"""
int_features as (
    select k.*, {", ".join(f"{n}.{c}" for n in _FEATURES.split() for c in schemas.RAW_COLUMNS[n][2:])}, {_parts(_FEATURES.split())}
    from ({" union ".join(f"select ts_code, trade_date from stg_{n}" for n in _FEATURES.split())}) k
    {" ".join(f"left join stg_{n} {n} using (ts_code, trade_date)" for n in _FEATURES.split())}
)"""


def _best(name: str, figures: str) -> str:
    order = ["ann_date", "f_ann_date", "update_flag", "raw_loaded_at", "source_run_id", "comp_type", *figures.split()]
    ranked = ", ".join(f"{c} desc nulls last" for c in order)
    return f"""best_{name} as (
    select * from stg_{name} qualify row_number() over (partition by ts_code, end_date, report_type order by {ranked}) = 1
)"""


_REPORTS = (
    ",\n".join(_best(n, f) for n, f in _STATEMENTS.items())
    + ",\nheads as ("
    + " union all ".join(
        f"select ts_code, end_date, report_type, ann_date, f_ann_date, update_flag, comp_type, {i} as prio from best_{n}"
        for i, n in enumerate(_STATEMENTS)
    )
    + f"""),
head as (
    select * exclude (prio) from heads qualify row_number() over (partition by ts_code, end_date, report_type
        order by ann_date desc nulls last, f_ann_date desc nulls last, update_flag desc nulls last, prio) = 1
),
int_reports as (
    select head.*, true as is_latest, {", ".join(f"{n}.{c}" for n, f in _STATEMENTS.items() for c in f.split())}, {_parts(_STATEMENTS)}
    from head {" ".join(f"left join best_{n} {n} using (ts_code, end_date, report_type)" for n in _STATEMENTS)}
)"""
)

_MASTER = f"""
renamed as (
    select * from stg_namechange qualify row_number() over (partition by ts_code
        order by coalesce(end_date, start_date, ann_date) desc nulls last, raw_loaded_at desc, source_run_id desc) = 1
),
int_master as (
    select {", ".join("b." + c for c in "ts_code symbol name market industry list_date is_active area fullname exchange curr_type list_status delist_date source_run_id raw_loaded_at".split())},
           setup_date, province, city, reg_capital, employees, main_business, r.name as latest_namechange_name,
           r.start_date as latest_namechange_start_date, r.end_date as latest_namechange_end_date,
           r.ann_date as latest_namechange_ann_date, r.change_reason as latest_namechange_reason,
           b.source_run_id as stock_basic_source_run_id, c.source_run_id as stock_company_source_run_id, r.source_run_id as namechange_source_run_id,
           b.raw_loaded_at as stock_basic_raw_loaded_at, c.raw_loaded_at as stock_company_raw_loaded_at, r.raw_loaded_at as namechange_raw_loaded_at
    from stg_stock_basic b left join stg_stock_company c on c.ts_code = b.ts_code left join renamed r on r.ts_code = b.ts_code
)"""

_INSIDE = "m.index_code = w.index_code and m.con_code = w.con_code and w.trade_date >= m.in_date and (m.out_date is null or w.trade_date <= m.out_date)"
_MEMBERSHIP = f"""
placed as (
    select m.index_code, m.con_code, w.trade_date, coalesce(w.trade_date, m.in_date) as effective_date, m.in_date as valid_from, m.out_date as valid_to,
           w.weight, m.index_name, m.con_name, m.is_new, m.source_run_id as m_run, w.source_run_id as w_run, m.raw_loaded_at as m_at, w.raw_loaded_at as w_at
    from stg_index_member m left join stg_index_weight w on {_INSIDE}
    union all
    select w.index_code, w.con_code, w.trade_date, w.trade_date, null, null, w.weight, null, null, null, null, w.source_run_id, null, w.raw_loaded_at
    from stg_index_weight w where not exists (select 1 from stg_index_member m where {_INSIDE})
),
int_membership as (
    select p.* exclude (m_run, w_run, m_at, w_at, index_name), coalesce(p.index_name, b.name) as index_name, b.market as index_market, b.category as index_category,
           coalesce(w_run, m_run) as source_run_id, coalesce(w_at, m_at) as raw_loaded_at, b.source_run_id as index_basic_source_run_id,
           m_run as index_member_source_run_id, w_run as index_weight_source_run_id, b.raw_loaded_at as index_basic_raw_loaded_at,
           m_at as index_member_raw_loaded_at, w_at as index_weight_raw_loaded_at
    from placed p left join stg_index_basic b on b.ts_code = p.index_code
)"""


def _event(kind, source, at, title, summary, sub="null", related="null", url="null", rec="null") -> str:
    return (
        f"select '{kind}' as event_type, '{source}' as source_interface_id, ts_code, {at} as event_date, {title} as title, {summary} as summary, "
        f"{sub} as event_subtype, cast({related} as date) as related_date, {url} as reference_url, {rec} as rec_time, source_run_id, raw_loaded_at from stg_{source}"
    )


def _kv(*items: str) -> str:
    """DuckDB's concat skips NULLs, so label=value pieces can simply be concatenated."""
    return "concat(" + ", ".join(items) + ")"


_EVENTS = "int_events as (\n" + "\nunion all ".join(
    [
        _event("announcement", "anns", "ann_date", "title", "name", url="url", rec="rec_time"),
        _event("suspend", "suspend_d", "trade_date", "'Trading suspension'", "suspend_timing", "suspend_type", "trade_date"),
        _event("dividend", "dividend", "ann_date", "'Dividend'", _kv("'cash_div='", "cash_div", "';stk_div='", "stk_div"), "div_proc", "end_date"),
        _event("share_float", "share_float", "float_date", "'Share float'", "holder_name", "share_type", "ann_date"),
        _event("holder_number", "stk_holdernumber", "ann_date", "'Holder number'", "holder_num", related="end_date"),
        _event("disclosure_date", "disclosure_date", "coalesce(actual_date, pre_date, ann_date, modify_date)", "'Disclosure date'",
               _kv("'pre_date='", "pre_date", "';actual_date='", "actual_date"), related="end_date"),
        _event("name_change", "namechange", "start_date", "'Name change'", "name", "change_reason", "ann_date"),
        _event("block_trade", "block_trade", "trade_date", "'Block trade'",
               _kv("'buyer='", "buyer", "';seller='", "seller", "';price='", "price", "';vol='", "vol", "';amount='", "amount"), related="trade_date"),
        _event("pledge_summary", "pledge_stat", "end_date", "'Pledge summary'",
               _kv("'count='", "pledge_count", "';unrest='", "unrest_pledge", "';rest='", "rest_pledge", "';total='", "total_share", "';ratio='", "pledge_ratio")),
        _event("pledge_event", "pledge_detail", "ann_date", "'Pledge event'",
               _kv("'holder='", "holder_name", "';pledgor='", "pledgor", "';amount='", "pledge_amount", "';period=['", "start_date", "','", "end_date", "'];release='", "is_release"),
               "is_release", "end_date"),
        _event("share_repurchase", "repurchase", "ann_date", "'Share repurchase'",
               _kv("'proc='", "proc", "';vol='", "vol", "';amount='", "amount", "';exp='", "exp_date", "';band=['", "low_limit", "','", "high_limit", "']'"), "proc", "end_date"),
        _event("shareholder_trade", "stk_holdertrade", "ann_date", "'Shareholder trade'",
               _kv("'holder='", "holder_name", "';type='", "holder_type", "';dir='", "in_de", "';vol='", "change_vol", "';ratio='", "change_ratio", "';avg_price='", "avg_price"), "in_de"),
        _event("institutional_survey", "stk_surv", "surv_date", "'Institutional survey'",
               _kv("'org='", "rece_org", "';type='", "org_type", "';place='", "rece_place", "';mode='", "rece_mode", "';visitors='", "fund_visitors"), "org_type"),
        _event("price_limit_status", "limit_list_ths", "trade_date", "'Price limit status (THS pool)'",
               _kv("'pool='", "limit_type", "';status='", "status", "';tag='", "tag", "';order='", "limit_order", "';amount='", "limit_amount", "';open_num='", "open_num"), "limit_type"),
        _event("price_limit_event", "limit_list_d", "trade_date", "'Price limit event'",
               _kv("'limit='", '"limit"', "';times='", "limit_times", "';fd='", "fd_amount", "';first='", "first_time", "';last='", "last_time", "';up_stat='", "up_stat"), '"limit"'),
        _event("hot_money_trade", "hm_detail", "trade_date", "'Hot money trade'",
               _kv("'hm='", "hm_name", "';buy='", "buy_amount", "';sell='", "sell_amount", "';net='", "net_amount", "';orgs='", "hm_orgs")),
    ]
) + ")"
_EVENT_SOURCES = " ".join(rule["source"] for rule in I.EVENT_BRANCHES.values())

_DEC = "decimal(38,18)"
_HOLDING = f"""
holdings as (
    {" union all ".join(f'''select '{src}' as holding_source, holder_name as holder_id, holder_name, holder_type, ts_code as security_id, end_date as report_date,
        ann_date as announced_date, try_cast(hold_amount as {_DEC}) as holding_amount, try_cast(hold_ratio as {_DEC}) as holding_ratio,
        try_cast(hold_float_ratio as {_DEC}) as holding_float_ratio, try_cast(hold_change as {_DEC}) as holding_change, cast(null as {_DEC}) as market_value,
        cast(null as varchar) as exchange, '{ds}' as source_interface_id, source_run_id, raw_loaded_at from stg_{ds}'''
        for src, ds in (("top_holder", "top10_holders"), ("top_float_holder", "top10_floatholders")))}
    union all select 'fund_portfolio', ts_code, ts_code, 'fund', symbol, end_date, ann_date, try_cast(amount as {_DEC}), try_cast(stk_float_ratio as {_DEC}),
        try_cast(stk_float_ratio as {_DEC}), null, try_cast(mkv as {_DEC}), null, 'fund_portfolio', source_run_id, raw_loaded_at from stg_fund_portfolio
    union all select 'northbound_hold', concat('northbound:', exchange), concat('Northbound ', exchange), 'northbound', ts_code, trade_date, trade_date,
        try_cast(vol as {_DEC}), try_cast(ratio as {_DEC}), try_cast(ratio as {_DEC}), null, null, exchange, 'hsgt_hold_top10', source_run_id, raw_loaded_at
    from stg_hsgt_hold_top10
)"""
_HOLDING_SOURCES = "top10_holders top10_floatholders fund_portfolio hsgt_hold_top10"

INTERMEDIATES = {
    "price_bars_adjusted": ("daily weekly monthly adj_factor", _BARS, "int_price_bars", I.price_bars_adjusted),
    "index_price_bars": ("index_daily trade_cal", _INDEX_BARS, "int_index_bars", I.index_price_bars),
    "market_daily_features": (_FEATURES, _DAILY_FEATURES, "int_features", I.market_daily_features),
    "financial_reports_latest": (" ".join(_STATEMENTS), _REPORTS, "int_reports", I.financial_reports_latest),
    "security_master": ("stock_basic stock_company namechange", _MASTER, "int_master", I.security_master),
    "index_membership": ("index_member index_weight index_basic", _MEMBERSHIP, "int_membership", I.index_membership),
    "event_timeline": (_EVENT_SOURCES, _EVENTS, "int_events", I.event_timeline),
    "forecast_events": ("forecast", 'int_forecast as (select * rename ("type" as forecast_type) from stg_forecast)', "int_forecast", I.forecast_events),
}


def _register_intermediate(name, datasets, cte, relation, build) -> None:
    @query(f"int_{name}", _sql(datasets, f"select * from {relation}", cte))
    def intermediate(spark, sf):
        return as_text(build(StagedFeeds(spark, sf)))


for _name, (_datasets, _cte, _relation, _build) in INTERMEDIATES.items():
    _register_intermediate(_name, _datasets, _cte, _relation, _build)


# --------------------------------------------------------------- marts and lineage


def _dec(columns: str) -> str:
    return ", ".join(f"cast({c} as {_DEC}) as {c}" for c in columns.split())


def _composite(names: str, fold: bool = False) -> str:
    """Lineage columns of a row assembled from ``names``."""

    def run(n):
        return f"max({n}_source_run_id)" if fold else f"{n}_source_run_id"

    def at(n):
        return f"max({n}_raw_loaded_at)" if fold else f"{n}_raw_loaded_at"

    names = names.split()
    labels = ", ".join(f"case when {run(n)} is not null then '{n}' end" for n in names)
    runs = ", ".join(f"'{n}=' || {run(n)}" for n in names)
    times = ", ".join(f"coalesce({at(n)}, timestamp '1970-01-01')" for n in names)
    return (
        f"'tushare' as source_provider, concat_ws('+', {labels}) as source_interface_id, "
        f"concat_ws('|', {runs}) as source_run_id, greatest({times}) as raw_loaded_at"
    )


def _single(interface: str) -> str:
    return f"'tushare' as source_provider, {interface} as source_interface_id, source_run_id, raw_loaded_at"


_FEATURE_FIGURES = " ".join(c for n in _FEATURES.split() for c in schemas.RAW_COLUMNS[n][2:])
_EVENT_KEY = (
    "event_type, ts_code as entity_id, event_date, md5(concat_ws('|', source_interface_id, event_type, "
    + ", ".join(f"coalesce(cast({c} as varchar), '')" for c in "title summary event_subtype related_date reference_url rec_time".split())
    + ")) as event_key"
)
_H_KEY = "holding_source, holder_id, security_id, report_date, announced_date"
_POSITION_ID = "md5(concat_ws('|', holding_source, holder_id, security_id, cast(report_date as varchar), cast(announced_date as varchar)))"
_MASTER_LINEAGE = f"select ts_code as security_id, {_composite('stock_basic stock_company namechange')} from int_master"

MART_SQL = {
    "dim_security": (
        "security_master",
        "select ts_code as security_id, symbol, name as display_name, market, industry, list_date, is_active, area, fullname, exchange, curr_type, list_status, "
        f"delist_date, setup_date, province, city, {_dec('reg_capital employees')}, main_business, latest_namechange_name, latest_namechange_start_date, "
        "latest_namechange_end_date, latest_namechange_ann_date, latest_namechange_reason from int_master",
        _MASTER_LINEAGE,
    ),
    "stock_basic": (
        "security_master",
        "select ts_code as security_id, symbol, name as display_name, area, industry, market, list_date, is_active from int_master",
        _MASTER_LINEAGE,
    ),
    "dim_index": (
        "index_membership",
        "select index_code as index_id, max(index_name) as index_name, max(index_market) as index_market, max(index_category) as index_category, "
        "min(effective_date) as first_effective_date, max(effective_date) as latest_effective_date from int_membership group by 1",
        f"select index_code as index_id, {_composite('index_basic index_member index_weight', True)} from int_membership group by 1",
    ),
    "fact_price_bar": (
        "price_bars_adjusted",
        f"select ts_code as security_id, trade_date, freq, {_dec(schemas.BAR_FIGURES + ' adj_factor')} from int_price_bars",
        "select ts_code as security_id, trade_date, freq, 'tushare' as source_provider, "
        "freq || case when adj_factor_source_run_id is null then '' else '+adj_factor' end as source_interface_id, "
        "concat(freq, '=', price_bar_source_run_id, '|adj_factor=' || adj_factor_source_run_id) as source_run_id, "
        "greatest(price_bar_raw_loaded_at, adj_factor_raw_loaded_at) as raw_loaded_at from int_price_bars",
    ),
    "fact_index_price_bar": (
        "index_price_bars",
        f"select index_code as index_id, trade_date, {_dec(schemas.BAR_FIGURES)}, exchange, "
        "case is_open when '1' then true when '0' then false end as is_open, pretrade_date from int_index_bars",
        f"select index_code as index_id, trade_date, {_single(chr(39) + 'index_daily' + chr(39))} from int_index_bars",
    ),
    "fact_market_daily_feature": (
        "market_daily_features",
        f"select ts_code as security_id, trade_date, {_dec(_FEATURE_FIGURES)} from int_features",
        f"select ts_code as security_id, trade_date, {_composite(_FEATURES)} from int_features",
    ),
    "fact_financial_indicator": (
        "financial_reports_latest",
        f"select ts_code as security_id, end_date, ann_date, f_ann_date, report_type, comp_type, update_flag, is_latest, {_dec(' '.join(_STATEMENTS.values()))} from int_reports",
        f"select ts_code as security_id, end_date, report_type, {_composite('fina_indicator income balancesheet cashflow')} from int_reports",
    ),
    "fact_forecast_event": (
        "forecast_events",
        "select ts_code as security_id, ann_date as announcement_date, end_date as report_period, forecast_type, update_flag, "
        f"{_dec('p_change_min p_change_max net_profit_min net_profit_max last_parent_net')}, first_ann_date, summary, change_reason from int_forecast",
        "select ts_code as security_id, ann_date as announcement_date, end_date as report_period, forecast_type, update_flag, "
        f"{_single(chr(39) + 'forecast' + chr(39))} from int_forecast",
    ),
    "fact_event": (
        "event_timeline",
        f"select {_EVENT_KEY}, title, summary, event_subtype, related_date, reference_url, rec_time from int_events",
        f"select {_EVENT_KEY}, {_single('source_interface_id')} from int_events",
    ),
    "fact_holding_position": (
        "holding_positions",
        f"select {_POSITION_ID} as position_id, holding_source, holder_id, holder_name, holder_type, security_id, report_date, announced_date, holding_amount, "
        "holding_ratio, holding_float_ratio, holding_change, market_value, exchange, 'holding_position' as dataset, "
        "concat('holding_position:', cast(report_date as varchar)) as snapshot_id, announced_date as as_of_date from holdings",
        f"select {_H_KEY}, {_single('source_interface_id')} from holdings",
    ),
    "fact_northbound_turnover": (
        "turnover",
        "select ts_code as security_id, trade_date, market_type, try_cast(rank as integer) as rank, name as security_name, "
        + ", ".join(f"try_cast({c} as {_DEC}) as {n}" for c, n in dict(close="close", change="change", amount="amount", net_amount="net_amount", buy="buy_amount", sell="sell_amount").items())
        + " from stg_hsgt_top10",
        f"select ts_code as security_id, trade_date, market_type, try_cast(rank as integer) as rank, {_single(chr(39) + 'hsgt_top10' + chr(39))} from stg_hsgt_top10",
    ),
}
_RELATIONS = {
    **{name: (datasets, cte) for name, (datasets, cte, _, _) in INTERMEDIATES.items()},
    "holding_positions": (_HOLDING_SOURCES, _HOLDING),
    "turnover": ("hsgt_top10", ""),
}


def _register_mart(name: str, relation: str, mart_sql: str, lineage_sql: str) -> None:
    datasets, cte = _RELATIONS[relation]

    @query(f"mart_{name}", _sql(datasets, mart_sql, cte))
    def mart(spark, sf):
        return as_text(M.mart_pair(name, StagedFeeds(spark, sf))[0])

    @query(f"lineage_{name}", _sql(datasets, lineage_sql, cte))
    def lineage(spark, sf):
        return as_text(M.mart_pair(name, StagedFeeds(spark, sf))[1])


for _mart, (_relation, _mart_sql, _lineage_sql) in MART_SQL.items():
    _register_mart(_mart, _relation, _mart_sql, _lineage_sql)


# --------------------------------------------------------------- derivations

_QOQ = """
one as (
    select * from holdings where holding_source in ('top_holder', 'top_float_holder')
    qualify row_number() over (partition by holding_source, holder_id, security_id, report_date order by announced_date desc) = 1
),
qoq as (
    select md5(concat_ws('|', holding_source, holder_id, security_id, cast(report_date as varchar), cast(announced_date as varchar))) as mart_key,
           holding_source, holder_id, security_id, report_date, announced_date, holding_amount, holding_ratio,
           lag(report_date) over w as previous_report_date, lag(announced_date) over w as previous_announced_date,
           lag(holding_amount) over w as previous_holding_amount, lag(holding_ratio) over w as previous_holding_ratio
    from one window w as (partition by holding_source, holder_id, security_id order by report_date)
)"""
_PAIRS = """
pos as (select report_date, holder_id, security_id, max(announced_date) as ann from holdings where holding_source = 'fund_portfolio' group by all),
pairs as (
    select a.report_date, a.security_id as security_id_left, b.security_id as security_id_right, a.holder_id, a.ann as l_ann, b.ann as r_ann
    from pos a join pos b on a.report_date = b.report_date and a.holder_id = b.holder_id and a.security_id < b.security_id
)"""
_SCORES = """
north as (
    select security_id, holder_id, report_date, unnest(['holding_amount', 'holding_ratio']) as z_score_metric, unnest([holding_amount, holding_ratio]) as metric_value
    from holdings where holding_source = 'northbound_hold'
),
framed as (
    select *, 8 as lookback_observations, min(report_date) over f as window_start_date, max(report_date) over f as window_end_date,
           count(metric_value) over f as observation_count, avg(cast(metric_value as double)) over f as metric_mean, stddev_samp(cast(metric_value as double)) over f as metric_stddev
    from north window f as (partition by security_id, holder_id, z_score_metric order by report_date rows between 7 preceding and current row)
),
scores as (
    select md5(concat_ws('|', security_id, holder_id, cast(report_date as varchar), z_score_metric)) as mart_key, *
    from framed where metric_stddev <> 0 and metric_value is not null
)"""


def _folded(keys: str, source_rows: str, dataset: str, as_of: str) -> str:
    return f"""
    select {keys}, '{dataset}' as dataset, concat('{dataset}:', mart_key) as snapshot_id, {as_of} as as_of_date, 'mart_fact_holding_position_v2' as source_mart,
           min(src_date) as source_window_start_date, max(src_date) as source_window_end_date, string_agg(distinct iface, ',' order by iface) as source_interface_ids,
           count(*) as source_row_count, count(*) as source_lineage_row_count, string_agg(distinct run, ',' order by run) as source_run_ids,
           min(loaded) as raw_loaded_at_min, max(loaded) as raw_loaded_at_max, concat('source_rows=', count(*), ';lineage_rows=', count(*)) as source_lineage_summary
    from ({source_rows}) group by all"""


_SRC = "l.report_date as src_date, l.source_interface_id as iface, l.source_run_id as run, l.raw_loaded_at as loaded"
_SIX = "decimal(28,6)"


def _positions(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Holding positions and their lineage, both read from one written table."""
    return M.fact_holding_position(materialize(M.holding_positions(StagedFeeds(spark, sf)), compact=True))


def _planned_positions(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Holding positions and their lineage, planned and not written: for derivations that read either once.

    Writing them takes more disk than the columns and sources a derivation takes from them.
    """
    return M.fact_holding_position(M.holding_positions(StagedFeeds(spark, sf)))


@query(
    "deriv_top_holder_qoq_change",
    _sql(
        _HOLDING_SOURCES,
        f"""select *, cast(holding_amount - previous_holding_amount as {_DEC}) as holding_amount_delta, cast(holding_ratio - previous_holding_ratio as {_DEC}) as holding_ratio_delta,
            cast(case when previous_holding_amount <> 0 then cast(holding_amount - previous_holding_amount as double) / cast(previous_holding_amount as double) end as {_SIX}) as holding_amount_delta_pct
            from qoq""",
        _HOLDING, _QOQ,
    ),
)
def deriv_top_holder_qoq_change(spark, sf):
    return as_text(D.top_holder_qoq_change(_planned_positions(spark, sf)[0]))


@query(
    "deriv_lineage_top_holder_qoq_change",
    _sql(
        _HOLDING_SOURCES,
        _folded(
            f"mart_key, {_H_KEY}",
            " union all ".join(
                f"select q.mart_key, {', '.join('q.' + k.strip() for k in _H_KEY.split(','))}, {_SRC} from qoq q join holdings l on l.holding_source = q.holding_source "
                f"and l.holder_id = q.holder_id and l.security_id = q.security_id and l.report_date = q.{p}report_date and l.announced_date = q.{p}announced_date"
                for p in ("", "previous_")
            ),
            "top_holder_qoq_change", "announced_date",
        ),
        _HOLDING, _QOQ,
    ),
)
def deriv_lineage_top_holder_qoq_change(spark, sf):
    positions, lineage = _planned_positions(spark, sf)
    return as_text(D.qoq_lineage(D.top_holder_qoq_change(positions), lineage))


_PAIR_KEY = "md5(concat_ws('|', cast(g.report_date as varchar), security_id_left, security_id_right))"


@query(
    "deriv_fund_co_holding",
    _sql(
        _HOLDING_SOURCES,
        f"""select {_PAIR_KEY} as mart_key, {_PAIR_KEY} as row_id, g.report_date, security_id_left, security_id_right, shared as co_holding_fund_count,
            a.n as security_left_fund_count, b.n as security_right_fund_count, cast(shared / nullif(a.n + b.n - shared, 0) as {_SIX}) as jaccard_score,
            ann as latest_announced_date, concat('mart_deriv_fund_co_holding:', {_PAIR_KEY}) as evidence_ref
            from (select report_date, security_id_left, security_id_right, count(distinct holder_id) as shared, max(greatest(l_ann, r_ann)) as ann from pairs group by all) g
            join (select report_date, security_id, count(distinct holder_id) as n from pos group by all) a on a.report_date = g.report_date and a.security_id = security_id_left
            join (select report_date, security_id, count(distinct holder_id) as n from pos group by all) b on b.report_date = g.report_date and b.security_id = security_id_right""",
        _HOLDING, _PAIRS,
    ),
)
def deriv_fund_co_holding(spark, sf):
    return as_text(D.fund_co_holding(_positions(spark, sf)[0]))


@query(
    "deriv_lineage_fund_co_holding",
    _sql(
        _HOLDING_SOURCES,
        _folded(
            "mart_key, report_date, security_id_left, security_id_right",
            " union all ".join(
                f"""select {_PAIR_KEY} as mart_key, g.report_date, security_id_left, security_id_right, max(greatest(l_ann, r_ann)) over (partition by g.report_date, security_id_left, security_id_right) as ann,
                    {_SRC} from pairs g join holdings l on l.holding_source = 'fund_portfolio' and l.report_date = g.report_date and l.holder_id = g.holder_id
                    and l.security_id = security_id_{side} and l.announced_date = {side[0]}_ann"""
                for side in ("left", "right")
            ),
            "fund_co_holding", "max(ann)",
        ),
        _HOLDING, _PAIRS,
    ),
)
def deriv_lineage_fund_co_holding(spark, sf):
    return as_text(D.co_holding_lineage(*_positions(spark, sf)))


@query(
    "deriv_northbound_holding_z_score",
    _sql(
        _HOLDING_SOURCES,
        f"""select * exclude (metric_mean, metric_stddev), mart_key as row_id, cast(metric_mean as {_SIX}) as metric_mean, cast(metric_stddev as {_SIX}) as metric_stddev,
            cast((cast(metric_value as double) - metric_mean) / metric_stddev as {_SIX}) as metric_z_score,
            concat('mart_deriv_northbound_holding_z_score:', mart_key) as evidence_ref from scores""",
        _HOLDING, _SCORES,
    ),
)
def deriv_northbound_holding_z_score(spark, sf):
    return as_text(D.northbound_holding_z_score(_positions(spark, sf)[0]))


@query(
    "deriv_lineage_northbound_holding_z_score",
    _sql(
        _HOLDING_SOURCES,
        _folded(
            "mart_key, security_id, holder_id, report_date, z_score_metric",
            f"""select z.mart_key, z.security_id, z.holder_id, z.report_date, z.z_score_metric, z.window_end_date, {_SRC} from scores z
                join holdings l on l.holding_source = 'northbound_hold' and l.security_id = z.security_id and l.holder_id = z.holder_id
                and l.report_date between z.window_start_date and z.window_end_date""",
            "northbound_holding_z_score", "max(window_end_date)",
        ),
        _HOLDING, _SCORES,
    ),
)
def deriv_lineage_northbound_holding_z_score(spark, sf):
    positions, lineage = _planned_positions(spark, sf)
    return as_text(D.z_score_lineage(D.northbound_holding_z_score(positions), lineage))
