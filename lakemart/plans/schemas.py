"""Declared columns, kinds and keys of raw datasets and marts."""

from __future__ import annotations

from pyspark.sql import types as T

MEASURE = T.DecimalType(38, 18)

# ---------------------------------------------------------------------------
# Raw dataset -> columns, in the provider's names.  Column kinds follow
# from the names: every column ending in "date" is YYYYMMDD text, the figures of the
# four statement datasets are decimals, everything else is text.
# ---------------------------------------------------------------------------
BAR_FIGURES = "open high low close pre_close change pct_chg vol amount"
STATEMENT_HEAD = "ts_code ann_date f_ann_date end_date report_type comp_type update_flag"
HOLDER_COLUMNS = (
    "ts_code ann_date end_date holder_name hold_amount hold_ratio hold_float_ratio "
    "hold_change holder_type"
)
STATEMENT_FIGURES = {
    "balancesheet": """
        money_cap accounts_receiv inventories total_cur_assets fix_assets total_assets
        total_cur_liab total_liab total_hldr_eqy_exc_min_int total_hldr_eqy_inc_min_int
        total_liab_hldr_eqy
    """,
    "cashflow": """
        net_profit c_fr_sale_sg c_inf_fr_operate_a c_paid_goods_s st_cash_out_act
        n_cashflow_act n_cashflow_inv_act n_cash_flows_fnc_act n_incr_cash_cash_equ
        c_cash_equ_beg_period c_cash_equ_end_period free_cashflow
    """,
    "fina_indicator": """
        eps dt_eps total_revenue_ps revenue_ps ocfps bps grossprofit_margin
        netprofit_margin roe roe_waa roa debt_to_assets or_yoy netprofit_yoy
    """,
    "income": """
        basic_eps diluted_eps total_revenue revenue operate_profit total_profit
        income_tax n_income n_income_attr_p minority_gain ebit ebitda
    """,
}
OTHER_DATASETS = {
    "adj_factor": """
        ts_code trade_date adj_factor
    """,
    "anns": """
        ts_code ann_date name title url rec_time
    """,
    "block_trade": """
        ts_code trade_date price vol amount buyer seller
    """,
    "daily_basic": """
        ts_code trade_date close turnover_rate turnover_rate_f volume_ratio pe pe_ttm pb
        ps ps_ttm dv_ratio dv_ttm total_share float_share free_share total_mv circ_mv
    """,
    "disclosure_date": """
        ts_code ann_date end_date pre_date actual_date modify_date
    """,
    "dividend": """
        ts_code end_date ann_date record_date ex_date pay_date div_listdate imp_ann_date
        base_date div_proc stk_div stk_bo_rate stk_co_rate cash_div cash_div_tax
        base_share
    """,
    "forecast": """
        ts_code ann_date end_date first_ann_date type p_change_min p_change_max
        net_profit_min net_profit_max last_parent_net summary change_reason update_flag
    """,
    "fund_portfolio": """
        ts_code ann_date end_date symbol mkv amount stk_mkv_ratio stk_float_ratio
    """,
    "hm_detail": """
        ts_code trade_date ts_name buy_amount sell_amount net_amount hm_name hm_orgs
    """,
    "hsgt_hold_top10": """
        code trade_date ts_code name vol ratio exchange
    """,
    "hsgt_top10": """
        ts_code trade_date name close change rank market_type amount net_amount buy sell
    """,
    "index_basic": """
        ts_code base_date list_date exp_date name fullname market publisher index_type
        category base_point weight_rule desc
    """,
    "index_classify": """
        index_code industry_name level industry_code is_pub parent_code src
    """,
    "index_member": """
        index_code in_date out_date index_name con_code con_name is_new
    """,
    "index_weight": """
        index_code trade_date con_code weight
    """,
    "limit_list_d": """
        ts_code trade_date industry name close pct_chg amount limit_amount float_mv
        total_mv turnover_ratio fd_amount first_time last_time open_times up_stat
        limit_times limit
    """,
    "limit_list_ths": """
        ts_code trade_date name price pct_chg open_num lu_desc limit_type tag status
        limit_order limit_amount turnover_rate free_float lu_limit_order
        limit_up_suc_rate turnover market_type
    """,
    "namechange": """
        ts_code start_date end_date ann_date name change_reason
    """,
    "pledge_detail": """
        ts_code ann_date start_date end_date release_date holder_name pledge_amount
        is_release pledgor holding_amount pledged_amount p_total_ratio h_total_ratio
        is_buyback
    """,
    "pledge_stat": """
        ts_code end_date pledge_count unrest_pledge rest_pledge total_share pledge_ratio
    """,
    "repurchase": """
        ts_code ann_date end_date exp_date proc vol amount high_limit low_limit
    """,
    "share_float": """
        ts_code ann_date float_date float_share float_ratio holder_name share_type
    """,
    "stk_holdernumber": """
        ts_code ann_date end_date holder_num
    """,
    "stk_holdertrade": """
        ts_code ann_date holder_name holder_type in_de change_vol change_ratio
        after_share after_ratio avg_price total_share
    """,
    "stk_limit": """
        ts_code trade_date up_limit down_limit
    """,
    "stk_surv": """
        ts_code surv_date name fund_visitors rece_place rece_mode rece_org org_type
        comp_rece
    """,
    "stock_basic": """
        ts_code list_date delist_date symbol name area industry fullname enname cnspell
        market exchange curr_type list_status is_hs act_name act_ent_type
    """,
    "stock_company": """
        ts_code setup_date exchange chairman manager secretary reg_capital province city
        introduction website email office employees main_business business_scope
    """,
    "suspend_d": """
        ts_code trade_date suspend_timing suspend_type
    """,
    "trade_cal": """
        exchange cal_date pretrade_date is_open
    """,
}
STATIC_DATASETS = ("index_basic", "index_classify", "stock_basic", "stock_company")
REQUEST_SCOPED_DATASETS = ("top10_holders", "top10_floatholders")
# ---------------------------------------------------------------------------


# Columns of the order flow.
MONEYFLOW_COLUMNS = (
    "ts_code trade_date buy_sm_vol buy_sm_amount sell_sm_vol sell_sm_amount buy_md_vol buy_md_amount "
    "sell_md_vol sell_md_amount buy_lg_vol buy_lg_amount sell_lg_vol sell_lg_amount buy_elg_vol "
    "buy_elg_amount sell_elg_vol sell_elg_amount net_mf_vol net_mf_amount"
)


def _datasets() -> dict[str, list[str]]:
    found = {name: columns.split() for name, columns in OTHER_DATASETS.items()}
    for name, figures in STATEMENT_FIGURES.items():
        found[name] = STATEMENT_HEAD.split() + figures.split()
    for name in ("daily", "weekly", "monthly", "index_daily"):
        found[name] = ["ts_code", "trade_date", *BAR_FIGURES.split()]
    for name in REQUEST_SCOPED_DATASETS:
        found[name] = HOLDER_COLUMNS.split()
    found["moneyflow"] = MONEYFLOW_COLUMNS.split()
    return dict(sorted(found.items()))


RAW_COLUMNS = _datasets()


def column_kind(dataset: str, column: str) -> str:
    """``date``, ``measure`` or ``text``."""
    if column.endswith("date"):
        return "date"
    if dataset in STATEMENT_FIGURES and column not in STATEMENT_HEAD.split():
        return "measure"
    return "text"


def raw_schema(dataset: str) -> T.StructType:
    """All text, except the statement figures, which land as decimals."""
    return T.StructType(
        [
            T.StructField(c, MEASURE if column_kind(dataset, c) == "measure" else T.StringType())
            for c in RAW_COLUMNS[dataset]
        ]
    )


def selection_mode(dataset: str) -> tuple[bool, bool]:
    """(is partitioned by date, is request-scoped) of a dataset's latest-artifact rule."""
    return dataset not in STATIC_DATASETS, dataset in REQUEST_SCOPED_DATASETS


MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("manifest_version", T.IntegerType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("partition_date", T.StringType()),
        T.StructField(
            "artifacts",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("source_id", T.StringType()),
                        T.StructField("dataset", T.StringType()),
                        T.StructField("partition_date", T.StringType()),
                        T.StructField("run_id", T.StringType()),
                        T.StructField("path", T.StringType()),
                        T.StructField("row_count", T.LongType()),
                        T.StructField("written_at", T.StringType()),
                        T.StructField("request_params_hash", T.StringType()),
                        T.StructField("schema_hash", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

# Mart -> canonical key.
MART_KEYS = {
    "dim_security": "security_id",
    "stock_basic": "security_id",
    "dim_index": "index_id",
    "fact_price_bar": "security_id trade_date freq",
    "fact_financial_indicator": "security_id end_date report_type",
    "fact_market_daily_feature": "security_id trade_date",
    "fact_index_price_bar": "index_id trade_date",
    "fact_forecast_event": "security_id announcement_date report_period update_flag forecast_type",
    "fact_event": "event_type entity_id event_date event_key",
    "fact_holding_position": "holding_source holder_id security_id report_date announced_date",
    "fact_northbound_turnover": "security_id trade_date market_type rank",
}


def mart_key(mart: str) -> list[str]:
    return MART_KEYS[mart].split()


# Published columns of each mart, in order.  Their types follow from the
# names: see ``mart_type``.
MART_COLUMNS = {
    "dim_security": """
        security_id symbol display_name market industry list_date is_active area fullname exchange
        curr_type list_status delist_date setup_date province city reg_capital employees main_business
        latest_namechange_name latest_namechange_start_date latest_namechange_end_date
        latest_namechange_ann_date latest_namechange_reason
    """,
    "stock_basic": "security_id symbol display_name area industry market list_date is_active",
    "dim_index": "index_id index_name index_market index_category first_effective_date latest_effective_date",
    "fact_price_bar": f"security_id trade_date freq {BAR_FIGURES} adj_factor",
    "fact_financial_indicator": """
        security_id end_date ann_date f_ann_date report_type comp_type update_flag is_latest basic_eps
        diluted_eps total_revenue revenue operate_profit total_profit n_income n_income_attr_p money_cap
        total_cur_assets total_assets total_cur_liab total_liab total_hldr_eqy_exc_min_int
        total_liab_hldr_eqy net_profit n_cashflow_act n_cashflow_inv_act n_cash_flows_fnc_act
        n_incr_cash_cash_equ free_cashflow eps dt_eps grossprofit_margin netprofit_margin roe roa
        debt_to_assets or_yoy netprofit_yoy
    """,
    "fact_market_daily_feature": """
        security_id trade_date close turnover_rate turnover_rate_f volume_ratio pe pe_ttm pb ps ps_ttm
        dv_ratio dv_ttm total_share float_share free_share total_mv circ_mv up_limit down_limit
    """ + MONEYFLOW_COLUMNS.removeprefix("ts_code trade_date"),
    "fact_index_price_bar": f"index_id trade_date {BAR_FIGURES} exchange is_open pretrade_date",
    "fact_forecast_event": """
        security_id announcement_date report_period forecast_type p_change_min p_change_max net_profit_min
        net_profit_max last_parent_net first_ann_date summary change_reason update_flag
    """,
    "fact_event": """
        event_type entity_id event_date event_key title summary event_subtype related_date reference_url
        rec_time
    """,
    "fact_holding_position": """
        holding_source holder_id holder_name holder_type security_id report_date announced_date
        holding_amount holding_ratio holding_float_ratio holding_change market_value exchange
    """,
    "fact_northbound_turnover": """
        security_id trade_date security_name market_type rank close change amount net_amount buy_amount
        sell_amount
    """,
}
# Text columns of the marts, and what is neither text nor a figure.
MART_TEXT = """
    security_id symbol display_name market industry area fullname exchange curr_type list_status province
    city main_business latest_namechange_name latest_namechange_reason index_id index_name index_market
    index_category freq report_type comp_type update_flag forecast_type summary change_reason event_type
    entity_id event_key title event_subtype reference_url rec_time holding_source holder_id holder_name
    holder_type security_name market_type
""".split()
LINEAGE_COLUMNS = {
    "source_provider": T.StringType(),
    "source_interface_id": T.StringType(),
    "source_run_id": T.StringType(),
    "raw_loaded_at": T.TimestampNTZType(),
}


def mart_type(column: str) -> T.DataType:
    """Dates end in ``date`` (a report period is one too), flags start with ``is_``, a rank is whole, other figures are decimals."""
    if column.endswith("date") or column == "report_period":
        return T.DateType()
    if column.startswith("is_"):
        return T.BooleanType()
    if column == "rank":
        return T.IntegerType()
    return T.StringType() if column in MART_TEXT else MEASURE


def mart_schema(mart: str) -> T.StructType:
    """Declared columns of a mart, all nullable, without the load time every published table gets."""
    return T.StructType([T.StructField(c, mart_type(c)) for c in MART_COLUMNS[mart].split()])


def lineage_schema(mart: str) -> T.StructType:
    """Declared columns of a mart's lineage: its key and where the row comes from."""
    keys = [T.StructField(c, mart_type(c)) for c in mart_key(mart)]
    return T.StructType(keys + [T.StructField(c, t) for c, t in LINEAGE_COLUMNS.items()])
