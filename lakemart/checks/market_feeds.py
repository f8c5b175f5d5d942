"""The 41 raw datasets derived from the driver tables, so the market models run on them.

Each feed is one SELECT that Spark and the checking engine both run: driver rows are
grouped to a (code, day) grain, landed twice (the second landing restates the figures;
which one is newer depends on the day) and spelled as the provider would, as text with
stray blanks.  Everything after that point is computed independently by each side.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from lakemart.checks.registry import table
from lakemart.plans import schemas
from lakemart.plans.staging import select_latest, stage

_TABLES = ("lineitem", "orders", "events", "customer", "supplier", "nation")


@dataclass(frozen=True)
class Base:
    """A driver table grouped to (k, k2, d), or taken row by row when ``figure`` is not summed.

    ``dealt`` names columns of the table that all rows of a group share.  Where groups are about as many as rows, combining
    them before they are shuffled gains nothing and spills, so rows are dealt by these columns and grouped once.
    """

    source: str
    k: str
    d: str
    n: str
    figure: str
    k2: str = "0"
    grouped: bool = True
    dealt: str = ""

    @property
    def rows(self) -> str:
        amount = f"cast({self.figure} as decimal(18,2))"
        head = f"select {self.k} as k, {self.k2} as k2, {self.d} as d"
        if not self.grouped:
            return f"{head}, {self.n} as n, {amount} as amt from {{{self.source}}}"
        keys = [self.k, self.d] + ([self.k2] if self.k2 != "0" else [])
        if self.d.startswith("cast(min("):
            keys.remove(self.d)
        total = f"cast(sum({amount}) as decimal(18,2))"
        return f"{head}, max({self.n}) as n, {total} as amt from {{{self.source}}} group by {', '.join(keys)}"

    def days(self, with_key: bool) -> str:
        """Distinct landing days, per key if asked, straight from the driver table."""
        if self.d.startswith("cast(min("):
            return f"select distinct k, d from ({self.rows}) b"
        return f"select distinct {self.k if with_key else '0'} as k, {self.d} as d from {{{self.source}}}"


def _lines(k: str, d: str = "cast(l_shipdate as date)", k2: str = "0", dealt: str = "") -> Base:
    return Base("lineitem", k, d, "l_orderkey * 10 + l_linenumber", "l_extendedprice", k2, dealt=dealt)


def _orders(k: str, d: str = "cast(o_orderdate as date)", k2: str = "0", dealt: str = "") -> Base:
    return Base("orders", k, d, "o_orderkey", "o_totalprice", k2, dealt=dealt)


def _events(k2: str = "0") -> Base:
    return Base("events", "user_id", "cast(ts as date)", "event_id", "value", k2)


def _dimension(source: str, k: str, amount: str = "0") -> Base:
    return Base(source, k, "date '2024-01-15'", k, amount, grouped=False)


BASES = {
    "part_days": _lines("l_partkey", dealt="l_partkey"),
    "supplier_days": _lines("l_suppkey", dealt="l_suppkey"),
    "customer_days": _orders("o_custkey", dealt="o_custkey"),
    "user_days": _events(),
    "user_type_days": _events("event_type"),
    "market_days": _orders("o_custkey % 4"),
    "weights": _lines("l_suppkey", k2="l_partkey"),
    "members": _lines("l_suppkey", "cast(min(l_shipdate) as date)", "l_partkey"),
    "holders": _lines("l_partkey % 50", "last_day(cast(l_shipdate as date))", "l_suppkey", dealt="l_suppkey"),
    "float_holders": _orders("o_custkey % 50", "last_day(cast(o_orderdate as date))", "o_custkey", dealt="o_custkey"),
    "funds": _lines("l_suppkey", "last_day(make_date(year(l_shipdate), quarter(l_shipdate) * 3, 1))", "l_partkey % 40"),
    "customers": _dimension("customer", "c_custkey", "c_acctbal"),
    "suppliers": _dimension("supplier", "s_suppkey", "s_acctbal"),
    "nations": _dimension("nation", "n_nationkey"),
}

# What each dataset is derived from; datasets not listed come from user_days.
BASE_OF = {
    "part_days": "daily adj_factor daily_basic stk_limit fina_indicator",
    "supplier_days": "index_daily balancesheet moneyflow",
    "customer_days": "income cashflow namechange forecast dividend weekly monthly anns",
    "user_days": "hsgt_top10 block_trade hm_detail stk_surv",
    "user_type_days": "hsgt_hold_top10",
    "market_days": "trade_cal",
    "weights": "index_weight",
    "members": "index_member",
    "holders": "top10_holders",
    "float_holders": "top10_floatholders",
    "funds": "fund_portfolio",
    "customers": "stock_basic stock_company",
    "suppliers": "index_basic",
    "nations": "index_classify",
}
_BASE = {dataset: base for base, names in BASE_OF.items() for dataset in names.split()}

# Text columns that hold figures the marts convert.
FIGURES = {
    **{d: schemas.BAR_FIGURES for d in ("daily", "weekly", "monthly", "index_daily")},
    **{d: " ".join(schemas.RAW_COLUMNS[d][2:]) for d in ("adj_factor", "daily_basic", "stk_limit", "moneyflow")},
    **{d: "hold_amount hold_ratio hold_float_ratio hold_change" for d in schemas.REQUEST_SCOPED_DATASETS},
    "forecast": "p_change_min p_change_max net_profit_min net_profit_max last_parent_net",
    "fund_portfolio": "mkv amount stk_mkv_ratio stk_float_ratio",
    "hsgt_hold_top10": "vol ratio",
    "hsgt_top10": "close change amount net_amount buy sell",
    "stock_company": "reg_capital employees",
}


def _code(k: str) -> str:
    suffix = f"case ({k}) % 3 when 0 then '.SH' when 1 then '.SZ' else '.BJ' end"
    return f"concat(lpad(cast({k} as {{text}}), 6, '0'), {suffix})"


def _digits(day: str) -> str:
    """``day`` as eight digits, marked for ``_dialect`` to spell."""
    return f"<<{day}>>"


def _spark_digits(day: str) -> str:
    """By numbers: printing a date and taking its dashes out costs several times as much."""
    return f"lpad(cast(year({day}) * 10000 + month({day}) * 100 + day({day}) as string), 8, '0')"


_QUARTER_END = "last_day(make_date(year(d), quarter(d) * 3, 1))"

# Columns with a meaning of their own, by dataset ("" = any).
MEANINGS = {
    "": {
        "ts_code": _code("k"),
        "report_type": "'1'",
        "update_flag": "cast(n % 2 as {text})",
        "comp_type": "cast(n % 4 as {text})",
    },
    "trade_cal": {
        "exchange": "case k when 0 then ' SZSE ' when 1 then 'sse' when 2 then 'BSE' end",
        "is_open": "case n % 3 when 0 then '1' when 1 then ' 0' else 'x' end",
    },
    "index_weight": {"index_code": _code("k"), "con_code": _code("k2")},
    "index_member": {"index_code": _code("k"), "con_code": _code("k2"), "in_date": _digits("d")},
    "index_classify": {"index_code": _code("k")},
    "stock_basic": {"list_status": "case n % 3 when 0 then 'L' when 1 then ' l ' else 'D' end"},
    "top10_holders": {"holder_name": "concat(' holder-', cast(k2 as {text}))", "end_date": _digits(_QUARTER_END)},
    "top10_floatholders": {"holder_name": "concat('holder-', cast(k2 as {text}))", "end_date": _digits(_QUARTER_END)},
    "fund_portfolio": {"symbol": _code("k2"), "end_date": _digits("d"), "ann_date": _digits("(d + 15)")},
    "hsgt_hold_top10": {"exchange": "k2"},
    "hsgt_top10": {"rank": "cast(n % 10 as {text})", "market_type": "cast(n % 2 as {text})"},
    **{d: {"end_date": _digits(_QUARTER_END), "ann_date": _digits("(d + 30)")} for d in schemas.STATEMENT_FIGURES},
}


def _value(dataset: str, column: str, position: int) -> str:
    stated = MEANINGS.get(dataset, {}).get(column) or MEANINGS[""].get(column)
    if stated:
        return stated
    kind = schemas.column_kind(dataset, column)
    dates = [c for c in schemas.RAW_COLUMNS[dataset] if schemas.column_kind(dataset, c) == "date"]
    if kind == "date":
        at = dates.index(column)
        day = _digits("d" if at == 0 else f"(d + {at * 20})")
        return day if at == 0 else f"case when (n + {position}) % 13 = 0 then ' ' else {day} end"
    figure = f"cast(amt + {position} as decimal(18,2))"
    if kind == "measure":
        return f"cast({figure} as decimal(38,18))"
    text = (
        f"concat(' ', cast({figure} as {{text}}))"
        if column in FIGURES.get(dataset, "").split()
        else f"concat('{column}-', cast((n + {position}) % 7 as {{text}}), ' ')"
    )
    return f"case when (n + {position}) % 11 = 0 then '  ' else {text} end"


def _values(dataset: str) -> list[str]:
    return [f"{_value(dataset, c, i)} as {{q}}{c}{{q}}" for i, c in enumerate(schemas.RAW_COLUMNS[dataset])]


def _base(dataset: str) -> Base:
    return BASES[_BASE.get(dataset, "user_days")]


def _landing(dataset: str) -> dict[str, str]:
    """Day, run and request scope a row lands under, and when."""
    _, scoped = schemas.selection_mode(dataset)
    run = "concat('run-', cast(ver as {text}))"
    hour = "concat(cast(d as {text}), ' 0', cast((day(d) + ver) % 2 + 1 as {text}), ':00:00')"
    return {
        "dt": _digits("d"),
        "run_id": f"concat({run}, '-', cast(k as {{text}}))" if scoped else run,
        "partition_date": "d",
        "request_params_hash": "concat('req-', cast(k as {text}))" if scoped else "''",
        "written_at": f"cast({hour} as {{timestamp}})",
    }


def _named(landing: dict[str, str], *names: str) -> list[str]:
    return [f"{landing[n]} as {n}" for n in names or landing]


def _rows_sql(dataset: str) -> str:
    """Driver rows of a dataset in both landings."""
    return f"select k, k2, d, n, amt + ver as amt, ver from (select *, {{versions}} as ver from ({_base(dataset).rows}) b) v"


def _artifacts_sql(dataset: str) -> str:
    """One row per landed artifact; request-scoped datasets land one per day and code."""
    days = _base(dataset).days(schemas.selection_mode(dataset)[1])
    columns = _named(_landing(dataset), "run_id", "partition_date", "request_params_hash", "written_at")
    return f"select distinct {', '.join(columns)} from (select *, {{versions}} as ver from ({days}) g) a"


def _dialect(
    sql: str, text: str, timestamp: str, quote: str, versions: str, tables: Mapping[str, object], digits: Callable[[str], str]
) -> str:
    sql = re.sub("<<(.*?)>>", lambda found: digits(found[1]), sql)
    return sql.format(text=text, timestamp=timestamp, q=quote, versions=versions, **tables)


def _spark_text(sql: str) -> str:
    return _dialect(sql, "string", "timestamp_ntz", "`", "explode(array(0, 1))", {t: "{" + t + "}" for t in _TABLES}, _spark_digits)


def _run(spark: SparkSession, sf_dir: str, template: str, dealt: str = "") -> DataFrame:
    used = {t: table(spark, sf_dir, t) for t in _TABLES if "{" + t + "}" in template}
    if dealt:
        used = {t: df.repartition(*dealt.split()) for t, df in used.items()}
    return spark.sql(_spark_text(template), **used)


def staged_feed(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """Staging table of a derived feed; losing landings are dropped before they are spelled out."""
    partitioned, scoped = schemas.selection_mode(dataset)
    artifacts = _run(spark, sf_dir, _artifacts_sql(dataset))
    landing = [_spark_text(c) for c in _named(_landing(dataset), "dt", "run_id")]
    rows = _run(spark, sf_dir, _rows_sql(dataset), _base(dataset).dealt).selectExpr("*", *landing)
    chosen = select_latest(rows, artifacts, partitioned, scoped)
    spelled = chosen.selectExpr(*[_spark_text(v) for v in _values(dataset)], "source_run_id", "raw_loaded_at")
    return stage(dataset, spelled)


class StagedFeeds(Mapping):
    """Staging tables by dataset name, planned on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir, self._built = spark, sf_dir, {}

    def __getitem__(self, dataset: str) -> DataFrame:
        if dataset not in self._built:
            self._built[dataset] = staged_feed(self._spark, self._sf_dir, dataset)
        return self._built[dataset]

    def __iter__(self):
        return iter(schemas.RAW_COLUMNS)

    def __len__(self) -> int:
        return len(schemas.RAW_COLUMNS)


def _duck(sql: str) -> str:
    return _dialect(sql, "varchar", "timestamp", '"', "unnest([0, 1])", {t: t for t in _TABLES}, lambda day: f"replace(cast({day} as varchar), '-', '')")


def staging_ctes(*datasets: str) -> str:
    """``raw_x`` and ``stg_x`` common table expressions for the checking engine."""
    parts = []
    for name in datasets:
        raw = _duck(f"select {', '.join(_values(name) + _named(_landing(name)))} from ({_rows_sql(name)}) r")
        partitioned, scoped = schemas.selection_mode(name)
        keys = ", ".join((["partition_date"] if partitioned else []) + (["request_params_hash"] if scoped else []))
        window = f"partition by {keys} " if keys else ""
        columns = []
        for c in schemas.RAW_COLUMNS[name]:
            kind = schemas.column_kind(name, c)
            text = f"nullif(trim(\"{c}\"), '')"
            columns.append(
                {"date": f"cast(strptime({text}, '%Y%m%d') as date)", "measure": f'"{c}"', "text": text}[kind] + f' as "{c}"'
            )
        if name == "stock_basic":
            columns.append("upper(trim(list_status)) = 'L' as is_active")
        parts.append(f"raw_{name} as (\n{raw}\n)")
        parts.append(
            f"stg_{name} as (select {', '.join(columns)}, run_id as source_run_id, written_at as raw_loaded_at from raw_{name}\n"
            f" qualify dense_rank() over ({window}order by written_at desc, partition_date desc, run_id desc) = 1)"
        )
    return ",\n".join(parts)
