from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemart.checks.market_feeds import _digits, _duck, _spark_digits, _spark_text
from lakemart.functions import scalar as S


def one(frame, value, expression, kind="string"):
    return frame(f"v {kind}", (value,)).select(expression(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("value,expected", [("  a ", "a"), ("   ", None), ("", None), (None, None)])
def test_clean_text(frame, value, expected):
    assert one(frame, value, S.clean_text) == expected


def test_strict_date_reads_eight_digits(frame):
    assert one(frame, " 20260415 ", S.strict_date) == date(2026, 4, 15)
    assert one(frame, " ", S.strict_date) is None


@pytest.mark.parametrize("value", ["2026041", "2026-04-15", "20260230", "x"])
def test_strict_date_raises(frame, value):
    with pytest.raises(Exception):
        one(frame, value, S.strict_date)


@pytest.mark.parametrize("value", ["00000101", "20260415\n", "202604156"])
def test_strict_date_still_refuses_what_a_pattern_refuses(frame, value):
    with pytest.raises(Exception):
        one(frame, value, S.strict_date)


def test_strict_date_is_a_cast(frame):
    df = frame("v string", ("00010101",), ("99991231",)).select(S.strict_date("v").alias("r"))
    assert [r["r"] for r in df.collect()] == [date(1, 1, 1), date(9999, 12, 31)]
    assert "gettimestamp" not in df._jdf.queryExecution().executedPlan().toString()


def test_spelled_days_are_those_of_the_checking_engine(spark):
    days = ["0001-01-01", "0987-12-09", "2024-02-29", "9999-12-31", None]
    df = spark.createDataFrame([(d,) for d in days], "t string").selectExpr("cast(t as date) as d")
    got = df.selectExpr("replace(cast(d as string), '-', '') as a", f"{_spark_digits('d')} as b").collect()
    assert [r["a"] for r in got] == [r["b"] for r in got] == [d and d.replace("-", "") for d in days]
    text = _spark_text(_digits("(d + 30)"))
    assert "replace(" not in text and _duck(_digits("(d + 30)")) == "replace(cast((d + 30) as varchar), '-', '')"


@pytest.mark.parametrize(
    "value,expected",
    [("2026-04-15", date(2026, 4, 15)), ("20260415", date(2026, 4, 15)), ("2026", None), ("2026041", None), ("20260230", None)],
)
def test_lenient_date(frame, value, expected):
    assert one(frame, value, S.lenient_date) == expected


def test_measures(frame):
    assert one(frame, " 1.123456789012345678 ", S.strict_measure) == Decimal("1.123456789012345678")
    assert one(frame, "n/a", S.lenient_measure) is None
    with pytest.raises(Exception):
        one(frame, "n/a", S.strict_measure)


@pytest.mark.parametrize("value,expected", [("1", True), (" 0", False), ("2", None), (None, None)])
def test_tri_state(frame, value, expected):
    assert one(frame, value, S.tri_state) is expected


@pytest.mark.parametrize("value,expected", [("399001.sz", "SZSE"), ("000001.SH", "SSE"), ("1.BJ", "BSE"), ("1.HK", None)])
def test_exchange_of(frame, value, expected):
    assert one(frame, value, S.exchange_of) == expected


def test_cycle_id_round_trip(frame):
    assert one(frame, date(2026, 4, 15), S.cycle_id_of, "date") == "CYCLE_20260415"
    assert one(frame, "CYCLE_20260415", S.cycle_date_of) == date(2026, 4, 15)
    assert one(frame, "CYCLE_20260230", S.cycle_date_of) is None


def test_one_day_return(frame):
    df = frame("p double, c double, b double", (1.2, 5.0, 4.0), (None, 1700.0, 1680.0), (None, 1.0, 0.0))
    got = [r[0] for r in df.select(S.one_day_return(F.col("p"), F.col("c"), F.col("b"))).collect()]
    assert got == pytest.approx([0.012, 20 / 1680, None])
