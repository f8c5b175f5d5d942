from __future__ import annotations

import math
import random
from collections import Counter
from datetime import date, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from lakemart.operators import quality as Q
from lakemart.operators.coholding import co_holding, item_pairs
from lakemart.operators.joins import interval_pairs, spine_join, without_matches
from lakemart.operators.ordering import latest_per_key, newest_first
from lakemart.operators.rolling import rolling_zscore
from lakemart.plans.intermediate import index_membership, latest_of_sources


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_limits_before_the_exchange(frame):
    df = frame("k int, t int, v string", (1, 1, "a"), (1, 2, "b"), (2, None, "c"), (2, 0, "d"))
    best = latest_per_key(df, ["k"], newest_first("t"))
    assert sorted(r["v"] for r in best.collect()) == ["b", "d"]
    assert plan_of(best).count("WindowGroupLimit") >= 2


def test_latest_without_keys_is_not_a_window(frame):
    df = frame("t int", (1,), (3,), (2,))
    best = latest_per_key(df, [], newest_first("t"))
    assert [r["t"] for r in best.collect()] == [3]
    assert "Window" not in plan_of(best)


def test_spine_keeps_null_keys_unmatched(frame, rows):
    a = frame("k string, x int", ("p", 1), (None, 2))
    b = frame("k string, y int", ("q", 3), (None, 4))
    wide = spine_join({"a": a, "b": b}, ["k"])
    assert rows(wide, "k", "a__x", "b__y") == sorted([("p", 1, None), ("q", None, 3), (None, None, None)], key=repr)


def brute_intervals(points, spans):
    found = [
        (p, s)
        for p in points
        for s in spans
        if p[0] == s[0] and s[1] is not None and p[1] >= s[1] and (s[2] is None or p[1] <= s[2])
    ]
    return sorted(found, key=repr)


def test_interval_pairs_match_brute_force(frame):
    rng = random.Random(7)
    base = date(2000, 1, 1)
    def day():
        return base + timedelta(days=rng.randrange(1500))
    points = [(rng.choice("abc"), day()) for _ in range(150)]
    spans = []
    for _ in range(60):
        start = rng.choice([None, *[day()] * 9])
        end = rng.choice([None, (start or base) + timedelta(days=rng.randrange(-5, 700))])
        spans.append((rng.choice("abd"), start, end))
    p = frame("k string, at date", *points)
    s = frame("k string, lo date, hi date", *spans)
    for width in (7, 366):
        got = interval_pairs(p, s, ["k"], "at", "lo", "hi", bucket_days=width).collect()
        assert sorted((((r["k"], r["at"]), (r["k"], r["lo"], r["hi"])) for r in got), key=repr) == brute_intervals(points, spans)
        anti = interval_pairs(p, s, ["k"], "at", "lo", "hi", "left_anti", width).count()
        assert anti == sum(1 for q in points if not brute_intervals([q], spans))


def test_without_matches_treats_null_as_equal(frame, rows):
    left = frame("k string, d int", ("a", None), ("b", 1))
    assert rows(without_matches(left, frame("k string, d int", ("a", None)), ["k", "d"])) == [("b", 1)]


def test_pairs_are_added_up_where_they_are_formed(frame, rows):
    data = [(f"d{n % 2}", f"h{n % 3}", f"s{n // 3}", n) for n in range(60)] + [("d0", None, "s1", 1), (None, "h1", "s1", 1), ("d0", "h1", None, 1)]
    df = frame("report_date string, holder_id string, security_id string, announced_date int", *data)
    for block_rows in (1000, 3):
        pairs = item_pairs(df.where("security_id is not null"), ["report_date", "holder_id"], "security_id", ["announced_date"], block_rows)
        grouped = pairs.groupBy("report_date", "_block", "security_id_left", "security_id_right").count()
        plan = plan_of(grouped)
        # Nothing is dealt anew between the pairs and their sums.
        assert "HashAggregate" in plan and "Exchange" not in plan[: plan.index("Generate")]
        want = Counter()
        for date in ("d0", "d1"):
            for holder in ("h0", "h1", "h2"):
                mine = sorted(r[2] for r in data if r[:2] == (date, holder) and r[2])
                want.update((date, a, b) for a, b in combinations(mine, 2))
        assert rows(grouped.drop("_block")) == sorted([(*k, n) for k, n in want.items()], key=repr)


@pytest.mark.parametrize("block_rows", [1000, 8, 3])
def test_pairs_are_dealt_evenly_and_lists_in_as_many_tasks(frame, block_rows):
    dates = [date(2026, 3, d) for d in (1, 2, 3)]
    data = [(dates[n % 3], f"h{n}", f"s{(n * 7 + k * (1 + n % 5)) % 60:02d}", dates[0]) for n in range(90) for k in range(12)]
    df = frame("report_date date, holder_id string, security_id string, announced_date date", *dict.fromkeys(data))
    pairs = item_pairs(df, ["report_date", "holder_id"], "security_id", ["announced_date"], block_rows)
    got = pairs.groupBy("_block").count().collect()
    held = {}
    for day, holder, security, _ in dict.fromkeys(data):
        held.setdefault((day, holder), set()).add(security)
    total = sum(len(s) * (len(s) - 1) // 2 for s in held.values())
    assert sum(r["count"] for r in got) == total
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(total / block_rows**2))
    assert pairs.rdd.getNumPartitions() == tasks
    if block_rows == 1000:
        # Blocks were dealt to tasks by hash: with one block a date at most three tasks had pairs.
        assert len(got) > 3 and max(r["count"] for r in got) < 3 * total / tasks


def test_co_holding_is_the_same_for_any_block_size(frame, rows):
    rng = random.Random(3)
    data = [(date(2026, 3, 31), f"f{rng.randrange(3)}", f"s{rng.randrange(25):02d}", date(2026, 4, 1 + rng.randrange(20))) for _ in range(120)]
    df = frame("report_date date, holder_id string, security_id string, announced_date date", *data)
    whole = rows(co_holding(df, block_rows=1000))
    assert whole == rows(co_holding(df, block_rows=3))
    held = {}
    for _, fund, item, _ in data:
        held.setdefault(item, set()).add(fund)
    expected = {
        (a, b): len(held[a] & held[b]) / len(held[a] | held[b])
        for a in held for b in held if a < b and held[a] & held[b]
    }
    df2 = co_holding(df).select("security_id_left", "security_id_right", "jaccard_score").collect()
    assert {(r[0], r[1]): r[2] for r in df2} == expected


def test_rolling_zscore_drops_flat_windows(frame):
    df = frame("k string, d date, v double", *[("a", date(2026, 1, i), 100.0) for i in range(1, 4)], *[("b", date(2026, 1, i), float(i)) for i in range(1, 4)])
    got = rolling_zscore(df, ["k"], "d", "v").orderBy("d").collect()
    assert [(r["k"], r["d"].day) for r in got] == [("b", 2), ("b", 3)]
    assert got[1]["metric_mean"] == 2.0 and got[1]["metric_z_score"] == 1.0


def test_latest_of_sources_prefers_the_earlier_source_on_ties(frame, rows):
    columns = "k string, ann date, run string, kind string, v int"
    a = frame(columns, ("x", date(2026, 1, 1), "r1", "a1", 1), ("x", None, "r9", "a0", 9), (None, date(2026, 1, 1), "r1", "a", 5))
    b = frame(columns, ("x", date(2026, 1, 1), "r2", "b1", 2), ("y", None, "r1", "b2", 3))
    wide = latest_of_sources({"a": a, "b": b}, ("k",), ("ann", "run"), ("ann",), ("kind",), {"a": ["v"], "b": ["v"]})
    assert rows(wide, "k", "kind", "a__v", "b__v") == sorted(
        [("x", "a1", 1, 2), ("y", "b2", None, 3), (None, None, None, None)], key=repr
    )


def test_quality_checks(frame, rows):
    df = frame("k int, g string, flag boolean, d string", (1, "a", True, "20260101"), (1, "a", True, "bad"), (2, None, False, None), (3, "z", None, "2026-01-02"))
    assert rows(Q.duplicates(df, ["k"])) == [(1, 2)]
    assert rows(Q.nulls(df, ["g", "d"]), "k", "null_columns") == [(2, "g,d")]
    assert rows(Q.null_counts(df, ["g", "d"])) == [("d", 1), ("g", 1)]
    assert rows(Q.outside_values(df, "g", ["a"])) == [("z", 1)]
    assert rows(Q.orphans(df, "g", frame("p string", ("a",), (None,)), "p")) == [("z", 1)]
    assert rows(Q.several_true(df, ["k"], "flag")) == [(1, 2)]
    assert rows(Q.unparsable_dates(df, "d"), "d") == [("bad",)]
    other = frame("k int", (1,), (4,), (None,))
    assert rows(Q.key_parity(df.select("k"), other, ["k"])) == sorted([(2, "left"), (3, "left"), (4, "right"), (None, "right")], key=repr)


def test_identity_violations(frame, rows):
    df = frame("code string, day string", ("000001.SZ", "20260415"), (None, "20260230"), (" ", "2026-04-15"), (" 000001.SZ", "20260415"))
    found = Q.identity_violations(df, ["code", "day"], ["code"], ["day"])
    assert rows(found, "violations") == [("code:blank,day:malformed",), ("code:malformed",), ("code:null,day:malformed",)]
    assert rows(Q.identity_violations(df, ["code"], nullable=["code"])) == []


def test_reconcile_flags_units_and_sides(frame, rows):
    left = frame("k int, v double, d date", (1, 100.0, date(2026, 1, 1)), (2, 5.0, date(2026, 1, 1)), (3, 1.0, date(2026, 1, 1)))
    right = frame("k int, v double, d date", (1, 1.0, date(2026, 1, 1)), (2, 5.0, date(2026, 1, 2)), (4, 1.0, date(2026, 1, 1)))
    diff = Q.reconcile(left, right, ["k"], ["v"], {"v": 100.0}, "d")
    assert rows(diff, "k", "coverage", "v_diff", "v_unit_diff", "date_diff") == [
        (1, "both", True, True, False), (2, "both", False, False, True),
        (3, "missing_right", False, False, False), (4, "missing_left", False, False, False),
    ]


def test_index_members_are_staged_once(frame, rows):
    loaded = "source_run_id string, raw_loaded_at timestamp_ntz"
    member = "index_code string, con_code string, index_name string, con_name string, in_date date, out_date date, is_new string, "
    on = date(2026, 3, 1)
    members = frame(
        member + loaded,
        ("i", "a", "I", "A", on, None, "Y", "m", None),
        ("i", "b", "I", "B", on, None, "Y", "m", None),
        (None, "a", "I", "A", on, None, "Y", "m", None),
    )
    weights = frame(
        "index_code string, con_code string, trade_date date, weight string, " + loaded,
        ("i", "a", on + timedelta(1), "1", "w", None),
        ("i", "a", on - timedelta(1), "2", "w", None),
    )
    basics = frame("ts_code string, name string, market string, category string, " + loaded, ("i", "Index", "x", "y", "b", None))
    spelled = members.withColumn("con_name", F.reverse("con_name"))
    got = index_membership({"index_member": spelled, "index_weight": weights, "index_basic": basics})
    # Members come from the table they were written to, in the matches and among those nobody matched.
    assert "reverse(" not in plan_of(got)
    assert rows(got, "index_code", "con_code", "trade_date", "valid_from") == sorted(
        [("i", "a", on + timedelta(1), on), ("i", "a", on - timedelta(1), None), ("i", "b", None, on), (None, "a", None, on)], key=repr
    )
