"""The controller and the gates, as functions."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidewright.operators import control
from tidewright.operators.control import Load, Pace, Wave

PACE = Pace()
GOOD = Wave(units=10, failed_units=0, useful_units=10, requests=2, transport_failures=0, seconds=1.0)


@pytest.mark.parametrize("budget,concurrency,want", [(4, 1, 4), (2.5, 1, 2), (3.5, 1, 4), (100, 1, 16), (0.2, 1, 1), (10, 4, 2)])
def test_group_size_rounds_half_to_even(budget, concurrency, want):
    assert Load(budget, concurrency).group_size(PACE) == want


def test_good_waves_grow_load_and_then_concurrency():
    load = control.initial_load(PACE)
    budgets = []
    for _ in range(3):
        load = control.next_load(load, PACE, GOOD)
        budgets.append((round(load.budget, 4), load.concurrency))
    assert budgets == [(5.4, 1), (7.29, 2), (9.8415, 2)]


def test_slow_wave_shrinks_mildly():
    load = replace(Load(8.0, 2), ema=100.0)
    assert control.next_load(load, PACE, replace(GOOD, useful_units=1)).budget == pytest.approx(6.8)


@pytest.mark.parametrize("wave,budget,concurrency", [
    (replace(GOOD, transport_failures=2), 4.8, 1),
    (replace(GOOD, transport_failures=1), 8.0, 1),
    (replace(GOOD, failed_units=1), 4.8, 2),
    (replace(GOOD, units=100, failed_units=5), 6.8, 2),
])
def test_failures(wave, budget, concurrency):
    got = control.next_load(Load(8.0, 2, since_change=5), PACE, wave)
    assert (got.budget, got.concurrency, got.good_streak, got.bad_streak) == (pytest.approx(budget), concurrency, 0, 1)


def test_mixed_failures_without_room_to_slow_down():
    assert control.next_load(Load(8.0, 1), PACE, replace(GOOD, transport_failures=1)).budget == pytest.approx(6.8)


def test_concurrency_never_exceeds_the_load():
    got = control.next_load(Load(2.0, 4), replace(PACE, min_concurrency=1), replace(GOOD, units=10, failed_units=9))
    assert got.concurrency == 1 and got.budget == pytest.approx(1.2)


@pytest.mark.parametrize("bad", [{"min_group_size": 0}, {"initial_group_size": 99}, {"initial_concurrency": 9}])
def test_pace_rules(bad):
    with pytest.raises(ValueError):
        Pace(**bad)


def test_token_wait():
    window = [(0.0, 50), (30.0, 40)]
    assert control.token_wait(window, 10, 40.0, None) == 0
    assert control.token_wait(window, 10, 40.0, 200) == 0
    assert control.token_wait(window, 10, 40.0, 100) == 20
    assert control.token_wait(window, 10, 60.0, 100) == 0 and control.token_wait([], 10**9, 0.0, 1) == 0
    assert control.token_wait([(0.0, 100)], 10, 0.0, 100, most=5) == 5


def test_estimated_tokens(spark):
    frame = spark.createDataFrame([("x" * 9, 2), (None, 0), ("🙂", 1)], "p string, n int")
    assert [r.t for r in frame.select(control.estimated_tokens(F.col("p"), F.col("n")).alias("t")).collect()] == [3 + 48 + 250, 250, 1 + 24 + 250]
    assert frame.limit(1).select(control.estimated_tokens(F.lit(""), F.lit(0), overhead=0).alias("t")).first().t == 1


def test_time_limit(spark):
    rows = [(1, k, float(s)) for k, s in enumerate([10, 30, -5, 500, 20])]
    frame = spark.createDataFrame(rows, "lane int, event_id int, seconds double").withColumn("ts", F.col("event_id"))
    got = [(r.event_id, r.sample_count, r.center_seconds, round(r.limit_seconds, 3)) for r in control.time_limit(frame, base=20.0, most=400.0).orderBy("event_id").collect()]
    assert got[0] == (0, 1, 10.0, 25.0) and got[1] == (1, 2, 20.0, 40.0) and got[2][1:] == (3, 30.0, 400.0) and got[3][1:3] == (4, 25.0)


def test_groups_have_the_size(spark):
    frame = spark.range(50).select(F.sha2(F.col("id").cast("string"), 256).alias("unit_id"))
    for digits in (0, 1):
        sizes = [r["count"] for r in control.grouped(frame, 4, digits).groupBy("group_id").count().collect()]
        assert sum(sizes) == 50 and max(sizes) == 4


@pytest.mark.parametrize("units,want", [(0, 0), (4096, 0), (4097, 1), (10**6, 2), (10**12, 7)])
def test_bucket_digits(units, want):
    assert control.bucket_digits(units) == want


def test_rolling_tokens_over_stretches(spark):
    rows = [(k % 3, 590 + 7 * k // 3, k) for k in range(200)]
    frame = spark.createDataFrame(rows, "lane int, sec long, tokens long")
    got = sorted(tuple(r) for r in control.rolling_tokens(frame).select("lane", "sec", "tokens", "window_tokens").collect())
    assert got == sorted((a, s, n, sum(m for b, t, m in rows if a == b and s - 59 <= t <= s)) for a, s, n in rows)
