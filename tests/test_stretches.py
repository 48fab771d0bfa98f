"""Orders over stretches, and contract checks."""

import random

import pytest
from pyspark.sql import functions as F

from tidewright.operators import contract, control, stretches, units

LANES = [(lane, k, float(random.Random(31 * k + (lane or 0)).randrange(-3, 50))) for lane in (None, 1, 2, 3) for k in range(30 if lane != 2 else 700)]


@pytest.fixture(params=[16, 5, 2])
def bits(request, monkeypatch):
    """Stretches of 65,536, 32 and 4 rows; the last have more summaries than one task takes."""
    monkeypatch.setattr(stretches, "STRETCH_BITS", request.param)
    monkeypatch.setattr(stretches, "LONGEST", 1 << request.param)
    return request.param


def lanes(spark):
    rows = [*LANES, (1, 99, None)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "lane int, k int, x double").withColumn("before_a", F.lit("theirs"))


def test_moving_averages_over_stretches(spark, bits):
    got = sorted(((r.lane or 0, r.k, round(r.average, 9)) for r in control.moving_averages(lanes(spark).drop("before_a"), "lane", ["k"], "x", 0.3).collect()), key=str)
    want, now = [], {}
    for lane, k, x in LANES:
        now[lane] = control.moving_average(now.get(lane), x, 0.3)
        want.append((lane or 0, k, round(now[lane], 9)))
    assert got == sorted(want, key=str)


def test_time_limits_over_stretches(spark, bits):
    got = control.time_limit(lanes(spark).withColumn("lane", F.coalesce("lane", F.lit(0))), order=["k"], seconds="x", center="mean")
    want, seen = [], {}
    for lane, k, x in LANES:
        if x > 0:
            seen.setdefault(lane, []).append(x)
            last = seen[lane][-8:]
            want.append((lane or 0, k, len(last), round(sum(last) / len(last), 6)))
    assert sorted((r.lane, r.k, r.sample_count, round(r.center_seconds, 6)) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("offset,limit", [(0, 5), (990, 5), (995, 50), (1000, 3), (17, None), (3, 0), (500, 1)])
def test_row_windows_by_position(spark, offset, limit):
    keys = random.Random(2).sample(range(10_000), 1000)
    frame = spark.createDataFrame([(k % 7, k, "v") for k in keys], "a int, b int, __other string").repartition(5)
    got = units.row_window(frame, ["a", "b"], offset, limit)
    want = sorted((k % 7, k) for k in keys)[offset:][: limit if limit is not None else 1000]
    assert sorted((r.a, r.b) for r in got.collect()) == want and got.columns == frame.columns
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CollectLimit" not in plan


def test_breaches(spark):
    asked = spark.createDataFrame([("r1", "a"), ("r1", "b"), ("r1", "c"), ("r2", "d"), (None, "e")], "request_id string, unit_id string")
    said = [("r1", "a", "success"), ("r1", "b", "success"), ("r1", "b", "odd"), ("r2", "x", "success"), (None, None, "success"), (None, "e", "permanent_error")]
    found = contract.breaches(asked, spark.createDataFrame(said, "request_id string, unit_id string, status string"))
    got = {(r.request_id, r.unit_id): r.problems for r in found.collect()}
    assert got == {("r1", "b"): "malformed,repeated", ("r1", "c"): "missing", ("r2", "d"): "missing", ("r2", "x"): "unexpected", (None, None): "malformed,unexpected"}
    assert {r.request_id: (r.malformed, r.missing) for r in contract.broken_requests(found).collect()} == {"r1": (1, 1), "r2": (0, 1), None: (1, 0)}


def test_many_copies_of_one_answer_meet_as_one_row(spark):
    asked = spark.createDataFrame([("r", "a")], "request_id string, unit_id string")
    answers = spark.range(50_000).select(F.lit("r").alias("request_id"), F.lit("a").alias("unit_id"), F.lit("success").alias("status"))
    assert [(r.answered, r.problems) for r in contract.breaches(asked, answers).collect()] == [(50_000, "repeated")]
