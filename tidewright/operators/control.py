"""Pacing of requests: group sizes, token budgets, time limits, and the load after each wave."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidewright.operators.stretches import PLACE, STRETCH, carried, in_stretches, led_by

TOKEN_WINDOW_SECONDS = 60


@dataclass(frozen=True)
class Pace:
    """Limits and factors of the load; a load is units in flight, group size times requests at a time."""

    initial_group_size: int = 4
    min_group_size: int = 1
    max_group_size: int = 16
    initial_concurrency: int = 1
    min_concurrency: int = 1
    max_concurrent_requests: int = 4
    growth: float = 1.35
    shrink: float = 0.60
    mild_shrink: float = 0.85
    soft_failure_rate: float = 0.02
    hard_failure_rate: float = 0.10
    throughput_tolerance: float = 0.05
    ema_alpha: float = 0.30
    growth_cooldown_waves: int = 2
    shrink_cooldown_waves: int = 1

    def __post_init__(self):
        if not 1 <= self.min_group_size <= self.initial_group_size <= self.max_group_size:
            raise ValueError("group sizes must be 1 <= min <= initial <= max")
        if not 1 <= self.min_concurrency <= self.initial_concurrency <= self.max_concurrent_requests:
            raise ValueError("concurrency must be 1 <= min <= initial <= max")


@dataclass(frozen=True)
class Load:
    budget: float
    concurrency: int
    ema: float | None = None
    good_streak: int = 0
    bad_streak: int = 0
    since_change: int = 0

    def group_size(self, pace: Pace) -> int:
        """Half-way loads round to even."""
        return int(min(max(round(self.budget / max(self.concurrency, 1)), pace.min_group_size), pace.max_group_size))


@dataclass(frozen=True)
class Wave:
    units: int
    failed_units: int
    useful_units: int
    requests: int
    transport_failures: int
    seconds: float
    successful_requests: int | None = None  # None: all that did not fail on the way


def initial_load(pace: Pace) -> Load:
    return Load(float(pace.initial_group_size * pace.initial_concurrency), pace.initial_concurrency)


def moving_average(previous: float | None, value: float, alpha: float) -> float:
    return value if previous is None else alpha * value + (1 - alpha) * previous


def next_load(load: Load, pace: Pace, wave: Wave) -> Load:
    """The load after a wave. Failed requests and failed answers shrink it; a good wave grows it unless it was slow. Requests
    at a time follow more slowly than the budget, and never exceed what the budget can fill."""
    score = wave.useful_units / max(wave.seconds, 1e-9)
    ema = moving_average(load.ema, score, pace.ema_alpha)
    failure_rate = wave.failed_units / max(wave.units, 1)
    waited = load.since_change + 1
    fewer = load.concurrency > pace.min_concurrency and waited >= pace.shrink_cooldown_waves
    factor, step, good = 1.0, 0, False
    if wave.transport_failures == max(wave.requests, 1):
        factor, step = pace.shrink, -fewer
    elif wave.transport_failures and wave.successful_requests != 0:
        factor, step = (1.0, -1) if fewer else (pace.mild_shrink, 0)
    elif failure_rate >= pace.soft_failure_rate:
        factor = pace.shrink if failure_rate >= pace.hard_failure_rate else pace.mild_shrink
    else:
        good = True
        if score < ema * (1 - pace.throughput_tolerance):
            factor = pace.mild_shrink
        else:
            factor = pace.growth
            ready = min(load.good_streak + 1, waited) >= pace.growth_cooldown_waves
            step = int(ready and load.concurrency < pace.max_concurrent_requests)
    budget = min(max(load.budget * factor, pace.min_group_size * pace.min_concurrency), pace.max_group_size * pace.max_concurrent_requests)
    fillable = max(int(budget // pace.min_group_size), 1)
    concurrency = load.concurrency + step
    if concurrency > fillable:
        concurrency = max(pace.min_concurrency, fillable)
    return replace(load, budget=budget, concurrency=concurrency, ema=ema, good_streak=load.good_streak + 1 if good else 0, bad_streak=0 if good else load.bad_streak + 1, since_change=0 if step else waited)


def bucket_digits(units: int, most: int = 4096) -> int:
    """Digits of the id that part this many units into buckets of ``most`` or so."""
    digits = 0
    while units > most * 16**digits:
        digits += 1
    return digits


def grouped(units: DataFrame, size: int, digits: int = 0) -> DataFrame:
    """units with ``group_id`` and ``group_place``: ``size`` units a group in the order of their ids, numbered within buckets of
    ids with the same first ``digits`` (ids are hexadecimal hashes), so that many tasks number groups."""
    bucket = F.substring("unit_id", 1, digits) if digits else F.lit("")
    placed = units.withColumn("__bucket", bucket)
    k = F.row_number().over(Window.partitionBy("__bucket").orderBy("unit_id")) - 1
    named = placed.withColumn("__k", k).withColumns({"group_id": F.concat_ws("-", F.col("__bucket"), F.floor(F.col("__k") / size).cast("string")), "group_place": F.pmod("__k", F.lit(size))})
    return named.drop("__bucket", "__k")


def estimated_tokens(prompt: Column, n_units: Column, chars_per_token: float = 4.0, response_per_unit: float = 24, overhead: int = 250) -> Column:
    """Tokens that a request is likely to take, at least 1."""
    prompt_tokens = F.ceil(F.length(F.coalesce(prompt, F.lit(""))) / F.lit(max(chars_per_token, 0.1)))
    return F.greatest(F.lit(1), prompt_tokens + F.ceil(n_units * F.lit(float(response_per_unit))) + F.lit(int(overhead))).cast("long")


def rolling_tokens(sent: DataFrame, lane: str = "lane", second: str = "sec", tokens: str = "tokens") -> DataFrame:
    """sent with the tokens of the lane's last 60 seconds, itself included. A window's partition is a stretch of ten minutes of a
    lane, led by sums of the seconds before it, so that a busy lane is shared by many tasks."""
    stretch = F.floor(F.col(second) / (10 * TOKEN_WINDOW_SECONDS))
    own = sent.withColumns({"__stretch": stretch, "__own": F.lit(True)})
    into = F.floor((F.col(second) + TOKEN_WINDOW_SECONDS - 1) / (10 * TOKEN_WINDOW_SECONDS))
    lead = sent.where(into > stretch).groupBy(lane, second).agg(F.sum(tokens).alias(tokens)).withColumn("__stretch", into)
    window = Window.partitionBy(lane, "__stretch").orderBy(second).rangeBetween(-(TOKEN_WINDOW_SECONDS - 1), 0)
    both = own.unionByName(lead.withColumn("__own", F.lit(False)), allowMissingColumns=True)
    return both.withColumn("window_tokens", F.sum(tokens).over(window)).where("__own").drop("__stretch", "__own")


def token_wait(window: Sequence[tuple[float, int]], coming: int, now: float, target: float | None, margin: float = 0.80, most: float = 120.0) -> float:
    """Seconds until the oldest of (sent at, tokens) leaves the minute, when the coming request would break the budget."""
    if target is None:
        return 0.0
    recent = [(at, n) for at, n in window if at > now - TOKEN_WINDOW_SECONDS]
    if not recent or sum(n for _, n in recent) + coming <= target * margin:
        return 0.0
    return min(max(0.0, min(at for at, _ in recent) + TOKEN_WINDOW_SECONDS - now), most)


def moving_averages(samples: DataFrame, lane: str, order: Sequence[str], value: str, alpha: float) -> DataFrame:
    """samples with the ``average`` of their lane so far, which moves by ``alpha`` to each value and starts with the first; those
    without a value are left out. A stretch of a lane maps the average before it to a * average + b, so stretches are shared by tasks."""
    rows = in_stretches(samples.where(F.col(value).isNotNull()), [lane, *order]).withColumn("__x", F.col(value).cast("double"))

    def moved(now: float | None, values: Sequence[float]) -> list[float]:
        out = []
        for x in values:
            now = moving_average(now, x, alpha)
            out.append(now)
        return out

    def total(key: tuple, table: pa.Table) -> pa.Table:
        values = table.sort_by(PLACE)["__x"].to_pylist()
        made = {"a": (1 - alpha) ** len(values), "b": moved(0.0, values)[-1], "start": moved(None, values)[-1]}
        return pa.table({lane: table[lane][:1], STRETCH: table[STRETCH][:1]} | {c: pa.array([x], pa.float64()) for c, x in made.items()})

    def then(before: tuple | None, own: tuple) -> tuple:
        a, b, start = own
        return own if before is None else (a * before[0], a * before[1] + b, a * before[2] + b)

    names = samples.columns

    def follow(table: pa.Table) -> pa.Table:
        ordered = table.sort_by(PLACE)
        found = moved(ordered["before_start"][0].as_py(), ordered["__x"].to_pylist())
        return ordered.select(names).append_column("average", pa.array(found, pa.float64()))

    kind = samples.schema[lane].dataType.simpleString()
    maps = rows.select(lane, STRETCH, PLACE, "__x").groupBy(lane, STRETCH).applyInArrow(total, f"{lane} {kind}, {STRETCH} long, a double, b double, start double")
    led = led_by(rows, carried(maps, lane, ["a", "b", "start"], then), [lane, STRETCH])
    out = StructType([*samples.schema.fields, StructField("average", DoubleType())])
    return led.groupBy(lane, STRETCH).applyInArrow(follow, out)


def time_limit(samples: DataFrame, lane: str = "lane", order: Sequence[str] = ("ts", "event_id"), seconds: str = "seconds", base: float = 300.0, most: float = 1800.0, size: int = 8, least_samples: int = 1, multiplier: float = 2.0, least_margin: float = 15.0, center: str = "median", spread: str = "stdev") -> DataFrame:
    """samples with the time limit that the last ``size`` positive durations of a lane suggest. A window's partition is a stretch of a
    lane, led by the last samples before it."""
    rows = in_stretches(samples.where(F.col(seconds) > 0), [lane, *order])
    back = F.row_number().over(Window.partitionBy(lane, STRETCH).orderBy(F.desc(PLACE)))
    last = rows.select(lane, STRETCH, PLACE, F.col(seconds).cast("double").alias("x")).withColumn("__back", back).where(F.col("__back") < size)
    in_place = F.sort_array(F.collect_list(F.struct(PLACE, "x")))
    tails = last.groupBy(lane, STRETCH).agg(F.transform(in_place, lambda r: r["x"]).alias("tail"))

    def then(before: tuple | None, own: tuple) -> tuple:
        return ([*(before[0] if before else ()), *own[0]][-(size - 1) :],)

    known = carried(tails, lane, ["tail"], then)
    lead = known.select(lane, STRETCH, F.posexplode("before_tail").alias("__at", seconds)).withColumn(PLACE, F.col("__at").cast("long") - size).drop("__at")
    both = rows.withColumn("__own", F.lit(True)).unionByName(lead.withColumn("__own", F.lit(False)), allowMissingColumns=True)
    window = Window.partitionBy(lane, STRETCH).orderBy(PLACE).rowsBetween(-(size - 1), 0)

    def middle(values: Column) -> Column:
        ranked, n = F.array_sort(values), F.size(values)
        return (F.element_at(ranked, F.floor((n + 1) / 2).cast("int")) + F.element_at(ranked, F.floor(n / 2).cast("int") + 1)) / 2

    seen = both.withColumns({"__last": F.collect_list(seconds).over(window), "__mean": F.avg(seconds).over(window), "__dev": F.stddev_pop(seconds).over(window)}).where("__own")
    centered = seen.withColumn("center_seconds", F.col("__mean") if center == "mean" else middle(F.col("__last")))
    spreads = {"none": F.lit(0.0), "stdev": F.col("__dev"), "mad": middle(F.transform("__last", lambda x: F.abs(x - F.col("center_seconds"))))}
    wide = centered.withColumn("spread_seconds", spreads[spread])
    margin = F.greatest(F.lit(least_margin), F.col("spread_seconds") * multiplier)
    limit = F.least(F.greatest(F.lit(base), F.when(F.size("__last") >= least_samples, F.col("center_seconds") + margin).otherwise(F.lit(base))), F.lit(most))
    return wide.withColumns({"sample_count": F.size("__last"), "limit_seconds": limit}).select(*samples.columns, "center_seconds", "spread_seconds", "sample_count", "limit_seconds")


def shared_failures(failures: DataFrame, lane: str = "lane", second: str = "sec", window: int = 90) -> DataFrame:
    """For each second with a failure, how many lanes failed in the ``window`` seconds up to it. Seconds meet by stretches of the
    window's length, so a group holds at most two windows of distinct seconds and lanes."""
    seen = failures.select(F.col(lane).alias("l"), F.col(second).cast("long").alias("s")).distinct()
    earlier = seen.select("l", F.col("s").alias("then"), F.explode(F.array(F.floor(F.col("s") / window), F.floor(F.col("s") / window) + 1)).alias("stretch"))
    now = seen.select("s").distinct().withColumn("stretch", F.floor(F.col("s") / window))
    near = now.join(earlier, "stretch").where((F.col("then") <= F.col("s")) & (F.col("s") - F.col("then") <= window))
    return near.groupBy(F.col("s").alias("sec")).agg(F.count_distinct("l").alias("n_lanes"))


def lane_totals(lanes: DataFrame) -> DataFrame:
    """For the log: the load budgets of all lanes, and the largest group."""
    return lanes.agg(F.sum("load_budget").alias("load_budget"), F.max("group_size").alias("group_size"))
