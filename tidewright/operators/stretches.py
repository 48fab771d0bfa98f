"""Rows in a total order, cut into stretches that tasks share, and what each stretch needs to know of those before it.

``in_order`` writes rows range-partitioned and sorted, with their place. A stretch is at most ``LONGEST`` neighbours in a partition, so a
lane with all rows of a table is as many stretches as any other rows. State is carried over stretches by a summary of each: ``carried``
combines summaries in order, in stretches of summaries where there are many, so no task sees more than ``LONGEST`` of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.sources.scratch import written

STRETCH_BITS = 16
LONGEST = 1 << STRETCH_BITS
PLACE, STRETCH, UPPER = "__place", "__stretch", "__upper"
PARTITION_BITS = 33
"""Above these bits a place numbers its partition."""


def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """df with ``PLACE``, which ascends in the order of the columns ``order``."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(dealt.withColumn(PLACE, F.monotonically_increasing_id()), "ordered")


def in_stretches(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return in_order(df, order).withColumn(STRETCH, _stretch())


def _stretch() -> Column:
    return F.shiftright(PLACE, STRETCH_BITS)


def positions(placed: DataFrame, first: int, count: int | None) -> DataFrame:
    """Of rows in order those from position ``first`` on, ``count`` of them. Rows are counted by partition, so that a range of
    places, which the scan's statistics know, bounds what is read."""
    sizes = placed.groupBy(F.shiftright(PLACE, PARTITION_BITS).alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # one row a partition
    low = high = None
    passed = 0
    for r in sizes:
        start, passed = passed, passed + r.n
        if low is None and passed > first:
            low = (r.part << PARTITION_BITS) + first - start
        if count is not None and high is None and passed >= first + count:
            high = (r.part << PARTITION_BITS) + first + count - start
    if low is None or count == 0:
        return placed.where(F.lit(False))
    window = F.col(PLACE) >= low
    return placed.where(window if high is None else window & (F.col(PLACE) < high))


def led_by(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows with the columns of known that have their keys; null is a key like others."""
    own = known.withColumnsRenamed({k: f"__of_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
    return rows.join(own, same, "left").drop(*(f"__of_{k}" for k in keys))


def carried(summaries: DataFrame, lane: str, state: Sequence[str], combine: Callable[[tuple | None, tuple], tuple]) -> DataFrame:
    """(lane, ``STRETCH``, and before_... for each column of ``state``): what the lane's earlier stretches combine to, null at its first one.
    summaries has a row for each lane and stretch. ``combine`` is associative; its first argument is None at a lane's start."""
    kinds = {f.name: f.dataType.simpleString() for f in summaries.schema.fields}
    before = [f"before_{c}" for c in state]
    named = f"{lane} {kinds[lane]}, {STRETCH} long"
    out = ", ".join([named, *(f"{b} {kinds[c]}" for b, c in zip(before, state, strict=True))])

    def walk(rows: pd.DataFrame, led: bool = False) -> tuple[pd.DataFrame, tuple]:
        ordered = rows.sort_values(STRETCH)
        now = tuple(ordered.iloc[0][b] for b in before) if led and ordered.iloc[0]["__known"] else None
        told = []
        for r in ordered[list(state)].itertuples(index=False, name=None):
            told.append(now or (None,) * len(state))
            now = combine(now, r)
        made = pd.DataFrame({lane: ordered[lane].to_numpy(), STRETCH: ordered[STRETCH].to_numpy()})
        for k, b in enumerate(before):
            made[b] = pd.Series([t[k] for t in told], dtype=object)
        return made, now

    def total(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*key, *walk(rows)[1])], columns=[lane, STRETCH, *state])

    if summaries.count() <= LONGEST:
        return summaries.groupBy(lane).applyInPandas(lambda rows: walk(rows)[0], out)
    placed = in_order(summaries, [lane, STRETCH]).withColumn(UPPER, _stretch()).drop(PLACE)
    totals = placed.groupBy(lane, UPPER).applyInPandas(total, ", ".join([named, *(f"{c} {kinds[c]}" for c in state)]))
    upper = carried(totals, lane, state, combine).withColumnRenamed(STRETCH, UPPER)
    led = led_by(placed, upper, [lane, UPPER]).withColumn("__known", F.col(before[0]).isNotNull())
    return led.groupBy(lane, UPPER).applyInPandas(lambda rows: walk(rows, True)[0], out)
