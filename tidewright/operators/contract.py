"""Contracts between what was asked and what was answered, over whole tables.

Both sides are counted by request and item before they meet in one full outer join, so an answer that is repeated any number of times is one row
there, and nothing is gathered by request.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.responses import ANSWER_STATUSES

#: What can be wrong, in the order in which it is told.
PROBLEMS = ("malformed", "unexpected", "repeated", "missing")


def malformed(answers: DataFrame, required: Sequence[str]) -> Column:
    """Whether an answer lacks a field or has a status that is none."""
    lacking = [F.col(c).isNull() for c in required] if set(required) <= set(answers.columns) else [F.lit(True)]
    wrong = ~F.coalesce(F.col("status").isin(*ANSWER_STATUSES), F.lit(False))
    for x in lacking:
        wrong = wrong | x
    return wrong


def breaches(asked: DataFrame, answers: DataFrame, keys: Sequence[str] = ("request_id", "unit_id"), required: Sequence[str] = ("unit_id",)) -> DataFrame:
    """(keys, ``asked``, ``answered`` and ``malformed`` counts, ``problems``) of each key that is not asked once and answered once and well. Null keys are
    keys like others: an answer without a key is unexpected."""
    counted = asked.groupBy(*keys).agg(F.count("*").alias("asked"))
    got = answers.withColumn("__wrong", malformed(answers, required)).groupBy(*keys).agg(F.count("*").alias("answered"), F.count_if("__wrong").alias("malformed"))
    same = None
    for k in keys:
        one = counted[k].eqNullSafe(got[k])
        same = one if same is None else same & one
    both = counted.join(got, same, "full_outer")
    n = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("asked", "answered", "malformed")}
    tests = {"malformed": n["malformed"] > 0, "unexpected": n["asked"] == 0, "repeated": n["answered"] > F.greatest(n["asked"], F.lit(1)), "missing": n["answered"] < n["asked"]}
    told = F.concat_ws(",", *[F.when(tests[p], F.lit(p)) for p in PROBLEMS])
    rows = both.select(*[F.coalesce(counted[k], got[k]).alias(k) for k in keys], *[c.alias(name) for name, c in n.items()], told.alias("problems"))
    return rows.where("problems != ''")


def broken_requests(found: DataFrame, key: str = "request_id") -> DataFrame:
    """Of breaches: each request with how many of its items have each problem. All units of such a request are asked again."""
    has = lambda p: F.count_if(F.array_contains(F.split("problems", ","), p))
    return found.groupBy(key).agg(*[has(p).alias(p) for p in PROBLEMS])
