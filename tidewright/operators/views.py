"""Views of a step's state: released rows, pair status, and the source with its new columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.text import typed
from tidewright.operators.state import latest_results, merged

PER_FIELD = ("unit_id", "status", "retry_count", "last_error_type", "last_error_message")


def released_rows(units: DataFrame, progress: DataFrame, scope: str = "unit") -> DataFrame:
    """Row ids to show: ``unit`` asks for one success, ``row_complete`` for success of all."""
    if scope not in ("unit", "row_complete"):
        raise ValueError("scope is 'unit' or 'row_complete'")
    good = F.count_if(F.col("status") == "success")
    seen = units.select("unit_id", "row_id").join(merged(progress.select("unit_id", "status")), "unit_id", "left")
    counted = seen.groupBy("row_id").agg(good.alias("good"), F.count("*").alias("expected"))
    return counted.where("good > 0" if scope == "unit" else "good = expected").select("row_id")


def pair_status(units: DataFrame, progress: DataFrame, fields: Sequence[str], released: DataFrame | None = None) -> DataFrame:
    """One row per touched source row, with counts and each field's status, from a single aggregate."""
    seen = units.select("unit_id", "row_id", "field_name").join(merged(progress.select(*PER_FIELD)), "unit_id", "left")
    counts = {"success_unit_count": "success", "retryable_error_count": "retryable_error", "permanent_error_count": "permanent_error"}
    made = [F.count("*").alias("expected_unit_count"), F.count("status").alias("observed_unit_count"), *[F.count_if(F.col("status") == s).alias(n) for n, s in counts.items()]]
    # A unit without progress is expected but has no columns of its own.
    each = [F.max(F.when((F.col("field_name") == f) & F.col("status").isNotNull(), F.struct(*PER_FIELD))).alias(f"field_{k}") for k, f in enumerate(fields)]
    rows = seen.groupBy("row_id").agg(*made, *each).where("observed_unit_count > 0")
    wide = rows.select("row_id", "expected_unit_count", "observed_unit_count", *counts, *[F.col(f"field_{k}.{c}").alias(f"{f}__{c}") for k, f in enumerate(fields) for c in PER_FIELD])
    blocked = [F.when(F.coalesce(F.col(f"{f}__status") != "success", F.lit(True)), F.lit(f)) for f in fields]
    done, dead, asked = F.col("success_unit_count"), F.col("permanent_error_count"), F.col("expected_unit_count")
    derived = wide.withColumns({"row_success_complete": done == asked, "row_terminal_complete": done + dead == asked, "blocked_fields": F.concat_ws(",", *blocked)})
    if released is None:
        return derived.withColumn("released_for_partial_output", F.lit(False))
    flags = released.select("row_id").distinct().withColumn("shown", F.lit(True))
    return derived.join(merged(flags), "row_id", "left").withColumn("released_for_partial_output", F.coalesce("shown", F.lit(False))).drop("shown")


def merge_back(source: DataFrame, results: DataFrame, key: str, outputs: Sequence[str], dtypes: Mapping[str, str] | None = None, units: DataFrame | None = None) -> DataFrame:
    """source with the successful answers as columns; the key becomes text. ``units`` limits results to a step's own."""
    clash = set(outputs) & set(source.columns)
    if clash:
        raise ValueError(f"output columns {sorted(clash)} are in the source already")
    good = latest_results(results).where(F.col("status") == "success")
    if units is not None:
        good = good.join(merged(units.select("unit_id")), "unit_id", "left_semi")
    wide = good.groupBy("row_id").agg(*[F.max_by("output_value", F.when(F.col("output_column") == c, F.col("seq"))).alias(c) for c in outputs])
    kinds = dtypes or {}
    unknown = {c: t for c, t in kinds.items() if c in outputs}
    cast = wide.select(F.col("row_id").alias(key), *[(typed(F.col(c), unknown[c]) if c in unknown else F.col(c)).alias(c) for c in outputs])
    return source.withColumn(key, F.col(key).cast("string")).join(merged(cast), key, "left").select(*source.columns, *outputs)


def partial_output(source: DataFrame, results: DataFrame, key: str, outputs: Sequence[str], released: DataFrame, dtypes: Mapping[str, str] | None = None) -> DataFrame:
    """The released rows only, with their answers."""
    rows = source.join(merged(released.select(F.col("row_id").alias("__row"))), F.col(key).cast("string") == F.col("__row"), "left_semi")
    return merge_back(rows, results.join(merged(released.select("row_id")), "row_id", "left_semi").select(*results.columns), key, outputs, dtypes)


def outcome(units: DataFrame, results: DataFrame) -> DataFrame:
    """How many units are answered, and how many are left."""
    done = results.where(F.col("status") == "success").agg(F.count_distinct("unit_id").alias("done"))
    both = units.agg(F.count("*").alias("total")).crossJoin(done)  # one row each
    return both.select(F.least("done", "total").alias("processed_units"), F.greatest(F.col("total") - F.col("done"), F.lit(0)).alias("remaining_units"), F.col("total").alias("total_units"))


def run_metadata(units: DataFrame, progress: DataFrame, results: DataFrame, step: str, status: str, now: str) -> DataFrame:
    """One row on a run."""
    known = progress.agg(
        F.count_distinct(F.when(F.col("status").isin("success", "permanent_error"), F.col("unit_id"))).alias("completed_or_terminal_units"),
        F.count_distinct(F.when(F.col("status") == "permanent_error", F.col("unit_id"))).alias("permanent_error_units"),
    )
    useful = results.agg(F.count_distinct(F.when(F.col("status") == "success", F.col("unit_id"))).alias("completed_useful_units"))
    one = outcome(units, results).crossJoin(known).crossJoin(useful)  # one row each
    return one.select(F.lit(step).alias("step_name"), F.lit(status).alias("status"), F.col("processed_units").alias("processed_units_this_run"), "remaining_units", "total_units", "completed_useful_units", "completed_or_terminal_units", "permanent_error_units", F.lit(now).alias("updated_at"))
