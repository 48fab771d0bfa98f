"""State algebra: what is known of each unit from logs in which later rows replace earlier ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tidewright.functions.schemas import CHECKPOINT, DEBUG, PROGRESS, RESULT, append_all, conform
from tidewright.functions.text import primary_error

TERMINAL = ("success", "permanent_error")
#: Errors of a unit's answer that repeating may not mend.
ANSWER_ERRORS = ("invalid_score_output", "invalid_cue_output", "missing_prompt_unit_result", "semantic_validation_failed", "invalid_unit_output", "missing_required_field", "unknown_prompt_unit_id")

FROM_DELTA = "from_delta__"

#: What a message is given when retries end.
GIVEN_UP = "no usable answer, made permanent after"


def merged(rows: DataFrame) -> DataFrame:
    """rows as a side of a join that is dealt out and merged. State has a row for each unit, and its files are far smaller than its rows, so
    Spark would send each such side whole through the driver until it is large, many times a run."""
    return rows.hint("merge")


def latest(log: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The last row of each key. One aggregate, which combines before the shuffle; nulls in ``by`` come first."""
    rest = [c for c in log.columns if c not in keys]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("row"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in log.columns])


def latest_progress(log: DataFrame) -> DataFrame:
    return latest(log, ["unit_id"], ["updated_at", "seq"])


def latest_results(log: DataFrame) -> DataFrame:
    return latest(log, ["unit_id", "output_column"], ["seq"])


def latest_debug(log: DataFrame) -> DataFrame:
    return latest(log, ["unit_id"], ["seq"])


def success_ids(rows: DataFrame) -> DataFrame:
    return rows.where((F.col("status") == "success") & F.col("unit_id").isNotNull()).select("unit_id").distinct()


def reconcile(progress: DataFrame, results: DataFrame, now: str, seq: int) -> DataFrame:
    """Units with a successful result but no success in the progress get one."""
    missing = success_ids(results).join(merged(success_ids(progress)), "unit_id", "left_anti")
    made = missing.select("unit_id", F.lit("success").alias("status"), F.lit(0).cast("long").alias("retry_count"), F.lit(now).alias("updated_at"), F.lit(seq).cast("long").alias("seq"))
    return latest_progress(append_all([progress, made], PROGRESS))


def apply_retry_limit(progress: DataFrame, most: int) -> DataFrame:
    """Retryable answer errors that have been repeated ``most`` times become permanent."""
    if most < 0:
        return progress
    hit: Column = (F.col("status") == "retryable_error") & primary_error(F.col("last_error_type")).isin(*ANSWER_ERRORS) & (F.coalesce("retry_count", F.lit(0)) >= most)
    retries = F.coalesce("retry_count", F.lit(0)).cast("string")
    note = F.concat(F.lit(f" [{GIVEN_UP} "), retries, F.lit(f" retries, limit {most}]"))
    said = F.coalesce("last_error_message", F.lit(""))
    kind = F.when(F.col("last_error_type").contains("max_request_retries_exhausted"), F.col("last_error_type")).otherwise(F.concat("last_error_type", F.lit("|max_request_retries_exhausted")))
    told = F.when(said.contains(GIVEN_UP), said).otherwise(F.trim(F.concat(said, note)))
    changes = {"last_error_type": kind, "last_error_message": told, "status": F.lit("permanent_error")}
    return progress.withColumns({c: F.when(hit, new).otherwise(F.col(c)) for c, new in changes.items()})


def retry_counts(units: DataFrame, progress: DataFrame) -> DataFrame:
    """units with the retries so far."""
    return units.join(merged(progress.select("unit_id", "retry_count")), "unit_id", "left").withColumn("retry_count", F.coalesce("retry_count", F.lit(0).cast("long")))


def terminal(progress: DataFrame) -> DataFrame:
    return progress.where(F.col("status").isin(*TERMINAL))


def review_rows(debug: DataFrame) -> DataFrame:
    return debug.where((F.col("status") != "success") | F.col("review_flag"))


def permanent_review(debug: DataFrame, progress: DataFrame) -> DataFrame:
    """The latest trace of units that failed for good, without those that have succeeded since."""
    failed = latest_debug(conform(debug, DEBUG).where(F.col("status") == "permanent_error"))
    return failed.join(merged(success_ids(progress)), "unit_id", "left_anti").select(*failed.columns)


def checkpoint_rows(results: DataFrame) -> DataFrame:
    return conform(results.where(F.col("status") == "success"), CHECKPOINT)


def replay(checkpoint: DataFrame | None, covered: int, deltas: DataFrame) -> DataFrame:
    """Results from a checkpoint that covers rows up to ``covered``, and the deltas after it. Of a delta and a row of the checkpoint with the
    same ``seq`` the delta is the later one, in whatever order tasks meet them."""
    newer = deltas.where(F.col("seq") > covered)
    if checkpoint is None:
        return latest_results(append_all([newer], RESULT))
    both = append_all([rows.withColumn(FROM_DELTA, F.lit(late)) for rows, late in ((checkpoint, False), (newer, True))], StructType([*RESULT.fields, StructField(FROM_DELTA, BooleanType())]))
    return latest(both, ["unit_id", "output_column"], ["seq", FROM_DELTA]).drop(FROM_DELTA)


def status_counts(progress: DataFrame, units: DataFrame | None = None) -> DataFrame:
    """How many units have each of the three final statuses, zeros included; with ``units``, among these only."""
    of = progress if units is None else progress.join(merged(units.select("unit_id").distinct()), "unit_id", "left_semi")
    one = of.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("success", "retryable_error", "permanent_error")])
    return one.select(F.inline(F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("n")) for s in one.columns])))
