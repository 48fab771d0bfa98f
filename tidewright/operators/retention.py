"""Which artifacts may go. Names are rows; a plan is the rows to delete."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.text import final_family, run_of

#: The families of artifacts, longer names before those they begin with.
FAMILIES = ("manifest", "progress", "metadata", "results_snapshot", "results_checkpoint", "results_delta", "results", "partial_output", "traces", "permanent_review", "review", "pair_status")
KEEP = 3
KEEP_RUNS = 10


def in_family(name: Column, family: str) -> Column:
    """The family's name, followed by nothing, ``_`` or ``.``."""
    return (name == family) | name.startswith(f"{family}_") | name.startswith(f"{family}.")


def family_of(name: Column, families: Sequence[str] = FAMILIES) -> Column:
    """The longest family that fits, or null."""
    found = F.lit(None).cast("string")
    for f in sorted(families, key=len):
        found = F.when(in_family(name, f), f).otherwise(found)
    return found


def beyond_last(names: DataFrame, keep: Mapping[str, int] | None = None, default: int = KEEP, families: Sequence[str] = FAMILIES) -> DataFrame:
    """Of each family, all but the last by name."""
    kept = F.lit(default)
    for family, n in (keep or {}).items():
        kept = F.when(F.col("family") == family, n).otherwise(kept)
    own = names.withColumn("family", family_of(F.col("name"), families)).where("family IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("family").orderBy(F.desc("name")))
    return own.withColumn("place", place).where(F.col("place") > kept).select("name", "family")


def covered_deltas(deltas: DataFrame, checkpoints: DataFrame, keep_sets: int = KEEP) -> DataFrame:
    """Deltas that every kept checkpoint covers; none while there is no checkpoint. Both have ``name`` and ``seq``."""
    oldest = checkpoints.orderBy(F.desc("seq")).limit(max(keep_sets, 1)).agg(F.min("seq").alias("oldest"))
    return deltas.crossJoin(F.broadcast(oldest)).where("seq <= oldest").select("name", "seq")  # one row


def beyond_last_runs(names: DataFrame, keep: int = KEEP_RUNS) -> DataFrame:
    """Artifacts of all but the last runs."""
    own = names.withColumn("run", run_of(F.col("name"))).where("run IS NOT NULL")
    last = own.select("run").distinct().orderBy(F.desc("run")).limit(keep)
    return own.join(last, "run", "left_anti").select("name", "run")


def old_finals(names: DataFrame, output: str, current: Sequence[str] = (), keep: int = KEEP) -> DataFrame:
    """Final outputs of exactly this name and a time, but for the last and those of the current run."""
    stem = F.regexp_replace("name", r"\.parquet$", "")
    own = names.where((final_family(stem) == output) & (stem != output) & ~F.col("name").isin(*current))
    place = F.row_number().over(Window.partitionBy(final_family(stem)).orderBy(F.desc("name")))
    return own.withColumn("place", place).where(F.col("place") > keep).select("name")


def cleanup_plan(
    names: DataFrame,
    written: Sequence[str],
    mode: str = "standard",
    keep: Mapping[str, int] | None = None,
    keep_runs: int = KEEP_RUNS,
    families: Sequence[str] = FAMILIES,
    spared: Sequence[str] = ("results_delta",),
) -> DataFrame:
    """What to delete after a flush: only of families just written, or in ``debug`` mode whole runs. Families ``spared`` are
    pruned by what covers them instead."""
    if mode not in ("standard", "debug"):
        raise ValueError("mode is 'standard' or 'debug'")
    own = names.where(~family_of(F.col("name"), families).isin(*spared) | family_of(F.col("name"), families).isNull())
    if mode == "debug":
        return beyond_last_runs(own, keep_runs).select("name")
    return beyond_last(own, keep, families=families).where(F.col("family").isin(*written)).select("name")


def merged_settings(steps: Sequence[Mapping]) -> dict | None:
    """Retention of several steps as one: debug if any is, the most kept, flags if any."""
    if not steps:
        return None
    keeps = {k for s in steps for k in s if k.startswith("keep_last")}
    return {
        "artifact_retention_mode": "debug" if any(s.get("artifact_retention_mode") == "debug" for s in steps) else "standard",
        "cleanup_artifacts": any(s.get("cleanup_artifacts", True) for s in steps),
        **{k: max(s[k] for s in steps if k in s) for k in sorted(keeps)},
    }
