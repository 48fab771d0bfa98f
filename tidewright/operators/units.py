"""Work units: one for each row and input column that holds text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.schemas import MANIFEST, WORK_UNIT
from tidewright.functions.text import hash_parts, strip
from tidewright.operators.state import merged
from tidewright.operators.stretches import in_order, positions


def row_window(source: DataFrame, key: str | Sequence[str], offset: int = 0, limit: int | None = None) -> DataFrame:
    """Rows from ``offset`` on, in the order of the key, which must be unique. The order is written once, by ranges of the key, and of it
    only the ranges that the window covers are read again."""
    if offset < 0 or (limit is not None and limit < 0):
        raise ValueError("offset and limit cannot be negative")
    if not offset and limit is None:
        return source
    return positions(in_order(source, [key] if isinstance(key, str) else list(key)), offset, limit).select(*source.columns)


def require_unique_keys(source: DataFrame, key: str) -> None:
    """Null and repeated keys would attach answers to the wrong rows."""
    bad = source.groupBy(key).agg(F.count("*").alias("n")).where(F.col(key).isNull() | (F.col("n") > 1)).limit(5).collect()
    if bad:
        raise ValueError(f"{key} is null or repeated: {[(r[0], r['n']) for r in bad]}")


def work_units(source: DataFrame, key: str, outputs: Mapping[str, str], step: str, model: str, prompt_version: str = "v1") -> DataFrame:
    """outputs: input column -> output column. Null and blank inputs make no unit; the id does not depend on the text."""
    rows = source.select(F.coalesce(F.col(key).cast("string"), F.lit("None")).alias("row_id"), *[F.col(c).cast("string").alias(f"in_{k}") for k, c in enumerate(outputs)])
    inputs = [F.struct(F.lit(c).alias("field_name"), F.lit(out).alias("output_column"), strip(F.col(f"in_{k}")).alias("input_text")) for k, (c, out) in enumerate(outputs.items())]
    units = rows.select("row_id", F.inline(F.array(*inputs))).where(F.col("input_text") != "")
    named = units.withColumns({"step_name": F.lit(step), "model": F.lit(model), "prompt_version": F.lit(prompt_version)})
    return named.withColumn("unit_id", hash_parts(*map(F.col, ("step_name", "row_id", "field_name", "output_column", "model", "prompt_version")))).select(*WORK_UNIT.names)


def manifest(units: DataFrame) -> DataFrame:
    return units.withColumn("input_hash", F.sha2("input_text", 256)).select(*MANIFEST.names)


def pending(units: DataFrame, progress: DataFrame) -> DataFrame:
    """Units whose latest status is not success; permanent errors are tried again by a later run."""
    return units.join(merged(progress.where(F.col("status") == "success").select("unit_id")), "unit_id", "left_anti").select(*units.columns)


def field_list(spec) -> Sequence[str]:
    """The columns a step asks for; empty for all of them."""
    everything = (None, "*", "all", "ALL")
    if spec in everything or (isinstance(spec, list | tuple) and len(spec) == 1 and spec[0] in everything):
        return []
    if not isinstance(spec, list | tuple) or not all(isinstance(c, str) for c in spec):
        raise ValueError("columns are a list of names, or '*' for all")
    if any(c in everything for c in spec):
        raise ValueError("'*' stands alone")
    return list(spec)
