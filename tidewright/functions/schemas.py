"""Schemas of the state tables, and bringing frames into them. ``seq`` orders rows as they were appended."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructType


def _table(*columns: tuple[str, str]) -> StructType:
    table = StructType()
    for name, kind in columns:
        table.add(name, kind)
    return table


#: The columns of the state tables, and ``seq``.
WORK_UNIT = _table(
    ("unit_id", "string"),
    ("row_id", "string"),
    ("field_name", "string"),
    ("input_text", "string"),
    ("output_column", "string"),
    ("model", "string"),
    ("step_name", "string"),
    ("prompt_version", "string"),
)
MANIFEST = _table(
    ("unit_id", "string"),
    ("row_id", "string"),
    ("field_name", "string"),
    ("output_column", "string"),
    ("model", "string"),
    ("step_name", "string"),
    ("prompt_version", "string"),
    ("input_hash", "string"),
)
PROGRESS = _table(
    ("unit_id", "string"),
    ("status", "string"),
    ("retry_count", "long"),
    ("last_error_type", "string"),
    ("last_error_message", "string"),
    ("updated_at", "string"),
    ("seq", "long"),
)
RESULT = _table(
    ("unit_id", "string"),
    ("row_id", "string"),
    ("output_column", "string"),
    ("status", "string"),
    ("parsed_output", "string"),
    ("output_value", "string"),
    ("raw_output", "string"),
    ("error_type", "string"),
    ("error_message", "string"),
    ("review_flag", "boolean"),
    ("review_reason", "string"),
    ("seq", "long"),
)
CHECKPOINT = _table(
    ("unit_id", "string"),
    ("row_id", "string"),
    ("output_column", "string"),
    ("status", "string"),
    ("output_value", "string"),
    ("seq", "long"),
)
DEBUG = _table(
    ("unit_id", "string"),
    ("row_id", "string"),
    ("field_name", "string"),
    ("input_text", "string"),
    ("output_column", "string"),
    ("request_group_id", "string"),
    ("request_group_size", "long"),
    ("request_attempt_count", "long"),
    ("key_alias", "string"),
    ("provider", "string"),
    ("model", "string"),
    ("status", "string"),
    ("review_flag", "boolean"),
    ("review_reason", "string"),
    ("error_type", "string"),
    ("error_message", "string"),
    ("rendered_prompt", "string"),
    ("raw_output", "string"),
    ("parsed_output", "string"),
    ("output_value", "string"),
    ("updated_at", "string"),
    ("seq", "long"),
)

#: Words read as booleans.
TRUE_WORDS = {"true", "1", "yes", "y"}
FALSE_WORDS = {"false", "0", "no", "n"}


def conform(df: DataFrame, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """df with exactly the schema's columns: missing ones null, extra ones but those to ``keep`` dropped, what cannot be cast null."""
    have = set(df.columns)
    own = [(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    return df.select(*own, *keep)


def coerce(value, kind):
    """A Python value as the schema's type; containers become JSON text."""
    if value is None:
        return None
    if isinstance(kind, LongType):
        return int(value)
    if isinstance(kind, BooleanType):
        word = str(value).strip().lower()
        return True if word in TRUE_WORDS else False if word in FALSE_WORDS else bool(value)
    if isinstance(value, dict | list):
        return json.dumps(value, ensure_ascii=False)
    return str(value)


def rows_to_frame(spark: SparkSession, rows: list[dict], schema: StructType) -> DataFrame:
    return spark.createDataFrame([tuple(coerce(r.get(f.name), f.dataType) for f in schema.fields) for r in rows], schema)


def append_all(frames: list[DataFrame], schema: StructType) -> DataFrame:
    """Union of frames that may differ in columns and types."""
    first, *rest = [conform(f, schema) for f in frames]
    for f in rest:
        first = first.unionByName(f)
    return first
