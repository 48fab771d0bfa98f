"""Scalar functions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The code points that Python takes for white space.
SPACE_POINTS = (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
SPACE = "".join(map(chr, SPACE_POINTS))


def strip(text: Column) -> Column:
    """Without white space at both ends, as Python's ``str.strip`` has it."""
    return F.btrim(text, F.lit(SPACE))


def hash_parts(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("||", *parts), 256)


def primary_error(error_type: Column) -> Column:
    return F.substring_index(error_type, "|", 1)


def safe_name(name: Column) -> Column:
    return F.regexp_replace(name, r"[^\p{L}\p{N}_-]", "_")


def run_of(artifact: Column) -> Column:
    """The run id in an artifact's name, null without one."""
    return F.nullif(F.regexp_extract(artifact, r"__run_(\d{8}_\d{6})__", 1), F.lit(""))


def final_family(output: Column) -> Column:
    """A final output's name without the time it ends in."""
    return F.regexp_replace(output, r"_\d{8}_\d{6}$", "")


def typed(value: Column, dtype: str) -> Column:
    """Strict cast to one of the four types an output column can have."""
    kinds = {"Int64": "bigint", "Int32": "int", "Float64": "double", "Utf8": "string"}
    if dtype not in kinds:
        raise ValueError(f"output type {dtype!r} is none of {sorted(kinds)}")
    return value.cast(kinds[dtype])
