"""A deterministic provider for queries and tests: answers depend on a unit's id and on how often it was asked."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from tidewright.operators.control import Pace
from tidewright.plans.settings import ModelStep, Runtime
from tidewright.plans.waves import run_step
from tidewright.sources.scratch import new_folder
from tidewright.sources.tables import Folder


class StubAdapter:
    """Answers with what the prompt says of each unit."""

    def execute_batch(self, requests, step):
        return [{"request_id": r["request_id"], "status": "success", "raw_output": r["prompt"], "error_type": None, "error_message": None, "provider": "stub", "model": step["model"]} for r in requests]


class StubHandler:
    """The n-th answer to a unit fails where the n-th digit of its id is 0, 1 or 2; else it is the text's length modulo 7."""

    def build_requests(self, units, step, context):
        asked = [{"unit_id": u["unit_id"], "attempt": int(u["retry_count"]) + 1, "length": len(u["input_text"])} for u in units]
        return [{"request_id": units[0]["unit_id"][:16], "prompt": json.dumps(asked)}]

    def parse_grouped_result(self, raw_output, request, step, context):
        out = []
        for u in json.loads(raw_output):
            bad = u["unit_id"][u["attempt"] - 1] in "012"
            value = None if bad else u["length"] % 7
            out.append({"unit_id": u["unit_id"], "status": "retryable_error" if bad else "success", "parsed_output": {"value": value}, "output_value": value, "error_type": "invalid_unit_output" if bad else None, "error_message": None})
        return out


def stub_step(runtime: Runtime | None = None, key: str = "n_nationkey", column: str = "n_name") -> ModelStep:
    own = runtime or Runtime(pace=Pace(initial_group_size=8))
    return ModelStep("names", key, {column: "label"}, "stub-1", StubAdapter, StubHandler, dtypes={"label": "Int64"}, runtime=own)


def run_resumed(spark: SparkSession, source: DataFrame, step: ModelStep | None = None) -> DataFrame:
    """One wave, then a second run that goes on from the log to the end."""
    folder, step = Folder(spark, new_folder(spark, "steps")), step or stub_step()
    run_step(source, step, folder, "20260101_000000", most_waves=1)
    return run_step(source, step, folder, "20260101_000100")
