"""Requests to a model, and the rows their answers make. A group of units is one request, made inside a task."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping, Sequence
from typing import Any, Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.schemas import DEBUG, PROGRESS, RESULT, conform
from tidewright.operators.state import apply_retry_limit

#: The contract of adapters and handlers.
ANSWER_STATUSES = ("success", "retryable_error", "permanent_error")
RESPONSE_KEYS = {"request_id", "status", "raw_output", "error_type", "error_message"}
PARSED_KEYS = {"unit_id", "status", "parsed_output", "output_value", "error_type", "error_message"}


class Adapter(Protocol):
    """Talks to a provider. A request is a dict with ``request_id`` and ``prompt``; the answer has ``RESPONSE_KEYS``."""

    def execute_batch(self, requests: list[dict], step: Mapping) -> list[dict]: ...


class TaskHandler(Protocol):
    """Writes prompts and reads answers; must be pure."""

    def build_requests(self, units: list[dict], step: Mapping, context: Mapping) -> list[dict]: ...

    def parse_grouped_result(self, raw_output: Any, request: dict, step: Mapping, context: Mapping) -> list[dict]: ...


def as_json(value):
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def as_text(value):
    return as_json(value) if value is None or isinstance(value, str | dict | list) else str(value)


def check_responses(responses: list[dict], requests: list[dict]) -> None:
    asked = [r["request_id"] for r in requests]
    for r in responses:
        if missing := RESPONSE_KEYS - r.keys():
            raise ValueError(f"a response lacks {sorted(missing)}")
        if r["status"] not in ANSWER_STATUSES:
            raise ValueError(f"a response has the status {r['status']!r}")
    if sorted(map(str, asked)) != sorted(str(r["request_id"]) for r in responses):
        raise ValueError("responses and requests do not match one to one")


def check_parsed(parsed: list[dict], unit_ids: list[str]) -> None:
    """Every unit of the group is answered once, with all keys and a final status."""
    for p in parsed:
        if missing := PARSED_KEYS - p.keys():
            raise ValueError(f"a parsed answer lacks {sorted(missing)}")
        if p["status"] not in ANSWER_STATUSES:
            raise ValueError(f"a parsed answer has the status {p['status']!r}")
    got = [p["unit_id"] for p in parsed]
    for what, ids in (("unexpected", set(got) - set(unit_ids)), ("repeated", {x for x in got if got.count(x) > 1}), ("missing", set(unit_ids) - set(got))):
        if ids:
            raise ValueError(f"{what} unit ids: {sorted(ids)[:5]}")


def answer_group(units: list[dict], adapter: Adapter, handler: TaskHandler, step: Mapping, context: Mapping, now: str) -> list[dict]:
    """A trace for each unit of a group, with ``retry_count`` and the ``outputs`` of successes as JSON. Failures of the request
    or of its parsing mark all units."""
    requests = handler.build_requests(units, step, context)
    if len(requests) != 1:
        raise ValueError(f"a group makes one request, not {len(requests)}")
    request = requests[0]
    base = {"request_group_id": request["request_id"], "request_group_size": len(units), "rendered_prompt": request["prompt"], "updated_at": now}

    def trace(unit: dict, response: Mapping, status: str, reason: str | None, flag: bool, kind, message, parsed=None, value=None, outputs=None) -> dict:
        own = {k: unit[k] for k in ("unit_id", "row_id", "field_name", "input_text", "output_column")}
        told = {k: response.get(k) for k in ("key_alias", "provider", "model")} | {"raw_output": as_json(response.get("raw_output")), "request_attempt_count": response.get("request_attempt_count", 1)}
        retries = int(unit["retry_count"]) + (status == "retryable_error")
        return own | base | told | {"status": status, "review_flag": flag, "review_reason": reason, "error_type": kind, "error_message": message, "parsed_output": as_json(parsed), "output_value": as_text(value), "retry_count": retries, "outputs": json.dumps(outputs or {})}

    response: Mapping = {}
    try:
        responses = adapter.execute_batch(requests, step)
        check_responses(responses, requests)
        response = responses[0]
    except Exception as e:  # a provider may fail in any way; its units are tried again
        response = {"status": "retryable_error", "error_type": "adapter_exception", "error_message": str(e)}
    if response["status"] != "success":
        return [trace(u, response, response["status"], "group_transport_failure", True, response.get("error_type"), response.get("error_message")) for u in units]
    try:
        parsed = handler.parse_grouped_result(response["raw_output"], request, step, context)
        check_parsed(parsed, [u["unit_id"] for u in units])
    except Exception as e:
        return [trace(u, response, "retryable_error", "group_parse_failure", True, "group_parse_exception", str(e)) for u in units]
    by_unit, rows = {p["unit_id"]: p for p in parsed}, []
    for u in units:
        p = by_unit[u["unit_id"]]
        good = p["status"] == "success"
        more = p.get("extra_outputs") or p.get("extra_output_values") or {}
        outputs = {u["output_column"]: as_text(p["output_value"]), **{c: as_text(v) for c, v in more.items()}} if good else {}
        reason = p.get("review_reason") or (None if good else "group_unit_non_success")
        rows.append(trace(u, response, p["status"], reason, bool(p.get("review_flag", False)) if good else True, p["error_type"], p["error_message"], p["parsed_output"], p["output_value"], outputs))
    return rows


def whole_groups(batches: Iterable[list[dict]]) -> Iterator[list[dict]]:
    """The units of each group, of batches in which groups follow one another and may reach over an end."""
    held: list[dict] = []
    for batch in batches:
        for unit in batch:
            if held and unit["group_id"] != held[0]["group_id"]:
                yield held
                held = []
            held.append(unit)
    if held:
        yield held


def limited(traces: DataFrame, most: int) -> DataFrame:
    """traces in which answer errors that have been repeated ``most`` times are permanent."""
    own = {"error_type": "last_error_type", "error_message": "last_error_message"}
    judged = apply_retry_limit(traces.withColumnsRenamed(own), most)
    return judged.withColumnsRenamed({new: old for old, new in own.items()})


def progress_of(traces: DataFrame, seq: int, keep: Sequence[str] = ()) -> DataFrame:
    """The traces as progress, with further columns to ``keep``."""
    told = {"last_error_type": F.col("error_type"), "last_error_message": F.col("error_message"), "seq": F.lit(seq)}
    return conform(traces.withColumns(told), PROGRESS, keep)


def results_of(traces: DataFrame, seq: int, keep: Sequence[str] = ()) -> DataFrame:
    """One row for each output of a success: its own column, and any extra ones."""
    outputs = F.from_json("outputs", "map<string,string>")
    good = traces.where(F.col("status") == "success").drop("output_column", "output_value", "seq")
    return conform(good.select("*", F.explode(outputs).alias("output_column", "output_value"), F.lit(seq).alias("seq")), RESULT, keep)


def debug_of(traces: DataFrame, seq: int) -> DataFrame:
    return conform(traces.withColumn("seq", F.lit(seq)), DEBUG)


