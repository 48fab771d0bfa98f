"""Whole runs: answers, resumption, storage, pipelines, streams."""

import json
import os
import shutil
import sys
import threading
import time
import uuid
from collections import Counter
from dataclasses import replace
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidewright.functions.schemas import RESULT, append_all, conform
from tidewright.operators import asking, control, responses, retention, state, units, views
from tidewright.operators.asking import Flush
from tidewright.operators.control import Pace
from tidewright.plans import pipeline, stub
from tidewright.plans.settings import ModelStep, Runtime
from tidewright.plans.snapshots import PLACE, Snapshot, bits_for, place
from tidewright.plans.waves import Cadence, Round, State, StepLog, live_figures, run_step
from tidewright.sources import artifact_log, tables
from tidewright.streaming.arrivals import process_arrivals

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import tests

UNIT = {"unit_id": "u1", "row_id": "1", "field_name": "x", "input_text": "t", "output_column": "o", "retry_count": 1}
OTHER = UNIT | {"unit_id": "u2", "row_id": "2"}


class Adapter:
    def __init__(self, **change):
        self.change = change

    def execute_batch(self, requests, step):
        if self.change.get("raises"):
            raise TimeoutError("too slow")
        return [{"request_id": r["request_id"], "status": "success", "raw_output": "raw", "error_type": None, "error_message": None} | self.change for r in requests]


class Handler:
    def __init__(self, *parsed, requests=1):
        self.parsed, self.requests = parsed, requests

    def build_requests(self, units, step, context):
        return [{"request_id": "r1", "prompt": "p"}] * self.requests

    def parse_grouped_result(self, raw, request, step, context):
        return list(self.parsed)


def answer(unit_id, status="success", value="v", **more):
    return {"unit_id": unit_id, "status": status, "parsed_output": {"v": value}, "output_value": value, "error_type": None, "error_message": None} | more


def ask(handler, adapter=None):
    return {r["unit_id"]: r for r in responses.answer_group([UNIT, OTHER], adapter or Adapter(), handler, {}, {}, "now")}


def test_answers_of_a_group():
    got = ask(Handler(answer("u1", value=True, extra_outputs={"e": [1]}), answer("u2", "retryable_error", error_type="invalid_unit_output")))
    assert (got["u1"]["status"], got["u1"]["retry_count"], got["u1"]["output_value"], json.loads(got["u1"]["outputs"])) == ("success", 1, "True", {"o": "True", "e": "[1]"})
    assert (got["u2"]["retry_count"], got["u2"]["review_flag"], got["u2"]["review_reason"], got["u2"]["outputs"]) == (2, True, "group_unit_non_success", "{}")
    assert got["u1"]["parsed_output"] == '{"v": true}'


@pytest.mark.parametrize("parsed", [[answer("u1")], [answer("u1"), answer("u1")], [answer("u1"), answer("u9")], [answer("u1"), {"unit_id": "u2"}], [answer("u1"), answer("u2", "pending")]])
def test_broken_answers_fail_the_group(parsed):
    got = ask(Handler(*parsed))
    assert {(r["status"], r["review_reason"], r["error_type"], r["retry_count"]) for r in got.values()} == {("retryable_error", "group_parse_failure", "group_parse_exception", 2)}


@pytest.mark.parametrize("change,kind,retries", [({"raises": True}, "adapter_exception", 2), ({"status": "permanent_error", "error_type": "bad_key"}, "bad_key", 1), ({"status": "odd"}, "adapter_exception", 2), ({"request_id": "r9"}, "adapter_exception", 2)])
def test_failed_requests_fail_the_group(change, kind, retries):
    got = ask(Handler(), Adapter(**change))
    assert {(r["review_reason"], r["error_type"], r["retry_count"]) for r in got.values()} == {("group_transport_failure", kind, retries)}


def test_a_group_is_one_request():
    with pytest.raises(ValueError, match="one request"):
        ask(Handler(requests=2))


def clock():
    now = [datetime(2026, 1, 1, tzinfo=UTC)]

    def tick():
        now[0] += timedelta(microseconds=1)
        return now[0]

    return tick


def names(spark):
    return spark.createDataFrame([(k, f"{'x' * (k % 9)}name") for k in range(40)], "n_nationkey long, n_name string")


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    folder = tables.Folder(spark, f"file://{tmp_path_factory.mktemp('whole')}")
    got = run_step(names(spark), stub.stub_step(), folder, "20260101_000000", clock())
    return folder, sorted(map(tuple, got.collect()))


def test_a_stopped_run_resumes_to_the_same_end(spark, whole, tmp_path):
    folder, step = tables.Folder(spark, f"file://{tmp_path}"), stub.stub_step(Runtime(pace=Pace(initial_group_size=3, max_group_size=5)))
    first = run_step(names(spark), step, folder, "20260101_000000", clock(), most_waves=1)
    assert first.where("label IS NOT NULL").count() < 40
    got = run_step(names(spark), step, folder, "20260101_000001")
    assert sorted(map(tuple, got.collect())) == whole[1]


def test_success_is_not_asked_again(spark, whole):
    folder, rows = whole
    before = len(tables.artifacts(tables.Folder(spark, f"{folder.path}/debug"), "traces"))
    again = run_step(names(spark), stub.stub_step(), folder, "20260101_000002", most_waves=1)
    assert sorted(map(tuple, again.collect())) == rows
    traces = tables.artifacts(tables.Folder(spark, f"{folder.path}/debug"), "traces")
    asked = spark.read.parquet(f"{folder.path}/debug/{max(traces)}") if len(traces) > before else spark.createDataFrame([], "unit_id string")
    assert asked.count() == sum(r[2] is None for r in rows)


def test_log_can_be_pruned_without_losing_results(spark, whole):
    folder, _ = whole
    log = StepLog(folder, "20260101_000009")
    results = tables.read_results(log.results).count()
    assert log.prune(keep={"traces": 0}) > 0  # the run itself keeps the last three of each family
    assert tables.read_results(log.results).count() == results
    assert all(len(tables.artifacts(log.state, f)) <= 3 for f in ("progress", "manifest"))


def test_folders(spark, tmp_path):
    folder = tables.connector("local", spark, f"file://{tmp_path}")
    sub = folder.ensure_subdir("a")
    sub.write_text("x.txt", "é")
    sub.download_object("x.txt", f"{tmp_path}/y.txt")
    sub.upload_object(f"{tmp_path}/y.txt", "z.txt")
    assert sub.list_objects() == ["x.txt", "z.txt"]
    assert tables.prompt_context(sub, "x.txt", notes=["z.txt"]) == {"template": "é", "schema_text": None, "schema": None, "notes": ["é"]}
    sub.delete_object("x.txt")
    assert sub.list_objects() == ["z.txt"] and tables.Folder(spark, f"file://{tmp_path}/none").list_objects() == []
    for bad in (lambda: tables.connector("ftp", spark, "x"), lambda: tables.loader("images")):
        with pytest.raises(ValueError):
            bad()


def source(spark, tmp_path, files):
    for k in range(files):
        names(spark).where(F.col("n_nationkey") % files == k).coalesce(1).write.parquet(f"file://{tmp_path}/in/f{k:02}.parquet")
    return f"file://{tmp_path}/in"


@pytest.mark.parametrize("mode,files", [("global", 1), ("batch", 2)])
def test_pipeline_modes(spark, whole, tmp_path, mode, files):
    src = source(spark, tmp_path, 3)
    steps = [pipeline.FunctionStep(lambda df, least: df.where(F.col("n_nationkey") >= least), {"least": 0}), stub.stub_step()]
    made = pipeline.run_pipeline(spark, pipeline.Pipeline("p", steps, mode, batch_size=2), src, f"file://{tmp_path}/out", "res", "20260101_000000")
    assert len(made) == files
    assert sorted(map(tuple, spark.read.parquet(*made).collect())) == whole[1]


def test_pipeline_rules(spark, tmp_path):
    for bad in ({"name": ""}, {"steps": []}, {"mode": "odd"}, {"data_type": "odd"}, {"columns": ["a", "*"]}):
        with pytest.raises(ValueError):
            pipeline.Pipeline(**({"name": "p", "steps": [stub.stub_step()]} | bad))
    for bad in ({"max_request_retries": -1}, {"release_scope": "x"}, {"checkpoint_every_waves": 0}, {"artifact_retention_mode": "x"}):
        with pytest.raises(ValueError):
            Runtime(**bad)
    with pytest.raises(ValueError):
        ModelStep("s", "k", {"a": "o", "b": "o"}, "m", stub.StubAdapter, stub.StubHandler)
    with pytest.raises(TypeError):
        pipeline.run_steps([pipeline.FunctionStep(lambda df: None)], spark.range(1), tables.Folder(spark, f"file://{tmp_path}"), "r")
    with pytest.raises(FileNotFoundError):
        pipeline.run_pipeline(spark, pipeline.single_task("t", lambda df: df), f"file://{tmp_path}/none", f"file://{tmp_path}/o", "o", "r")


def test_user_files(tmp_path):
    (tmp_path / "task.py").write_text("TASK = {'name': 't'}\ndef run(df):\n    return df\n")
    (tmp_path / "bad.py").write_text("x = 1\n")
    assert pipeline.load_pipeline(str(tmp_path / "task.py")).name == "t"
    with pytest.raises(ValueError):
        pipeline.load_pipeline(str(tmp_path / "bad.py"))


def test_stream_of_files(spark, whole, tmp_path):
    src = source(spark, tmp_path, 2)
    plan = pipeline.Pipeline("p", [stub.stub_step()])
    query = process_arrivals(spark, plan, f"{src}/*", names(spark).schema, f"file://{tmp_path}/out", f"file://{tmp_path}/check")
    query.awaitTermination()
    made = [f"file://{tmp_path}/out/{n}" for n in tables.Folder(spark, f"file://{tmp_path}/out").list_objects() if n.endswith(".parquet")]
    assert len(made) == 2 and sorted(map(tuple, spark.read.parquet(*made).collect())) == whole[1]


def test_families(spark):
    rows = ["results", "results_delta__run_20260101_000000__x.parquet", "results_old.parquet", "review.parquet", "permanent_review__run_x", "reviews", "odd"]
    got = {r["name"]: r.f for r in spark.createDataFrame([(n,) for n in rows], "name string").select("name", retention.family_of(F.col("name")).alias("f")).collect()}
    assert list(got[n] for n in rows) == ["results", "results_delta", "results", "review", "permanent_review", None, None]


def test_retention_plans(spark):
    frame = spark.createDataFrame([(f"{f}__run_20260101_00000{k}__{k}.parquet",) for f in ("traces", "review") for k in range(5)], "name string")
    assert sorted(r["name"][0] + r["name"][-9] for r in retention.cleanup_plan(frame, ["traces"]).collect()) == ["t0", "t1"]
    assert retention.cleanup_plan(frame, [], "debug", keep_runs=4).count() == 2
    finals = spark.createDataFrame([(n,) for n in [*(f"out_2026010{k}_000000.parquet" for k in range(1, 6)), "out_other_20260101_000000.parquet", "out.parquet"]], "name string")
    assert sorted(r["name"] for r in retention.old_finals(finals, "out", ["out_20260101_000000.parquet"]).collect()) == ["out_20260102_000000.parquet"]
    deltas = spark.createDataFrame([(f"d{k}", k) for k in range(6)], "name string, seq long")
    saved = spark.createDataFrame([("c2", 2), ("c4", 4)], "name string, seq long")
    assert sorted(r["name"] for r in retention.covered_deltas(deltas, saved, 1).collect()) == ["d0", "d1", "d2", "d3", "d4"]
    assert retention.covered_deltas(deltas, saved.where("false"), 1).count() == 0
    assert retention.merged_settings([]) is None
    assert retention.merged_settings([{"keep_last_progress": 2}, {"keep_last_progress": 5, "artifact_retention_mode": "debug"}]) == {"artifact_retention_mode": "debug", "cleanup_artifacts": True, "keep_last_progress": 5}


BOUNDED = Runtime(pace=Pace(initial_group_size=2), units_per_wave=12, lanes=2, checkpoint_every_waves=2, cleanup_artifacts=False)


def asked_of(log, run):
    names = [n for n in tables.artifacts(log.debug, "traces") if run in n]
    return log.spark.read.parquet(*[f"{log.debug.path}/{n}" for n in names])


def test_waves_are_bounded_and_a_failure_after_the_answers_loses_none(spark, whole, tmp_path, monkeypatch):
    folder, step = tables.Folder(spark, f"file://{tmp_path}"), stub.stub_step(BOUNDED)
    limited, calls = responses.limited, []

    def failing(traces, most):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("the driver is lost in the third wave")
        return limited(traces, most)

    monkeypatch.setattr(responses, "limited", failing)
    with pytest.raises(OSError):
        run_step(names(spark), step, folder, "20260101_000000", clock())
    monkeypatch.setattr(responses, "limited", limited)
    log = StepLog(folder, "20260101_000001")
    waves = [spark.read.parquet(f"{log.debug.path}/{n}").count() for n in tables.artifacts(log.debug, "traces")]
    assert len(waves) == 2 and waves[0] <= 12 and all(0 < w < 40 for w in waves)
    (left,) = log.left_over()
    third = asking.answers(spark, f"{log.debug.path}/{left}").where("status = 'success'").select("unit_id").collect()
    saved = {r.unit_id for r in tables.read_results(log.results).collect()} | {r.unit_id for r in third}
    got = run_step(names(spark), step, folder, "20260101_000001", lambda: datetime(2026, 1, 2, tzinfo=UTC) + timedelta(microseconds=next(TICKS)))
    assert sorted(map(tuple, got.collect())) == whole[1] and not log.left_over()
    replayed = {r.unit_id for r in third}
    later = [r.unit_id for r in asked_of(log, "20260101_000001").select("unit_id").collect() if r.unit_id not in replayed]
    assert third and not set(later) & saved


TICKS = iter(range(1, 10**6))


class Counting(stub.StubAdapter):
    """Leaves a file for each request, waits, and kills its worker once where it is told to."""

    def __init__(self, folder, wait=0.0, kill_at=None):
        self.folder, self.wait, self.kill_at, self.n = Path(folder), wait, kill_at, 0

    def execute_batch(self, requests, step):
        self.n += 1
        if self.n == self.kill_at and not (self.folder / "killed").exists():
            (self.folder / "killed").touch()
            os._exit(1)
        for u in json.loads(requests[0]["prompt"]):
            (self.folder / f"{u['unit_id']}-{u['attempt']}-{uuid.uuid4().hex}").touch()
        time.sleep(self.wait)
        return super().execute_batch(requests, step)


def asked_units(folder):
    return Counter(p.name.rsplit("-", 1)[0] for p in Path(folder).iterdir() if p.name != "killed")


def counting_step(folder, runtime, **more):
    return replace(stub.stub_step(runtime), make_adapter=lambda: Counting(str(folder), **more))


def test_a_round_is_read_to_its_end_however_often_units_are_put_back(spark, tmp_path):
    log = StepLog(tables.Folder(spark, f"file://{tmp_path}"), "20260101_000000", clock())
    todo = units.work_units(names(spark), "n_nationkey", {"n_name": "label"}, "names", "stub-1").withColumn(PLACE, place(F.col("row_id")))
    left = Round(log, todo.select("unit_id", PLACE), 10, todo)
    for _ in range(4):
        left.take(10)
        left.put_back(todo.where("false"))
        log.prune(written=tuple(log.newest))
    seen = []
    while left.left():
        seen += [r.unit_id for r in left.take(10)[0].collect()]
    assert sorted(seen) == sorted(r.unit_id for r in todo.collect()) and len(seen) == 40


def test_a_killed_task_loses_one_flush_at_most(spark, whole, tmp_path):
    (tmp_path / "asked").mkdir()
    runtime = Runtime(pace=Pace(initial_group_size=2, max_group_size=2), lanes=1, units_per_wave=40, flush=Flush(units=4, groups=2))
    step, folder = counting_step(tmp_path / "asked", runtime, kill_at=8), tables.Folder(spark, f"file://{tmp_path}/step")
    with pytest.raises(Exception, match="crashed|exited|failure"):
        run_step(names(spark), step, folder, "20260101_000000")
    got = run_step(names(spark), step, folder, "20260101_000001")
    assert sorted(map(tuple, got.collect())) == whole[1] and (tmp_path / "asked/killed").exists()
    assert 1 <= sum(n > 1 for n in asked_units(tmp_path / "asked").values()) <= 4 and max(asked_units(tmp_path / "asked").values()) == 2


def test_another_attempt_of_a_task_asks_only_the_rest(tmp_path):
    units = [UNIT | {"unit_id": f"{k:04x}", "input_text": "t", "retry_count": 0} for k in range(3)]
    rows = responses.answer_group(units, stub.StubAdapter(), stub.StubHandler(), {"model": "m"}, {}, "now")
    first = asking.TaskFiles(f"file://{tmp_path}", 7, 0)
    first.save(rows[:2])
    second = asking.TaskFiles(f"file://{tmp_path}", 7, 1)
    assert second.answered == {"0000", "0001"} and second.counts == first.counts and second.counts["units"] == 2
    assert not asking.TaskFiles(f"file://{tmp_path}", 8, 0).answered


def test_a_slow_provider_saves_first_answers_in_time_and_stops_at_the_limits(spark, whole, tmp_path):
    (tmp_path / "asked").mkdir()
    runtime = Runtime(pace=Pace(initial_group_size=1, max_group_size=1), lanes=2, units_per_wave=40, seconds_per_wave=4, flush=Flush(units=100, groups=100, seconds=0.5), soft_time_limit_seconds=9)
    step, folder = counting_step(tmp_path / "asked", runtime, wait=0.4), f"file://{tmp_path}/step"
    seen, stop = [], threading.Event()

    def watch():
        while not stop.wait(0.3):
            told = live_figures(spark, folder)
            if told and told["units"]:
                seen.append((time.time(), told["units"]))

    thread = threading.Thread(target=watch)
    thread.start()
    began = time.time()
    got = run_step(names(spark), step, tables.Folder(spark, folder), "20260101_000000")
    stop.set()
    thread.join()
    asked = asked_units(tmp_path / "asked")
    assert time.time() - began < 60 and 0 < sum(asked.values()) < 40 and seen
    log = StepLog(tables.Folder(spark, folder), "x")
    sizes = [spark.read.parquet(f"{log.debug.path}/{n}").count() for n in tables.artifacts(log.debug, "traces")]
    assert sizes[0] <= 8 and sum(sizes) == sum(asked.values())
    assert got.where("label IS NOT NULL").count() == tables.read_results(log.results).count()
    resumed = run_step(names(spark), stub.stub_step(), tables.Folder(spark, folder), "20260101_000001")
    assert sorted(map(tuple, resumed.collect())) == whole[1]


def test_figures_of_tasks_are_those_of_their_answers(spark, tmp_path):
    todo = units.work_units(names(spark), "n_nationkey", {"n_name": "label"}, "names", "m")
    groups = control.grouped(todo.withColumn("retry_count", F.lit(0).cast("long")), 3)
    spark.dataSource.register(asking.answering("answers_test", stub.StubAdapter, stub.StubHandler, {"model": "m"}, {}))
    asking.ask(groups, "answers_test", f"file://{tmp_path}", "now", time.time() + 60, 4, Flush(units=5))
    told, got = asking.figures(spark, f"file://{tmp_path}"), asking.answers(spark, f"file://{tmp_path}").collect()
    assert told["units"] == len(got) == 40 and told["unasked_units"] == 0 and told["failed_units"] == sum(r.status != "success" for r in got) > 0
    assert told["requests"] == len({r.request_group_id for r in got}) and told["files"] > 4 and told["transport_failures"] == 0
    asking.ask(groups, "answers_test", f"file://{tmp_path}/late", "now", time.time() - 1, 4)
    assert asking.figures(spark, f"file://{tmp_path}/late")["unasked_units"] == 40


def test_a_batch_of_a_stream_asks_in_the_session_of_its_groups(spark, tmp_path):
    names(spark).coalesce(1).write.parquet(f"{tmp_path}/in")
    todo = units.work_units(names(spark), "n_nationkey", {"n_name": "label"}, "names", "m")
    groups = control.grouped(todo.withColumn("retry_count", F.lit(0).cast("long")), 3)

    def handle(batch, epoch):
        spark.dataSource.register(asking.answering("answers_streamed", stub.StubAdapter, stub.StubHandler, {"model": "m"}, {}))
        asking.ask(groups, "answers_streamed", f"file://{tmp_path}/wave", "now", time.time() + 60, 4)

    stream = spark.readStream.schema(names(spark).schema).parquet(f"{tmp_path}/in").writeStream.foreachBatch(handle)
    stream.option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
    assert asking.answers(spark, f"file://{tmp_path}/wave").count() == 40


def test_results_of_a_run_are_read_after_its_last_cleanup(spark, tmp_path):
    log = StepLog(tables.Folder(spark, f"file://{tmp_path}"), "20260101_000000", clock())
    todo = units.work_units(names(spark), "n_nationkey", {"n_name": "label"}, "names", "stub-1").withColumn(PLACE, place(F.col("row_id")))
    rows = conform(spark.createDataFrame([("u1", "1", "label", "success", "3", 0)], "unit_id string, row_id string, output_column string, status string, output_value string, seq long"), RESULT)
    for family in ("results_delta", *["results_checkpoint"] * 3):
        tables.write_artifact(log.results, rows if family == "results_delta" else state.checkpoint_rows(rows), family, log.run, log.stamp())
    got = State(stub.stub_step(), log, names(spark), todo).end()
    assert not tables.artifacts(log.results, "results_delta") and [r.output_value for r in got.collect()] == ["3"]


def test_saves_write_only_the_buckets_that_changed(spark, whole, tmp_path):
    many = Runtime(pace=Pace(initial_group_size=2, max_group_size=2), units_per_wave=16, lanes=1, checkpoint_every_waves=1, views_every_waves=2, units_per_bucket=4, cleanup_artifacts=False, keep_last={})
    folder, step = tables.Folder(spark, f"file://{tmp_path}"), stub.stub_step(many)
    run_step(names(spark), step, folder, "20260101_000000", most_waves=3)
    log = StepLog(folder, "x")
    held = State(step, log, names(spark), spark.read.parquet(f"{log.state.path}/{max(tables.artifacts(log.state, 'units'))}"))
    assert held.bits == 4
    got = run_step(names(spark), step, folder, "20260101_000001")
    assert sorted(map(tuple, got.collect())) == whole[1]
    # As the whole log has it.
    deltas = [conform(spark.read.parquet(f"{log.results.path}/{n}"), RESULT) for n in tables.artifacts(log.results, "results_delta")]
    wanted = {(r.unit_id, r.output_value) for r in state.latest_results(append_all(deltas, RESULT)).collect()}
    assert {(r.unit_id, r.output_value) for r in tables.read_results(log.results).collect()} == wanted
    todo, progress = held.todo, tables.read_progress(log.state)
    full = views.pair_status(todo, progress, list(step.outputs), views.released_rows(todo, progress))
    view = spark.read.parquet(f"{log.state.path}/{max(tables.artifacts(log.state, 'pair_status'))}")
    assert sorted(map(tuple, view.select(*full.columns).collect())) == sorted(map(tuple, full.collect()))
    partial = spark.read.parquet(f"{log.results.path}/{max(tables.artifacts(log.results, 'partial_output'))}")
    assert sorted(map(tuple, partial.collect())) == [r for r in whole[1] if r[2] is not None]


@pytest.mark.parametrize("rest", [["x"], ["x", "results_checkpoint"], ["x", "results_delta"]])
def test_the_log_as_a_data_source(spark, whole, tmp_path, rest, monkeypatch):
    """Of a real run, and without its checkpoints or deltas; covered deltas are in no partition."""
    folder = tables.Folder(spark, f"file://{tmp_path}")
    shutil.copytree(f"{whole[0].path.removeprefix('file://')}/results", tmp_path / "results", ignore=lambda _, names: [n for n in names if n.startswith(rest[-1])])
    results = folder.ensure_subdir("results")
    pick = lambda df: sorted((r.unit_id, r.output_column, r.output_value, r.seq) for r in df.collect())
    assert pick(artifact_log.read_log(spark, results.uri(""))) == pick(tables.read_results(results))
    parts = [p for x in artifact_log.LogReader({"path": results.uri("")}, RESULT).partitions() for p in x.paths]
    assert rest[-1] == "results_checkpoint" or not any("results_delta" in p for p in parts)


def test_an_empty_log_as_a_data_source(spark, tmp_path):
    assert artifact_log.read_log(spark, f"file://{tmp_path}").count() == 0


def test_the_cost_of_a_save_grows_with_what_changed(spark, tmp_path):
    log = StepLog(tables.Folder(spark, f"file://{tmp_path}"), "20260101_000000", clock())
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("unit_id"), F.lit("success").alias("status")).withColumn(PLACE, place(F.col("unit_id")))
    table = Snapshot(log, log.state, "progress", ["unit_id"], bits_for(20_000, 1000))
    table.write_whole(rows)
    some = rows.where(F.col(PLACE) < 1 << 15).withColumn("status", F.lit("permanent_error"))
    hit = table.merge(some, 1)
    part = spark.read.parquet(f"{log.state.path}/{log.newest['progress_part']}")
    assert len(hit) == 1 and part.count() == rows.where(F.col(PLACE) < 1 << 15).count() < 1000
    table.merge(rows.where(F.col(PLACE) >= (1 << 20) - 9000).limit(0), 2)
    table.merge(rows.where((F.col(PLACE) >= 1 << 16) & (F.col(PLACE) < 1 << 17)).where("unit_id < '5'").withColumn("status", F.lit("retryable_error")), 3)
    paths, covered = tables.newest_snapshot(log.state, "progress")
    got = {r.unit_id: r.status for r in spark.read.parquet(*paths).collect()}
    want = {r.unit_id: "permanent_error" if r[PLACE] < 1 << 15 else "retryable_error" if 1 << 16 <= r[PLACE] < 1 << 17 and r.unit_id < "5" else "success" for r in rows.collect()}
    assert covered == 3 and got == want and table.totals() == dict(Counter(want.values()))
    gone = rows.where(F.col(PLACE) < 1 << 16)
    table.merge(rows.limit(0), 4, gone)
    assert table.read().count() == 20_000 - gone.count() and sum(table.totals().values()) == 20_000 - gone.count()
    table.finish()
    assert table.read().count() == 20_000 - gone.count() and not [n for n in log.state.list_objects() if "_part" in n or "_buckets" in n]


def test_a_run_writes_reviews_and_applies_retention(spark, tmp_path):
    folder = tables.Folder(spark, f"file://{tmp_path}")
    keep = Runtime(pace=Pace(initial_group_size=8), max_request_retries=0, units_per_wave=12, checkpoint_every_waves=1, keep_last={"traces": 2})
    run_step(names(spark), stub.stub_step(keep), folder, "20260101_000000")
    log = StepLog(folder, "20260101_000001")
    failed = tables.read_progress(log.state).where("status = 'permanent_error'").count()
    assert failed > 0 and tables.read_permanent_review(log.debug).count() == failed
    review = spark.read.parquet(f"{log.debug.path}/{max(tables.artifacts(log.debug, 'review'))}")
    assert review.where("status = 'success' AND NOT review_flag").count() == 0
    assert len(tables.artifacts(log.debug, "traces")) == 2 and len(tables.artifacts(log.state, "progress")) == 2
    assert tables.read_progress(log.state).count() == 40


def test_a_task_has_one_adapter_for_all_its_groups(spark, tmp_path):
    units = [UNIT | {"unit_id": f"{k:04x}", "input_text": "t" * 9, "group_id": f"g{k // 3}", "retry_count": 0} for k in range(60)]
    made = str(tmp_path / "made")
    Path(made).mkdir()

    def counted():
        Path(made, uuid.uuid4().hex).touch()
        return stub.StubAdapter()

    spark.dataSource.register(asking.answering("answers_counted", counted, stub.StubHandler, {"model": "m"}, {}))
    asking.ask(spark.createDataFrame(units), "answers_counted", f"file://{tmp_path}/wave", "now", time.time() + 60, 4)
    got = asking.answers(spark, f"file://{tmp_path}/wave")
    assert sorted(r.unit_id for r in got.collect()) == [u["unit_id"] for u in units]
    assert len(list(Path(made).iterdir())) <= 4


def test_groups_reach_over_batches():
    batches = [[{"group_id": c} for c in ids] for ids in ("aab", "b", "bcc", "c")]
    assert ["".join(u["group_id"] for u in g) for g in responses.whole_groups(iter(batches))] == ["aa", "bbb", "ccc"]
    assert list(responses.whole_groups(iter([]))) == []


def test_cadence():
    now = [0.0]
    due = Cadence(3, 10, lambda: now[0])
    assert [due.due() for _ in range(4)] == [False, False, True, False]
    now[0] = 10.0
    assert due.due() and not due.due()


def test_older_results_are_read(spark, tmp_path):
    folder = tables.Folder(spark, f"file://{tmp_path}")
    row = lambda unit, value: spark.createDataFrame([(unit, "o", "success", value)], "unit_id string, output_column string, status string, output_value string")
    row("a", "1").write.parquet(f"file://{tmp_path}/results_20250101.parquet")
    row("b", "2").withColumn("odd", F.lit(1)).write.parquet(f"file://{tmp_path}/results_20250102.parquet")
    assert sorted((r.unit_id, r.output_value) for r in tables.read_results(folder).collect()) == [("a", "1"), ("b", "2")]
    row("a", "3").write.parquet(f"file://{tmp_path}/results_snapshot_20250103.parquet")
    assert [(r.unit_id, r.output_value) for r in tables.read_results(folder).collect()] == [("a", "3")]


def test_units_wait_without_their_texts(spark, tmp_path):
    folder = tables.Folder(spark, f"file://{tmp_path}")
    run_step(names(spark), stub.stub_step(Runtime(pace=Pace(initial_group_size=8), cleanup_artifacts=False)), folder, "20260101_000000")
    log = StepLog(folder, "x")
    waiting = tables.artifacts(log.state, "waiting")
    assert len(waiting) > 1  # of the units, and of those that failed
    assert all("input_text" not in spark.read.parquet(f"{log.state.path}/{n}").columns for n in waiting)
    assert "again" not in log.state.list_objects()
