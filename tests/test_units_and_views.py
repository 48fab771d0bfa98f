"""Hand-made cases of units, state and views."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tidewright.functions.schemas import PROGRESS, RESULT, append_all, conform, rows_to_frame
from tidewright.functions.text import SPACE, strip, typed
from tidewright.operators import state, units, views
from tidewright.plans import queries


def test_strip_is_pythons(spark):
    texts = [SPACE + "a b" + SPACE, "​x", SPACE, "", "plain"]
    got = [r.s for r in spark.createDataFrame([(t,) for t in texts], "t string").select(strip(F.col("t")).alias("s")).collect()]
    assert got == [t.strip() for t in texts]


def test_unit_ids_and_blank_inputs(spark):
    source = spark.createDataFrame([(1, " a ", None), (2, " ", "b"), (None, "c", "")], "k long, x string, y string")
    got = {(r.row_id, r.field_name): r for r in units.work_units(source, "k", {"x": "ox", "y": "oy"}, "s", "m").collect()}
    assert set(got) == {("1", "x"), ("2", "y"), ("None", "x")}
    assert got["1", "x"].input_text == "a"
    assert got["1", "x"].unit_id == hashlib.sha256(b"s||1||x||ox||m||v1").hexdigest()


def test_a_far_window_is_the_same_in_whatever_order_rows_come(spark, tmp_path):
    rows = [(k // 40, 1, float(k * 7 % 40)) for k in range(1000)]
    for name, some in (("up", sorted(rows)), ("down", sorted(rows, reverse=True))):
        spark.createDataFrame(some, "l_orderkey long, l_linenumber int, l_quantity double").coalesce(1).write.parquet(f"{tmp_path}/{name}/lineitem.parquet")
        got = [tuple(r) for r in queries.row_window_far(spark, f"{tmp_path}/{name}").collect()]
        assert sorted(got) == sorted(rows)[900:]
    few = [(1, 1, float(k)) for k in range(700)]
    spark.createDataFrame(few[::-1], "l_orderkey long, l_linenumber int, l_quantity double").coalesce(1).write.parquet(f"{tmp_path}/tied/lineitem.parquet")
    assert sorted(tuple(r) for r in queries.row_window_far(spark, f"{tmp_path}/tied").collect()) == few[630:]


def test_keys_must_be_unique(spark):
    for rows in ([(1,), (1,)], [(None,)]):
        with pytest.raises(ValueError, match="null or repeated"):
            units.require_unique_keys(spark.createDataFrame(rows, "k long"), "k")


def test_row_window_bounds(spark):
    source = spark.range(5)
    assert [r.id for r in units.row_window(source, "id", 3, 10).collect()] == [3, 4]
    assert units.row_window(source, "id", 0, 0).count() == 0 and units.row_window(source, "id", 9).count() == 0
    with pytest.raises(ValueError):
        units.row_window(source, "id", -1)


@pytest.mark.parametrize("spec,want", [(None, []), ("*", []), ("ALL", []), (["all"], []), (["a", "b"], ["a", "b"])])
def test_field_list(spec, want):
    assert units.field_list(spec) == want


@pytest.mark.parametrize("spec", [["a", "*"], [1], 5, "a"])
def test_bad_field_list(spec):
    with pytest.raises(ValueError):
        units.field_list(spec)


def progress(spark, *rows):
    return rows_to_frame(spark, [dict(zip(PROGRESS.names, r, strict=True)) for r in rows], PROGRESS)


def test_equal_times_go_by_seq(spark):
    log = progress(spark, ("u", "success", 0, None, None, "t", 1), ("u", "retryable_error", 1, "e", "m", "t", 2), ("v", "success", 0, None, None, None, 5), ("v", "pending", 0, None, None, "a", 1))
    assert {r.unit_id: r.status for r in state.latest_progress(log).collect()} == {"u": "retryable_error", "v": "pending"}


def test_retry_limit(spark):
    log = progress(spark, ("a", "retryable_error", 3, "invalid_unit_output|x", "m", "t", 1), ("b", "retryable_error", 9, "rate_limit", "m", "t", 1), ("c", "retryable_error", 2, "invalid_unit_output", "m", "t", 1), ("d", "success", 3, None, None, "t", 1), ("e", "retryable_error", 3, "missing_required_field", None, "t", 1))
    got = {r.unit_id: r for r in state.apply_retry_limit(log, 3).collect()}
    assert [got[k].status for k in "abcde"] == ["permanent_error", "retryable_error", "retryable_error", "success", "permanent_error"]
    assert got["a"].last_error_type == "invalid_unit_output|x|max_request_retries_exhausted"
    assert got["e"].last_error_message == f"[{state.GIVEN_UP} 3 retries, limit 3]" and got["a"].last_error_message == f"m {got['e'].last_error_message}"


def source_units(spark):
    source = spark.createDataFrame([(1, "a", "b"), (2, "c", "d"), (3, "e", None), (4, "f", "g")], "k long, x string, y string")
    return source, units.work_units(source, "k", {"x": "ox", "y": "oy"}, "s", "m")


def states(spark, work, statuses):
    ids = {(r.row_id, r.field_name): r.unit_id for r in work.collect()}
    return ids, progress(spark, *[(ids[k], s, 0, None, None, "t", 1) for k, s in statuses.items()])


def test_release_and_pair_status(spark):
    source, work = source_units(spark)
    ids, known = states(spark, work, {("1", "x"): "success", ("1", "y"): "success", ("2", "x"): "success", ("2", "y"): "permanent_error", ("3", "x"): "success"})
    assert sorted(r.row_id for r in views.released_rows(work, known).collect()) == ["1", "2", "3"]
    strict = views.released_rows(work, known, "row_complete")
    assert sorted(r.row_id for r in strict.collect()) == ["1", "3"]
    got = {r.row_id: r for r in views.pair_status(work, known, ["x", "y"], strict).collect()}
    assert set(got) == {"1", "2", "3"}
    assert (got["2"].row_success_complete, got["2"].row_terminal_complete, got["2"].blocked_fields) == (False, True, "y")
    assert (got["3"].row_success_complete, got["3"].blocked_fields, got["3"].y__status) == (True, "y", None)
    assert [got[k].released_for_partial_output for k in "123"] == [True, False, True]
    assert views.pair_status(work, known.where("false"), ["x", "y"]).count() == 0


def results(spark, rows):
    return conform(spark.createDataFrame(rows, "unit_id string, row_id string, output_column string, status string, output_value string, seq long"), RESULT)


def test_merge_back(spark):
    source, work = source_units(spark)
    rows = results(spark, [("u1", "1", "ox", "success", "3", 1), ("u1", "1", "ox", "success", "4", 2), ("u2", "2", "oy", "success", "5", 1), ("u9", "2", "ox", "retryable_error", "6", 1)])
    got = {r.k: (r.ox, r.oy) for r in views.merge_back(source, rows, "k", ["ox", "oy"], {"ox": "Int64"}).collect()}
    assert got == {"1": (4, None), "2": (None, "5"), "3": (None, None), "4": (None, None)}
    assert views.merge_back(source, rows.where("false"), "k", ["ox"], {"ox": "Int64"}).schema["ox"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError, match="in the source"):
        views.merge_back(source, rows, "k", ["x"])
    with pytest.raises(ValueError, match="output type"):
        typed(F.col("x"), "Date")
    bad = results(spark, [("u1", "1", "ox", "success", "three", 1)])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        views.merge_back(source, bad, "k", ["ox"], {"ox": "Int64"}).collect()


def test_partial_output_has_released_rows_only(spark):
    source, _ = source_units(spark)
    rows = results(spark, [("u1", "1", "ox", "success", "3", 1), ("u2", "2", "ox", "success", "5", 1)])
    released = spark.createDataFrame([("2",)], "row_id string")
    assert [tuple(r) for r in views.partial_output(source, rows, "k", ["ox"], released).collect()] == [("2", "c", "d", "5")]


def test_reconcile_adds_missing_successes(spark):
    known = progress(spark, ("u1", "retryable_error", 1, "e", "m", "2026-01-01", 1), ("u2", "success", 0, None, None, "2026-01-01", 1))
    done = results(spark, [("u1", "1", "ox", "success", "3", 1), ("u2", "2", "ox", "success", "5", 1), ("u3", "3", "ox", "success", "5", 1)])
    got = {r.unit_id: (r.status, r.retry_count, r.seq) for r in state.reconcile(known, done, "2026-02-01", 7).collect()}
    assert got == {"u1": ("success", 0, 7), "u2": ("success", 0, 1), "u3": ("success", 0, 7)}


def test_replay_takes_only_newer_deltas(spark):
    saved = results(spark, [("u1", "1", "o", "success", "saved", 4)])
    deltas = results(spark, [("u1", "1", "o", "success", "old", 2), ("u2", "2", "o", "success", "new", 5)])
    assert {r.unit_id: r.output_value for r in state.replay(saved, 4, deltas).collect()} == {"u1": "saved", "u2": "new"}


def test_replay_takes_a_delta_before_a_checkpoint_row_of_its_seq(spark, monkeypatch):
    saved = results(spark, [("u1", "1", "o", "success", "saved", 2), ("u2", "2", "o", "success", "saved", 1)])
    deltas = results(spark, [("u1", "1", "o", "success", "new", 2)])
    want = {"u1": "new", "u2": "saved"}
    assert {r.unit_id: r.output_value for r in state.replay(saved, 1, deltas).collect()} == want
    # Executors may meet the rows of the deltas first.
    monkeypatch.setattr(state, "append_all", lambda frames, schema: append_all(frames[::-1], schema))
    assert {r.unit_id: r.output_value for r in state.replay(saved, 1, deltas).collect()} == want


def test_state_is_not_sent_through_the_driver(spark, tmp_path):
    source, work = source_units(spark)
    known = progress(spark, ("u1", "success", 0, None, None, "2026-01-01", 1))
    rows, released = results(spark, [("u1", "1", "ox", "success", "3", 1)]), spark.createDataFrame([("1",)], "row_id string")
    for k, df in enumerate((source, work, known, rows, released)):
        df.write.parquet(f"{tmp_path}/{k}")  # of files Spark knows that they are small
    source, work, known, rows, released = (spark.read.parquet(f"{tmp_path}/{k}") for k in range(5))
    made = [
        state.reconcile(known, rows, "2026-02-01", 7), state.retry_counts(work, known), units.pending(work, known), views.released_rows(work, known), views.pair_status(work, known, ["x", "y"], released),
        views.merge_back(source, rows, "k", ["ox"], None, work), views.partial_output(source, rows, "k", ["ox"], released),
    ]
    for df in made:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_rows_to_frame_coerces(spark):
    row = rows_to_frame(spark, [{"unit_id": 5, "parsed_output": {"a": [1]}, "review_flag": "yes", "seq": "3"}], RESULT).first()
    assert (row.unit_id, row.parsed_output, row.review_flag, row.seq, row.row_id) == ("5", '{"a": [1]}', True, 3, None)
