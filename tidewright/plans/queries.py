"""Queries of the engine's operators over whole tables.

Histories come from a deterministic provider: the answer to the n-th request of a unit depends on the n-th digit of its id. A 0
is an unusable answer, 1 and 2 are a refused request, and all else is the text's length modulo 7.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions import text as text_functions
from tidewright.functions.schemas import CHECKPOINT, DEBUG, PROGRESS, RESULT, append_all, conform
from tidewright.operators import contract, control, retention, state, units, views
from tidewright.sources.tables import scan

STEP, MODEL = "classify", "stub-1"
OUTPUTS = {"text": "text_label", "lang": "lang_label"}
ATTEMPTS = 3
NOW = "2026-01-09T00:00:00+00:00"


def table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet", columns)


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.work_units(table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]), "doc_id", OUTPUTS, STEP, MODEL)


def history(work: DataFrame) -> DataFrame:
    """A row for each request that was made of each unit: up to three, none after a success."""
    digit = F.substring("unit_id", F.col("attempt"), 1)
    failed_before = F.forall(F.sequence(F.lit(1), F.lit(ATTEMPTS)), lambda k: (k >= F.col("attempt")) | F.substring(F.col("unit_id"), k, F.lit(1)).isin("0", "1", "2"))
    asked = work.withColumn("attempt", F.explode(F.sequence(F.lit(1), F.lit(ATTEMPTS)))).where(failed_before).withColumn("digit", digit)
    error = F.when(F.col("digit") == "0", "invalid_score_output").when(F.col("digit").isin("1", "2"), "rate_limit")
    told = asked.withColumns({"error_type": error, "seq": F.col("attempt").cast("long"), "updated_at": F.concat(F.lit("2026-01-0"), F.col("attempt").cast("string"), F.lit("T00:00:00+00:00"))})
    good = F.col("error_type").isNull()
    return told.withColumns({"status": F.when(good, "success").otherwise("retryable_error"), "retry_count": F.col("attempt").cast("long") - good.cast("long"), "error_message": F.when(~good, F.concat(F.lit("attempt "), F.col("attempt").cast("string"), F.lit(" failed"))), "output_value": F.when(good, (F.length("input_text") % 7).cast("string"))})


def _progress_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(history(_units(spark, sf_dir)).withColumnsRenamed({"error_type": "last_error_type", "error_message": "last_error_message"}), PROGRESS)


def _progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest_progress(state.apply_retry_limit(_progress_log(spark, sf_dir), 2))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(history(_units(spark, sf_dir)).where("status = 'success'").withColumns({"review_flag": F.col("output_value") == "0", "raw_output": F.col("output_value"), "parsed_output": F.col("output_value")}), RESULT)


def _debug(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = history(_units(spark, sf_dir)).withColumn("review_flag", F.when(F.col("status") != "success", True).when(F.col("output_value") != "1", F.col("output_value") == "0"))
    return conform(log, DEBUG)


def scan_projection(spark, sf_dir):
    return table(spark, sf_dir, "documents", ["doc_id", "lang", "source"])


def row_window(spark, sf_dir):
    return units.row_window(table(spark, sf_dir, "documents", ["doc_id", "lang"]), "doc_id", 10, 50)


def row_window_far(spark, sf_dir):
    """A window behind nine tenths of all line items. Order and line number repeat, so the quantity decides between rows that share them;
    rows equal in all three are one as good as the other."""
    items = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    return units.row_window(items, ["l_orderkey", "l_linenumber", "l_quantity"], items.count() * 9 // 10, 500)


def work_units(spark, sf_dir):
    return _units(spark, sf_dir)


def conversation_units(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").withColumn("turn_id", F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    return units.work_units(turns, "turn_id", {"text": "tone"}, "tone", MODEL, "v2").select("unit_id", "row_id", "field_name", "output_column", "prompt_version")


def manifest(spark, sf_dir):
    return units.manifest(_units(spark, sf_dir))


def pending_units(spark, sf_dir):
    first = state.latest_progress(_progress_log(spark, sf_dir).where("seq = 1"))
    return units.pending(_units(spark, sf_dir), first).select("unit_id", "row_id", "field_name")


def latest_progress(spark, sf_dir):
    return state.latest_progress(_progress_log(spark, sf_dir))


def latest_results(spark, sf_dir):
    return state.latest_results(_results(spark, sf_dir)).select("unit_id", "row_id", "output_column", "output_value", "review_flag", "seq")


def latest_debug(spark, sf_dir):
    return state.latest_debug(_debug(spark, sf_dir)).select("unit_id", "status", "error_type", "output_value", "seq")


def schema_enforcement(spark, sf_dir):
    return conform(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("unit_id"), F.col("source").alias("retry_count"), F.col("lang").alias("status"), F.lit(1).alias("more")), PROGRESS)


def append_logs(spark, sf_dir):
    one = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("unit_id"), F.col("lang").alias("status"))
    two = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("unit_id"), F.col("quality").alias("retry_count"))
    return append_all([one, two], PROGRESS).groupBy("status").agg(F.count("*").alias("n"), F.sum("retry_count").alias("retries"))


def reconcile_progress(spark, sf_dir):
    known = state.latest_progress(_progress_log(spark, sf_dir).where("seq = 1"))
    return state.reconcile(known, _results(spark, sf_dir), NOW, 9)


def result_difference(spark, sf_dir):
    first = _progress_log(spark, sf_dir).where("seq = 1")
    return state.success_ids(_results(spark, sf_dir)).join(state.success_ids(first), "unit_id", "left_anti")


def retry_limit(spark, sf_dir):
    return state.apply_retry_limit(_progress_log(spark, sf_dir), 2)


def retry_counts(spark, sf_dir):
    known = state.latest_progress(_progress_log(spark, sf_dir).where("retry_count > 0"))
    return state.retry_counts(_units(spark, sf_dir), known).groupBy("field_name", "retry_count").agg(F.count("*").alias("n"))


def terminal_units(spark, sf_dir):
    return state.terminal(_progress(spark, sf_dir)).select("unit_id", "status")


def released_partial(spark, sf_dir):
    return views.released_rows(_units(spark, sf_dir), _progress(spark, sf_dir), "unit")


def released_strict(spark, sf_dir):
    return views.released_rows(_units(spark, sf_dir), _progress(spark, sf_dir), "row_complete")


def partial_output(spark, sf_dir):
    source = table(spark, sf_dir, "documents", ["doc_id", "source"])
    return views.partial_output(source, _results(spark, sf_dir), "doc_id", list(OUTPUTS.values()), released_strict(spark, sf_dir))


def pair_status(spark, sf_dir):
    return views.pair_status(_units(spark, sf_dir), _progress(spark, sf_dir), list(OUTPUTS), released_strict(spark, sf_dir))


def merge_back(spark, sf_dir):
    return views.merge_back(table(spark, sf_dir, "documents", ["doc_id", "source"]), _results(spark, sf_dir), "doc_id", list(OUTPUTS.values()))


def merge_back_typed(spark, sf_dir):
    source = table(spark, sf_dir, "documents", ["doc_id", "source"])
    return views.merge_back(source, _results(spark, sf_dir), "doc_id", list(OUTPUTS.values()), {"text_label": "Int64", "lang_label": "Float64"}, _units(spark, sf_dir))


def run_outcome(spark, sf_dir):
    return views.outcome(_units(spark, sf_dir), _results(spark, sf_dir))


def run_metadata(spark, sf_dir):
    return views.run_metadata(_units(spark, sf_dir), _progress(spark, sf_dir), _results(spark, sf_dir), STEP, "complete", NOW)


def status_histogram(spark, sf_dir):
    return state.status_counts(_progress(spark, sf_dir))


def run_status_histogram(spark, sf_dir):
    return state.status_counts(_progress(spark, sf_dir), _units(spark, sf_dir).where("field_name = 'text'"))


def review_rows(spark, sf_dir):
    return state.review_rows(_debug(spark, sf_dir)).select("unit_id", "status", "review_flag", "seq")


def permanent_review(spark, sf_dir):
    log = _debug(spark, sf_dir).withColumn("status", F.when(F.col("error_type") == "invalid_score_output", "permanent_error").otherwise(F.col("status")))
    return state.permanent_review(log, _progress(spark, sf_dir)).select("unit_id", "error_type", "seq")


def checkpoint_rows(spark, sf_dir):
    return state.checkpoint_rows(_results(spark, sf_dir))


def delta_replay(spark, sf_dir):
    log = _results(spark, sf_dir)
    known = conform(state.checkpoint_rows(log.where("seq <= 2")).withColumn("output_value", F.concat(F.lit("c"), F.col("output_value"))), CHECKPOINT)
    return state.replay(known, 1, log).select("unit_id", "output_column", "output_value", "seq")


def artifact_log(spark, sf_dir):
    """The results of all documents from a log of three deltas and a checkpoint of the first two, read as a data source."""
    from tidewright.sources.artifact_log import read_log
    from tidewright.sources.scratch import new_folder
    from tidewright.sources.tables import Folder, write_artifact

    folder, log = Folder(spark, new_folder(spark, "logs")), _results(spark, sf_dir)
    for k in (1, 2, 3):
        write_artifact(folder, log.where(F.col("seq") == k), "results_delta", "20260101_000000", f"20260101_00000{k}_000000")
    known = state.checkpoint_rows(log.where("seq <= 2")).withColumn("output_value", F.concat(F.lit("c"), F.col("output_value")))
    write_artifact(folder, known, "results_checkpoint", "20260101_000000", "20260101_000009_000000")
    return read_log(spark, folder.uri("")).select("unit_id", "output_column", "output_value", "seq")


def result_fanout(spark, sf_dir):
    from tidewright.operators.responses import results_of

    traces = _debug(spark, sf_dir).withColumn("outputs", F.to_json(F.create_map("output_column", "output_value", F.lit("half"), (F.col("output_value").cast("int") * 2).cast("string"))))
    return results_of(traces, 7).select("unit_id", "output_column", "output_value", "seq")


def group_assignment(spark, sf_dir):
    return control.grouped(_units(spark, sf_dir).select("unit_id", "row_id"), 4, 2)


def token_estimate(spark, sf_dir):
    sized = control.grouped(_units(spark, sf_dir).select("unit_id", "input_text"), 4, 2).groupBy("group_id").agg(F.sum(F.length("input_text")).alias("chars"), F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("input_text")), "").alias("prompt"))
    return sized.select("group_id", "chars", "n", control.estimated_tokens(F.col("prompt"), F.col("n")).alias("tokens"))


def _lanes(spark, sf_dir):
    second = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    return table(spark, sf_dir, "events", ["event_id", "user_id", "ts", "value", "event_type"]).select("event_id", "ts", "event_type", (F.col("user_id") % 8).alias("lane"), second.alias("sec"), F.floor("value").alias("tokens"), F.col("value").alias("seconds"))


def rolling_tokens(spark, sf_dir):
    return control.rolling_tokens(_lanes(spark, sf_dir).select("event_id", "lane", "sec", "tokens"))


def shared_failures(spark, sf_dir):
    return control.shared_failures(_lanes(spark, sf_dir).where("event_type = 'error'"))


def timeout_window(spark, sf_dir):
    got = control.time_limit(_lanes(spark, sf_dir), base=10.0, most=120.0, least_margin=5.0)
    return got.select("event_id", "lane", "sample_count", F.round("center_seconds", 4).alias("center_seconds"), F.round("limit_seconds", 3).alias("limit_seconds"))


def timeout_window_mad(spark, sf_dir):
    got = control.time_limit(_lanes(spark, sf_dir), base=10.0, most=120.0, least_margin=5.0, spread="mad", least_samples=3)
    return got.select("event_id", "lane", "sample_count", F.round("spread_seconds", 4).alias("spread_seconds"))


def moving_averages(spark, sf_dir):
    """The moving average of each lane, and of all events as one lane."""
    each = _lanes(spark, sf_dir).select("event_id", F.col("lane").cast("long").alias("lane"), "ts", "seconds")
    rows = each.unionByName(each.withColumn("lane", F.lit(-1).cast("long")))
    got = control.moving_averages(rows, "lane", ["ts", "event_id"], "seconds", 0.3)
    return got.select("event_id", "lane", F.round("average", 6).alias("average"))


def timeout_window_one_lane(spark, sf_dir):
    """One lane that holds all events."""
    rows = _lanes(spark, sf_dir).withColumn("lane", F.lit(0))
    got = control.time_limit(rows, base=10.0, most=120.0, least_margin=5.0)
    return got.select("event_id", "sample_count", F.round("center_seconds", 4).alias("center_seconds"), F.round("limit_seconds", 3).alias("limit_seconds"))


def lane_totals(spark, sf_dir):
    """The loads of all lanes, a lane's budget being its tokens of the fullest minute and its group the most events in one."""
    minutes = _lanes(spark, sf_dir).groupBy("lane", F.floor(F.col("sec") / 60).alias("minute")).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("events"))
    return control.lane_totals(minutes.groupBy("lane").agg(F.max("tokens").alias("load_budget"), F.max("events").alias("group_size")))


def _asked_and_answered(spark, sf_dir):
    """Events in requests of 20, of which some are answered badly, twice, not at all, or without being asked."""
    events = table(spark, sf_dir, "events", ["event_id", "event_type", "value"])
    unit, request = F.col("event_id").cast("string").alias("unit_id"), F.floor(F.col("event_id") / 20).cast("string").alias("request_id")
    asked = events.select(request, unit)
    times = F.when(F.col("event_id") % 41 == 0, 0).when(F.col("event_id") % 53 == 0, 3).otherwise(1)
    said = F.when(F.col("event_id") % 61 == 0, "odd").when(F.col("event_id") % 67 == 0, F.lit(None)).otherwise("success").alias("status")
    copies = events.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3)))).where(F.col("n") <= times)
    answers = copies.select(request, unit, said, F.when(F.col("event_id") % 71 != 0, F.col("value")).alias("output_value"))
    more = events.where(F.col("event_id") % 83 == 0).select(request, F.concat(F.lit("x"), F.col("event_id").cast("string")).alias("unit_id"), said, F.col("value").alias("output_value"))
    return asked, answers.unionByName(more)


def contract_breaches(spark, sf_dir):
    """Every unit that is not answered once and well."""
    asked, answers = _asked_and_answered(spark, sf_dir)
    return contract.breaches(asked, answers, ["request_id", "unit_id"], ["unit_id", "output_value"])


def broken_requests(spark, sf_dir):
    asked, answers = _asked_and_answered(spark, sf_dir)
    return contract.broken_requests(contract.breaches(asked, answers, ["request_id", "unit_id"], ["unit_id", "output_value"]))


def file_batch_stream(spark, sf_dir):
    """Documents that arrive as files, two at a time, through a function and a model step. The stream is stopped by a failure in its second
    batch and started again; all batches together are what one run over all files gives."""
    from tidewright.operators.control import Pace
    from tidewright.plans import pipeline, stub
    from tidewright.plans.settings import Runtime
    from tidewright.sources.scratch import new_folder
    from tidewright.sources.tables import Folder
    from tidewright.streaming.arrivals import process_arrivals

    at = new_folder(spark, "arrivals")
    docs = table(spark, sf_dir, "documents", ["doc_id", "source", "lang"])
    docs.repartition(4, "doc_id").write.option("compression", "zstd").parquet(f"{at}/in")
    failed = []

    def named(batch):
        if not failed and Folder(spark, f"{at}/out").list_objects() != ["arrived"]:
            failed.append(1)
            raise InterruptedError("stopped between two batches")
        return batch.withColumn("source", text_functions.safe_name(F.col("source")))

    plan = pipeline.Pipeline("arrived", [pipeline.FunctionStep(named), stub.stub_step(Runtime(pace=Pace(initial_group_size=64, max_group_size=128)), "doc_id", "lang")])
    for _ in range(2):
        query = process_arrivals(spark, plan, f"{at}/in", docs.schema, f"{at}/out", f"{at}/checkpoint", files_at_once=2)
        try:
            query.awaitTermination()
        except Exception:
            if len(failed) != 1:
                raise
            failed.append(2)
    made = [f"{at}/out/{n}" for n in Folder(spark, f"{at}/out").list_objects() if n.endswith(".parquet")]
    return spark.read.parquet(*made).select("doc_id", "source", "lang", "label")


def _names(spark, sf_dir):
    family = F.element_at(F.array(*map(F.lit, retention.FAMILIES)), (F.col("event_id") % len(retention.FAMILIES) + 1).cast("int"))
    run, stamp = F.lpad((F.col("event_id") % 40).cast("string"), 6, "0"), F.lpad(F.col("event_id").cast("string"), 6, "0")
    return table(spark, sf_dir, "events", ["event_id"]).select(F.concat(family, F.lit("__run_20260101_"), run, F.lit("__20260101_000000_"), stamp, F.lit(".parquet")).alias("name"), F.col("event_id").alias("seq"))


def artifact_retention(spark, sf_dir):
    return retention.beyond_last(_names(spark, sf_dir).select("name"), {"manifest": 1, "traces": 5})


def run_retention(spark, sf_dir):
    return retention.beyond_last_runs(_names(spark, sf_dir).select("name"))


def delta_retention(spark, sf_dir):
    names = _names(spark, sf_dir).withColumn("family", retention.family_of(F.col("name")))
    return retention.covered_deltas(names.where("family = 'results_delta'"), names.where("family = 'results_checkpoint'"))


def final_retention(spark, sf_dir):
    made = table(spark, sf_dir, "orders", ["o_orderkey"]).select(F.concat(F.when(F.col("o_orderkey") % 2 == 0, "out").otherwise("out_other"), F.lit("_20260101_"), F.lpad((F.col("o_orderkey") % 1_000_000).cast("string"), 6, "0"), F.lit(".parquet")).alias("name")).distinct()
    return retention.old_finals(made, "out")


def latest_artifact(spark, sf_dir):
    return _names(spark, sf_dir).withColumn("family", retention.family_of(F.col("name"))).groupBy("family").agg(F.max("name").alias("name"))


def artifact_runs(spark, sf_dir):
    return _names(spark, sf_dir).withColumn("run", text_functions.run_of(F.col("name"))).groupBy("run").agg(F.count("*").alias("n"))


def file_batches(spark, sf_dir):
    files = table(spark, sf_dir, "documents", ["source"]).groupBy("source").agg(F.count("*").alias("n"))
    return control.grouped(files.withColumnRenamed("source", "unit_id"), 3).withColumnsRenamed({"unit_id": "source"})


def safe_names(spark, sf_dir):
    return table(spark, sf_dir, "part", ["p_partkey", "p_name"]).select("p_partkey", text_functions.safe_name(F.col("p_name")).alias("name"))


def resumable_step(spark, sf_dir):
    """The whole wave loop over a source, stopped after a wave and resumed."""
    from tidewright.plans import stub

    return stub.run_resumed(spark, table(spark, sf_dir, "nation"))


def resumable_documents(spark, sf_dir):
    """The wave loop over all documents, in bounded waves, stopped after the first and resumed."""
    from tidewright.operators.control import Pace
    from tidewright.plans import stub
    from tidewright.plans.settings import Runtime

    docs = table(spark, sf_dir, "documents", ["doc_id", "source", "text"])
    total = docs.count()
    runtime = Runtime(pace=Pace(initial_group_size=16, max_group_size=64), units_per_wave=max(1, total // 3))
    done = stub.run_resumed(spark, docs, stub.stub_step(runtime, "doc_id", "text"))
    return done.select("doc_id", "source", "label")


def flagship(spark, sf_dir):
    """Documents with their typed answers and labels, by language."""
    docs = table(spark, sf_dir, "documents", ["doc_id", "lang", "source"])
    typed = views.merge_back(docs, _results(spark, sf_dir), "doc_id", list(OUTPUTS.values()), {"text_label": "Int64", "lang_label": "Int64"}, _units(spark, sf_dir))
    labelled = typed.join(table(spark, sf_dir, "labels", ["doc_id", "quality"]).withColumn("doc_id", F.col("doc_id").cast("string")), "doc_id", "left")
    return labelled.groupBy("lang", "quality").agg(F.count("*").alias("n"), F.count("text_label").alias("answered"), F.sum("text_label").alias("text_sum"), F.sum("lang_label").alias("lang_sum"))


QUERIES = {f.__name__: f for f in (scan_projection, row_window, row_window_far, work_units, conversation_units, manifest, pending_units, latest_progress, latest_results, latest_debug, schema_enforcement, append_logs, reconcile_progress, result_difference, retry_limit, retry_counts, terminal_units, released_partial, released_strict, partial_output, pair_status, merge_back, merge_back_typed, run_outcome, run_metadata, status_histogram, run_status_histogram, review_rows, permanent_review, checkpoint_rows, delta_replay, artifact_log, result_fanout, group_assignment, token_estimate, rolling_tokens, shared_failures, timeout_window, timeout_window_mad, timeout_window_one_lane, moving_averages, lane_totals, contract_breaches, broken_requests, file_batch_stream, artifact_retention, run_retention, delta_retention, final_retention, latest_artifact, artifact_runs, file_batches, safe_names, resumable_step, resumable_documents, flagship)}
