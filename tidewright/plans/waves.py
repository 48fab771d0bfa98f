"""A model step as waves of Spark jobs over a replayable log.

A wave takes a bounded slice of the waiting units and asks until its deadline; tasks save their answers while they ask. From what was saved,
traces, results, progress and reviews are derived, so that Spark never repeats a request to recompute a frame. Each wave adds small deltas;
snapshots and views follow at the cadence of the settings and write only the buckets that the waves since have changed. A run that stops
anywhere loses the answers that tasks had not saved yet; the next one finds those that were, derives what is missing and goes on.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.schemas import CHECKPOINT, DEBUG, PROGRESS, RESULT, WORK_UNIT, append_all, conform
from tidewright.operators import asking, control, responses, retention, state, units, views
from tidewright.plans.settings import ModelStep
from tidewright.plans.snapshots import PLACE, PLACE_BITS, Snapshot, bits_for, place, within
from tidewright.sources import tables

#: Families that this engine writes beside the fixed ones.
OWN_FAMILIES = ("units", "waiting", "unasked", "progress_delta", "source")
#: Families that are not pruned by age: deltas go once a snapshot covers them, parts once no newer snapshot names them.
SPARED = ("results_delta", "progress_delta", *(f"{f}_{kind}" for f in ("progress", "results_checkpoint", "pair_status", "partial_output") for kind in ("part", "buckets")))
#: Deltas, and the snapshots that cover them.
DELTAS = {"results_delta": "results_checkpoint", "progress_delta": "progress"}
ASKING = "asking__run_"
#: A folder of the state for units that have failed in a round, by the number of the round.
AGAIN = "again"


def utc_now() -> datetime:
    return datetime.now(UTC)


class StepLog:
    """A step's folders: ``state``, ``results`` and ``debug``."""

    def __init__(self, folder: tables.Folder, run: str, clock: Callable[[], datetime] = utc_now):
        self.run, self.clock, self.spark = run, clock, folder.spark
        self.state, self.results, self.debug = (folder.ensure_subdir(n) for n in ("state", "results", "debug"))
        self.newest: dict[str, str] = {}
        self.added: dict[str, list[str]] = {}
        """Deltas and traces that no snapshot has yet."""
        self.held: set[str] = set()
        """Artifacts that are to be read again, whatever retention says."""

    def stamp(self) -> str:
        return self.clock().strftime("%Y%m%d_%H%M%S_%f")

    def write(self, folder: tables.Folder, df: DataFrame, family: str, partition_by: Sequence[str] = ()) -> DataFrame:
        name = tables.write_artifact(folder, df, family, self.run, self.stamp(), partition_by)
        self.newest[family] = name
        return folder.spark.read.schema(df.schema).parquet(f"{folder.path}/{name}")

    def add(self, folder: tables.Folder, df: DataFrame, family: str) -> DataFrame:
        written = self.write(folder, df, family)
        self.added.setdefault(family, []).append(self.newest[family])
        return written

    def since(self, folder: tables.Folder, family: str) -> DataFrame | None:
        names = self.added.get(family)
        return folder.spark.read.parquet(*[f"{folder.path}/{n}" for n in names]) if names else None

    def last_seq(self) -> int:
        known = tables.read_progress(self.state).agg(F.max("seq")).first()[0]
        return -1 if known is None else known

    def finish_wave(self, name: str, seq: int, most_retries: int) -> tuple[DataFrame, dict[str, int]]:
        """Traces, results, progress and reviews from what the tasks of a wave have saved, and their figures. Results come before progress: what
        has a result but no progress is found again by reconciling. The tasks' files go last, so that all this can be done again."""
        path = f"{self.debug.path}/{name}"
        for part in (asking.ANSWERS, asking.FIGURES):
            self.debug.ensure_subdir(f"{name}/{part}")
        told = asking.figures(self.spark, path)
        asked = responses.limited(asking.answers(self.spark, path), most_retries)
        traces = self.add(self.debug, asked.withColumns({"seq": F.lit(seq).cast("long"), PLACE: place(F.col("row_id"))}), "traces")
        self.add(self.results, responses.results_of(traces, seq, [PLACE]), "results_delta")
        self.add(self.state, responses.progress_of(traces, seq, [PLACE]), "progress_delta")
        if told["failed_units"] or told["flagged_units"]:
            self.write(self.debug, responses.debug_of(state.review_rows(traces), seq), "review")
        self.debug.delete_object(name)
        return traces, told

    def left_over(self) -> list[str]:
        """Waves whose tasks have saved answers, but which the run before did not finish."""
        return [n for n in self.debug.list_objects() if n.startswith(ASKING)]

    def prune(self, mode: str = "standard", keep: Mapping[str, int] | None = None, written: Sequence[str] | None = None) -> int:
        """Deletes what retention lets go, of the families ``written`` (all by default), and deltas that kept snapshots cover.
        What this run wrote last of a family stays. Names are few, some for each wave."""
        families = (*retention.FAMILIES, *OWN_FAMILIES, *SPARED)
        places = {n: folder for folder in (self.state, self.results, self.debug) for n in folder.list_objects() if not n.startswith(ASKING)}
        names = self.state.spark.createDataFrame([(n,) for n in places], "name string").coalesce(1)
        plan = retention.cleanup_plan(names, written or families, mode, keep, families=families, spared=SPARED)
        busy = {*self.held, *self.newest.values(), *(n for some in self.added.values() for n in some)}
        gone = [r["name"] for r in plan.collect() if r["name"] not in busy]
        for name in gone:
            places[name].delete_object(name)
        return len(gone) + sum(self.prune_deltas(folder, d, DELTAS[d]) for folder, d in ((self.results, "results_delta"), (self.state, "progress_delta")))

    def prune_deltas(self, folder: tables.Folder, delta: str, snapshot: str) -> int:
        made = [self.last_rows(folder, family) for family in (delta, snapshot)]
        names = [r["name"] for r in retention.covered_deltas(*made).collect()]
        for name in names:
            folder.delete_object(name)
        return len(names)

    def last_rows(self, folder: tables.Folder, family: str) -> DataFrame:
        """The last ``seq`` of each artifact that has rows, in one pass over that column."""
        paths = [f"{folder.path}/{n}" for n in tables.artifacts(folder, family)]
        if not paths:
            return folder.spark.createDataFrame([], "name string, seq long")
        # Whole snapshots have folders for their buckets.
        name = F.regexp_extract("_metadata.file_path", r"/([^/]+__run_[^/]+\.parquet)/", 1)
        rows = folder.spark.read.option("recursiveFileLookup", "true").parquet(*paths).select(name.alias("name"), F.col("seq").cast("long").alias("seq"))
        return rows.groupBy("name").agg(F.max("seq").alias("seq"))


@dataclass
class Cadence:
    """Something is due after so many waves, or so many seconds since it was done last."""

    waves: int
    seconds: float
    timer: Callable[[], float]
    done_at: float = field(init=False)
    since: int = field(init=False, default=0)

    def __post_init__(self):
        self.done_at = self.timer()

    def due(self) -> bool:
        """To be asked once a wave."""
        self.since += 1
        if self.since < self.waves and self.timer() - self.done_at < self.seconds:
            return False
        self.since, self.done_at = 0, self.timer()
        return True


class Round:
    """Waiting units, in slices by the place of their rows, of which each is asked once. Only ids wait; the rest of a unit, its text above all,
    is read from ``todo`` when its slice is taken. What fails is kept whole for the next round, which then reads nothing else."""

    def __init__(self, log: StepLog, waiting: DataFrame, a_slice: int, todo: DataFrame, number: int = 1):
        self.log, self.count, self.todo, self.number = log, waiting.count(), todo, number
        self.slices = min(1 << PLACE_BITS, math.ceil(self.count / max(1, a_slice)))
        cut = waiting.withColumn("slice", F.shiftright(F.col(PLACE).cast("long") * self.slices, PLACE_BITS))
        # Sorted, so that a wave's filter on slices skips what the footers exclude.
        self.units = log.write(log.state, cut.repartitionByRange("slice").sortWithinPartitions("slice"), "waiting")
        self.next, self.first = 0, 0
        self.unasked: DataFrame | None = None
        self.taken: DataFrame | None = None

    def left(self) -> bool:
        return self.unasked is not None or self.next < self.slices

    def take(self, most_units: float) -> tuple[DataFrame, int]:
        """What the last wave came not to, or else the next slices that hold about so many units, and how many units that is about."""
        if self.unasked is not None:
            self.taken, self.unasked = self.unasked, None
            return self.taken, self.taken.count()
        each = self.count / self.slices
        n = min(max(1, int(most_units / each + 1e-9)), self.slices - self.next)
        self.taken = self.units.where(F.col("slice").between(self.next, self.next + n - 1))
        self.first, self.next = self.next, self.next + n
        return self.taken, math.ceil(n * each)

    def whole(self, groups: DataFrame) -> DataFrame:
        """Groups of the units taken last, with all that ``todo`` has of them. Of it the places of the slices are read."""
        low, high = (-(-(k << PLACE_BITS) // self.slices) for k in (self.first, self.next))
        rows = self.todo.where((F.col(PLACE) >= low) & (F.col(PLACE) < high)).drop(PLACE)
        return rows.join(state.merged(groups), "unit_id")

    def keep_failed(self, traces: DataFrame, step: ModelStep) -> None:
        own = {"step_name": F.lit(step.name), "model": F.lit(step.model), "prompt_version": F.lit(step.prompt_version)}
        failed = traces.where(F.col("status") == "retryable_error").withColumns(own).select(*WORK_UNIT.names, PLACE)
        failed.write.mode("append").option("compression", "zstd").parquet(f"{self.log.state.path}/{AGAIN}/{self.number}")

    def following(self, most_retries: int, a_slice: int) -> Round:
        """The round of the units of this one that are to be asked once more."""
        kept = self.log.state.ensure_subdir(AGAIN)
        again = to_repeat(self.units, tables.read_progress(self.log.state), most_retries)
        todo = self.log.spark.read.schema(self.todo.schema).parquet(f"{kept.path}/{self.number}") if str(self.number) in kept.list_objects() else self.todo
        made = Round(self.log, again, a_slice, todo, self.number + 1)
        kept.delete_object(str(self.number - 1))
        return made

    def put_back(self, traces: DataFrame) -> None:
        """Units that were taken last and have no trace are taken again. They are a family of their own, as the round's slices are read until
        its end, and of a family only the last few artifacts are kept."""
        self.unasked = self.log.write(self.log.state, self.taken.join(state.merged(traces.select("unit_id")), "unit_id", "left_anti").select(*self.taken.columns), "unasked")


def wave_of(told: Mapping[str, int], seconds: float) -> control.Wave:
    good = told["requests"] - told["transport_failures"]
    return control.Wave(told["units"], told["failed_units"], told["units"] - told["failed_units"], told["requests"], told["transport_failures"], seconds, good)


def live_figures(spark: SparkSession, folder: str) -> dict[str, int] | None:
    """What the tasks of the running wave of a step have told so far, None between waves. Any session may ask."""
    debug = tables.Folder(spark, f"{folder}/debug")
    running = [n for n in debug.list_objects() if n.startswith(ASKING)]
    told = tables.Folder(spark, f"{debug.path}/{running[-1]}/{asking.FIGURES}") if running else None
    return asking.figures(spark, f"{debug.path}/{running[-1]}") if told and told.list_objects() else None


def run_step(source: DataFrame, step: ModelStep, folder: tables.Folder, run: str, clock: Callable[[], datetime] = utc_now, timer: Callable[[], float] = time.monotonic, most_waves: int | None = None) -> DataFrame:
    """source with the step's columns, as far as the run came. Units that succeeded before are not asked again."""
    runtime, log = step.runtime, StepLog(folder, run, clock)
    rows = units.row_window(source, step.key, runtime.input_row_offset, runtime.input_row_limit)
    units.require_unique_keys(rows, step.key)
    made = units.work_units(rows, step.key, step.outputs, step.name, step.model, step.prompt_version).withColumn(PLACE, place(F.col("row_id")))
    todo = log.write(log.state, made.repartitionByRange(PLACE).sortWithinPartitions(PLACE), "units")
    log.write(log.state, units.manifest(todo), "manifest")
    seq = log.last_seq() + 1
    for name in log.left_over():
        log.finish_wave(name, seq, runtime.max_request_retries)
        seq += 1
    known = state.reconcile(tables.read_progress(log.state), tables.read_results(log.results), clock().isoformat(), seq)
    held = State(step, log, source, todo)
    held.begin(known)
    # A run tries what failed for good before once more, and counts its own retries.
    waiting = units.pending(todo.select("unit_id", PLACE), held.progress.read()).withColumn("retry_count", F.lit(0).cast("long"))
    log.state.delete_object(AGAIN)  # of a run that stopped
    load, pace, began = control.initial_load(runtime.pace), runtime.pace, timer()
    # The first wave is a group for each task; how long it takes says how much to take next.
    most = float(min(runtime.units_per_wave, load.concurrency * runtime.lanes * load.group_size(pace)))
    a_slice = max(1, int(most) // 2)
    left = Round(log, waiting, a_slice, todo)
    provider = f"answers_{uuid.uuid4().hex}"
    config = {"name": step.name, "model": step.model, "prompt_version": step.prompt_version, "outputs": dict(step.outputs)}
    log.spark.dataSource.register(asking.answering(provider, step.make_adapter, step.make_handler, config, step.context))
    saving = Cadence(runtime.checkpoint_every_waves, runtime.checkpoint_every_seconds, timer)
    viewing = Cadence(runtime.views_every_waves, runtime.views_every_seconds, timer)
    for _ in range(most_waves or runtime.most_waves):
        remaining = runtime.soft_time_limit_seconds - (timer() - began)
        if remaining <= 0 or not left.left():
            break
        seq += 1
        taken, about = left.take(most)
        groups = left.whole(control.grouped(taken.drop("slice", PLACE), load.group_size(pace), control.bucket_digits(about)))
        name = f"{ASKING}{run}__{log.stamp()}"
        for part in (asking.ANSWERS, asking.FIGURES):
            log.debug.ensure_subdir(f"{name}/{part}")
        sent = timer()
        deadline = time.time() + min(remaining, runtime.seconds_per_wave)
        asking.ask(groups, provider, log.debug.uri(name), clock().isoformat(), deadline, load.concurrency * runtime.lanes, runtime.flush)
        seconds = timer() - sent
        traces, told = log.finish_wave(name, seq, runtime.max_request_retries)
        if told["unasked_units"]:
            left.put_back(traces)
        if told["failed_units"]:
            left.keep_failed(traces, step)
        figures = wave_of(told, seconds)
        if figures.units:
            load = control.next_load(load, pace, figures)
            most = min(runtime.units_per_wave, figures.units * runtime.seconds_per_wave / max(seconds, 1e-9))
        viewed = viewing.due()
        if saving.due() or viewed:
            held.save(seq)
        if viewed:
            held.view(seq, told)
        if not left.left():
            left = left.following(runtime.max_request_retries, a_slice)
    log.state.delete_object(AGAIN)
    held.save(seq)
    held.view(seq, None, last=True)
    results = held.end()
    return views.merge_back(source, results, step.key, step.columns, step.dtypes, todo)


def to_repeat(asked: DataFrame, progress: DataFrame, most: int) -> DataFrame:
    """Of a round's units those to ask once more. Failures on the way never become permanent, so a run gives up on a unit after
    as many retries."""
    again = progress.where((F.col("status") == "retryable_error") & (F.col("retry_count") <= most)).select("unit_id", "retry_count")
    return asked.drop("retry_count", "slice").join(state.merged(again), "unit_id").select(*[c for c in asked.columns if c != "slice"])


class State:
    """The snapshots and views of a run, brought up to date by what the log has gained since."""

    def __init__(self, step: ModelStep, log: StepLog, source: DataFrame, todo: DataFrame):
        self.step, self.log, self.todo = step, log, todo
        self.total = todo.count()
        self.bits = bits_for(self.total, step.runtime.units_per_bucket)
        self.progress = Snapshot(log, log.state, "progress", ["unit_id"], self.bits)
        self.results = Snapshot(log, log.results, "results_checkpoint", ["unit_id", "output_column"], self.bits)
        self.pairs = Snapshot(log, log.state, "pair_status", ["row_id"], self.bits)
        self.partial = Snapshot(log, log.results, "partial_output", [step.key], self.bits)
        self.source, self.placed = source, None
        self.covered: list[tuple[tables.Folder, str]] = []
        self.reviewed = False

    def begin(self, known: DataFrame) -> None:
        """The first snapshot of progress. Units of other settings have a place of their own."""
        placed = known.join(state.merged(self.todo.select("unit_id", PLACE)), "unit_id", "left")
        self.progress.write_whole(placed.withColumn(PLACE, F.coalesce(PLACE, place(F.col("unit_id")))).select(*PROGRESS.names, PLACE))

    def save(self, seq: int) -> None:
        """Progress, results and permanent failures up to ``seq``, after which covered deltas and old artifacts may go."""
        log, runtime = self.log, self.step.runtime
        newer, made, traces = (log.since(*of) for of in ((log.state, "progress_delta"), (log.results, "results_delta"), (log.debug, "traces")))
        if self.results.where is None:
            known = state.checkpoint_rows(tables.read_results(log.results))
            self.results.write_whole(known.withColumn(PLACE, place(F.col("row_id"))))
        elif made is not None:
            self.results.merge(state.latest_results(made).where("status = 'success'").select(*CHECKPOINT.names, PLACE), seq)
        if newer is not None:
            self.progress.merge(state.latest_progress(newer).select(*PROGRESS.names, PLACE), seq)
        if traces is not None:
            # What was permanent before and has not succeeded since is so still, so only new progress matters after the first time.
            failed = append_all([tables.read_permanent_review(log.debug), traces], DEBUG)
            log.write(log.debug, state.permanent_review(failed, newer if self.reviewed else self.progress.read()), "permanent_review")
            self.reviewed = True
            log.held.update(log.added["traces"])
        now = [(folder, n) for folder, family in ((log.state, "progress_delta"), (log.results, "results_delta")) for n in log.added.get(family, ())]
        log.added.clear()
        if runtime.cleanup_artifacts:
            # The snapshot before the last one is kept whole, with what it lacks.
            for folder, name in self.covered:
                folder.delete_object(name)
            self.covered = now
            log.prune(runtime.artifact_retention_mode, runtime.keep_last, tuple(log.newest))

    def view(self, seq: int, told: Mapping[str, int] | None, last: bool = False) -> None:
        """The views of rows that traces since the last time name, or of all rows the first time; and the run's figures."""
        runtime = self.step.runtime
        paths = [f"{self.log.debug.path}/{n}" for n in self.log.held]
        rows = self.log.spark.read.parquet(*paths).select("row_id", PLACE).distinct() if paths else None
        if runtime.write_pair_status or runtime.write_partial_output:
            if (self.pairs.where if runtime.write_pair_status else self.partial.where) is None:
                self._views(self.todo, self.progress.read(), self.results.read(), self._source(None), None, seq, last)
            elif rows is not None:
                hit = self.progress.hit(rows)
                own = self.todo.where(within(hit, self.bits)).join(state.merged(rows.select("row_id")), "row_id", "left_semi")
                self._views(own, self.progress.read(hit), self.results.read(hit), self._source(hit), rows, seq, last)
        self.log.held.clear()
        counts = self.progress.totals()
        done, dead = counts.get("success", 0), counts.get("permanent_error", 0)
        one = {"step_name": self.step.name, "status": "running", "success_units": done, "permanent_error_units": dead, "retryable_error_units": counts.get("retryable_error", 0), "total_units": self.total}
        tables.write_json(self.log.state, one | {"wave": dict(told or {}), "updated_at": self.log.clock().isoformat()}, "metadata", self.log.run, self.log.stamp())

    def _source(self, buckets: Sequence[int] | None) -> DataFrame:
        """The source's rows with their places, or those of some buckets; written by place once buckets are asked for."""
        if self.placed is None:
            self.placed = self.source.withColumn(PLACE, place(F.coalesce(F.col(self.step.key).cast("string"), F.lit("None"))))
        if buckets is None:
            return self.placed.drop(PLACE)
        if "source" not in self.log.newest and self.step.runtime.write_partial_output:
            self.placed = self.log.write(self.log.results, self.placed.repartitionByRange(PLACE).sortWithinPartitions(PLACE), "source")
        return self.placed.where(within(buckets, self.bits)).drop(PLACE)

    def _views(self, own: DataFrame, progress: DataFrame, results: DataFrame, source: DataFrame, rows: DataFrame | None, seq: int, last: bool) -> None:
        step, released = self.step, views.released_rows(own, progress, self.step.runtime.release_scope)
        made = []
        if step.runtime.write_pair_status:
            made.append((self.pairs, "row_id", views.pair_status(own, progress, list(step.outputs), released)))
        if step.runtime.write_partial_output:
            made.append((self.partial, step.key, views.partial_output(source, conform(results, RESULT), step.key, step.columns, released, step.dtypes)))
        for snapshot, key, view in made:
            placed = view.withColumn(PLACE, place(F.col(key)))
            if snapshot.where is None and last:
                self.log.write(snapshot.folder, view, snapshot.family)
            elif snapshot.where is None:
                snapshot.write_whole(placed)
            else:
                snapshot.merge(placed, seq, rows.withColumnRenamed("row_id", key))

    def end(self) -> DataFrame:
        """Whole artifacts of all tables, and the figures of the run. Returns the results."""
        for snapshot in (self.progress, self.results, self.pairs, self.partial):
            snapshot.finish(plain=snapshot in (self.pairs, self.partial))
        progress, results = tables.read_progress(self.log.state), tables.read_results(self.log.results)
        one = views.run_metadata(self.todo, progress, results, self.step.name, "complete", self.log.clock().isoformat()).first().asDict()
        if one["completed_or_terminal_units"] < one["total_units"]:
            one["status"] = "retryable_incomplete"
        tables.write_json(self.log.state, one, "metadata", self.log.run, self.log.stamp())
        if self.step.runtime.cleanup_artifacts:
            self.log.prune(self.step.runtime.artifact_retention_mode, self.step.runtime.keep_last, tuple(self.log.newest))
            results = tables.read_results(self.log.results)  # without the deltas that have just gone
        return results
