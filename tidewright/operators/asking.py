"""Requests of a wave, whose answers every task saves while it goes on asking.

The write of a Python data source asks: a task takes its groups one by one and saves a Parquet file of answers after so many units, groups or
seconds (``Flush``), and asks no more once the deadline has passed. A task that is lost loses what it has not saved; its next
attempt reads what is there and asks only the rest. Beside the answers each task keeps its figures in a small JSON file, so a wave can be watched
while it runs and summed up without reading the answers again.

Files are written by pyarrow's file systems, as tasks in Python do not reach Hadoop's; the folder must be one that these open.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as files
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidewright.functions.schemas import DEBUG, coerce
from tidewright.operators.responses import Adapter, TaskHandler, answer_group, whole_groups

ANSWERS, FIGURES = "answers", "figures"
COUNTS = ("units", "failed_units", "flagged_units", "requests", "transport_failures", "unasked_units", "files")
TRACE = StructType([f for f in DEBUG.fields if f.name != "seq"]).add("retry_count", "long").add("outputs", "string")


@dataclass(frozen=True)
class Flush:
    """A task saves its answers after so many units, groups or seconds, whichever comes first."""

    units: int = 50
    groups: int = 8
    seconds: float = 60.0


class TaskFiles:
    """The files of one task in a wave's folder: answers saved so far, by this attempt or earlier ones, and their figures."""

    def __init__(self, uri: str, task: int, attempt: int):
        self.fs, self.root = files.FileSystem.from_uri(uri)
        self.task, self.attempt, self.since = task, attempt, 0
        for name in (ANSWERS, FIGURES):
            self.fs.create_dir(f"{self.root}/{name}")
        self.counts = dict.fromkeys(COUNTS, 0)
        self.answered: set[str] = set()
        for found in self.fs.get_file_info(files.FileSelector(f"{self.root}/{ANSWERS}")):
            if found.base_name.startswith(f"part-{task:05}-"):
                self._count(pq.read_table(found.path, schema=to_arrow_schema(TRACE), filesystem=self.fs).to_pylist())

    def _count(self, rows: list[dict]) -> None:
        requests = {r["request_group_id"]: r["review_reason"] == "group_transport_failure" for r in rows}
        more = (len(rows), sum(r["status"] != "success" for r in rows), sum(bool(r["review_flag"]) for r in rows), len(requests), sum(requests.values()), 0, 1)
        for name, n in zip(COUNTS, more, strict=True):
            self.counts[name] += n
        self.answered.update(r["unit_id"] for r in rows)

    def save(self, rows: list[dict]) -> None:
        """A file that is there whole or not at all."""
        told = [{f.name: coerce(r.get(f.name), f.dataType) for f in TRACE.fields} for r in rows]
        name = f"part-{self.task:05}-{self.attempt:03}-{self.since:06}.parquet"
        pq.write_table(pa.Table.from_pylist(told, to_arrow_schema(TRACE)), f"{self.root}/{ANSWERS}/_{name}", filesystem=self.fs, compression="zstd")
        self.fs.move(f"{self.root}/{ANSWERS}/_{name}", f"{self.root}/{ANSWERS}/{name}")
        self.since += 1
        self._count(told)

    def tell(self) -> None:
        with self.fs.open_output_stream(f"{self.root}/{FIGURES}/task-{self.task:05}.json") as out:
            out.write(json.dumps({"task": self.task, **self.counts, "told_at": time.time()}).encode())


@dataclass
class Saved(WriterCommitMessage):
    counts: dict


class AnswerWriter(DataSourceArrowWriter):
    """Asks for the groups of a task."""

    def __init__(self, options: Mapping[str, str], make_adapter: Callable[[], Adapter], make_handler: Callable[[], TaskHandler], step: Mapping, context: Mapping):
        self.path, self.now, self.deadline = options["path"], options["now"], float(options["deadline"])
        self.flush = Flush(int(options["units"]), int(options["groups"]), float(options["seconds"]))
        self.make_adapter, self.make_handler, self.step, self.context = make_adapter, make_handler, step, context

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Saved:
        at = TaskContext.get()
        saved = TaskFiles(self.path, at.partitionId(), at.attemptNumber())
        adapter, handler = self.make_adapter(), self.make_handler()
        rows: list[dict] = []
        groups, since = 0, time.time()
        for units in whole_groups(batch.to_pylist() for batch in iterator):
            if saved.answered.issuperset(u["unit_id"] for u in units):
                continue
            if time.time() >= self.deadline:
                saved.counts["unasked_units"] += len(units)
                continue
            rows += answer_group(units, adapter, handler, self.step, self.context, self.now)
            groups += 1
            if len(rows) >= self.flush.units or groups >= self.flush.groups or time.time() - since >= self.flush.seconds:
                saved.save(rows)
                saved.tell()
                rows, groups, since = [], 0, time.time()
        if rows:
            saved.save(rows)
        saved.tell()
        return Saved(saved.counts)


def answering(name: str, make_adapter: Callable[[], Adapter], make_handler: Callable[[], TaskHandler], step: Mapping, context: Mapping) -> type[DataSource]:
    """A data source of this name to write groups to."""

    class Answering(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema: StructType, overwrite: bool) -> AnswerWriter:
            return AnswerWriter(self.options, make_adapter, make_handler, step, context)

    return Answering


def ask(groups: DataFrame, source: str, uri: str, now: str, deadline: float, tasks: int, flush: Flush | None = None) -> None:
    """Asks for groups (units with ``group_id`` and ``retry_count``) until ``deadline`` (seconds since 1970). ``source`` is registered. ``tasks``
    tasks ask at a time, each with one adapter for all of its groups."""
    when, spark = flush or Flush(), groups.sparkSession
    # Spark looks a source up in the thread's active session, which in a batch of a stream is a copy from before the source was registered.
    spark._jvm.org.apache.spark.sql.SparkSession.setActiveSession(spark._jsparkSession)
    dealt = groups.repartition(tasks, "group_id").sortWithinPartitions("group_id", "unit_id")
    options = {"path": uri, "now": now, "deadline": repr(deadline), "units": when.units, "groups": when.groups, "seconds": when.seconds}
    dealt.write.format(source).mode("append").options(**options).save()


def answers(spark: SparkSession, path: str) -> DataFrame:
    """What is saved so far."""
    return spark.read.schema(TRACE).parquet(f"{path}/{ANSWERS}")


def figures(spark: SparkSession, path: str) -> dict[str, int]:
    """Sums over the tasks so far, while they run or after it: a row a task is read."""
    told = spark.read.schema(", ".join(["task int", *(f"{c} long" for c in COUNTS), "told_at double"])).json(f"{path}/{FIGURES}")
    return told.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS]).first().asDict()
