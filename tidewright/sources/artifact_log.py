"""A step's results log as a Spark data source: ``spark.read.format("artifact_log").load(<results folder>)``.

The reader plans its partitions from footers: the newest checkpoint, and of the deltas those files whose last ``seq`` is beyond what it covers, in the order
of ``seq``. Covered deltas are never opened by a task. Rows are those of the log; the last of each unit and output column is its result. As for
``operators.asking``, the folder must be one that pyarrow's file systems open.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidewright.functions.schemas import RESULT
from tidewright.operators.state import latest_results

CHECKPOINT, DELTA = "results_checkpoint", "results_delta"
BYTES_A_PARTITION = 128 << 20


@dataclass
class Files(InputPartition):
    """Files of one partition, with the last ``seq`` that is not read of them."""

    paths: list[str]
    after: int | None


class LogReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str], schema: StructType):
        self.path, self.schema = options["path"], schema

    def _open(self) -> tuple[files.FileSystem, str]:
        uri = self.path if "://" in self.path or self.path.startswith("/") else self.path.replace("file:", "file://", 1)
        return files.FileSystem.from_uri(uri)

    def _found(self, fs: files.FileSystem, root: str) -> list[files.FileInfo]:
        """Parquet files below a folder, hidden ones left out."""
        listed = fs.get_file_info(files.FileSelector(root, recursive=True))
        return [f for f in listed if f.is_file and f.base_name.endswith(".parquet") and not f.base_name.startswith(("_", "."))]

    def _last(self, fs: files.FileSystem, path: str) -> int | None:
        """The largest ``seq`` of a file, from its footer; None for no rows or no such column."""
        footer = pq.ParquetFile(path, filesystem=fs).metadata
        names = [footer.schema.column(k).name for k in range(footer.num_columns)]
        if "seq" not in names or not footer.num_rows:
            return None
        told = [footer.row_group(k).column(names.index("seq")).statistics for k in range(footer.num_row_groups)]
        if all(t is not None and t.has_min_max for t in told):
            return max(t.max for t in told)
        return pc.max(pq.read_table(path, columns=["seq"], filesystem=fs)["seq"]).as_py()

    def partitions(self) -> list[Files]:
        fs, root = self._open()
        names = sorted(f.base_name for f in fs.get_file_info(files.FileSelector(root)))
        known = [n for n in names if n.startswith(f"{CHECKPOINT}__run_") and n.endswith(".parquet")]
        known += [n for n in names if n.startswith(f"{CHECKPOINT}_buckets__run_") and n.endswith(".json")]
        base, covered = [], None
        if known:
            newest = max(known, key=lambda n: n.rsplit("__", 1)[1].split(".")[0])
            if newest.endswith(".json"):
                with fs.open_input_stream(f"{root}/{newest}") as text:
                    told = json.loads(text.read())
                covered, base = told["seq"], [f for k, n in told["buckets"].items() for f in self._found(fs, f"{root}/{n}/bucket__={k}")]
            else:
                base = self._found(fs, f"{root}/{newest}")
                covered = max((s for f in base if (s := self._last(fs, f.path)) is not None), default=None)
        deltas = [(self._last(fs, f.path), f) for n in names if n.startswith(f"{DELTA}__run_") for f in self._found(fs, f"{root}/{n}")]
        newer = [f for s, f in sorted(deltas, key=lambda x: (x[0] is None, x[0] or 0, x[1].path)) if s is not None and (covered is None or s > covered)]
        return [*self._dealt(base, None), *self._dealt(newer, covered)] or [Files([], None)]

    def _dealt(self, found: list[files.FileInfo], after: int | None) -> Iterator[Files]:
        paths, size = [], 0
        for f in found:
            paths.append(f.path)
            size += f.size or 0
            if size >= BYTES_A_PARTITION:
                yield Files(paths, after)
                paths, size = [], 0
        if paths:
            yield Files(paths, after)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = self._open()
        wanted = to_arrow_schema(self.schema)
        for path in partition.paths:
            for batch in pq.ParquetFile(path, filesystem=fs).iter_batches():
                have = set(batch.schema.names)
                columns = [batch.column(f.name).cast(f.type) if f.name in have else pa.nulls(batch.num_rows, f.type) for f in wanted]
                whole = pa.RecordBatch.from_arrays(columns, schema=wanted)
                yield whole if partition.after is None else whole.filter(pc.greater(whole.column("seq"), partition.after))


class ArtifactLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "artifact_log"

    def schema(self) -> StructType:
        return RESULT

    def reader(self, schema: StructType) -> LogReader:
        return LogReader(self.options, schema)


def read_log(spark: SparkSession, uri: str) -> DataFrame:
    """The results in a folder, as ``tables.read_results`` gives them."""
    spark.dataSource.register(ArtifactLog)
    return latest_results(spark.read.format("artifact_log").load(uri))
