"""Tables and artifacts in folders of any file system that Spark reads."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewright.functions.schemas import DEBUG, PROGRESS, RESULT, append_all, conform
from tidewright.operators.state import latest_progress, latest_results, replay
from tidewright.operators.units import field_list


class Folder:
    """A place for objects, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._api = spark._jvm.org.apache.hadoop.fs
        self._fs = self._api.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._api.Path(f"{self.path}/{name}" if name else self.path)

    def list_objects(self) -> list[str]:
        """Names, hidden ones left out."""
        if not self._fs.exists(self._at("")):
            return []
        return sorted(n for s in self._fs.listStatus(self._at("")) if not (n := s.getPath().getName()).startswith(("_", ".")))

    def ensure_subdir(self, name: str) -> Folder:
        self._fs.mkdirs(self._at(name))
        return Folder(self.spark, f"{self.path}/{name}")

    def delete_object(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def upload_object(self, local: str, name: str) -> None:
        self._fs.copyFromLocalFile(False, True, self._api.Path(local), self._at(name))

    def download_object(self, name: str, local: str) -> None:
        self._fs.copyToLocalFile(False, self._at(name), self._api.Path(local), True)

    def write_text(self, name: str, text: str) -> None:
        """A file that is there whole or not at all."""
        out = self._fs.create(self._at(f"_{name}"), True)
        out.write(bytearray(text.encode()))
        out.close()
        self._fs.delete(self._at(name), False)
        self._fs.rename(self._at(f"_{name}"), self._at(name))

    def read_text(self, name: str) -> str:
        return self.spark.read.text(f"{self.path}/{name}", wholetext=True).first()[0]

    def uri(self, name: str) -> str:
        """The full address of an object, for readers other than Hadoop's."""
        text = self._fs.makeQualified(self._at(name)).toUri().toString()
        return text if not text.startswith("file:/") or text.startswith("file://") else f"file://{text.removeprefix('file:')}"


CONNECTORS = {"hadoop": Folder, "local": Folder}


def connector(kind: str, spark: SparkSession, path: str) -> Folder:
    if kind.lower() not in CONNECTORS:
        raise ValueError(f"connector {kind!r} is none of {sorted(CONNECTORS)}")
    return CONNECTORS[kind.lower()](spark, path)


def scan(spark: SparkSession, paths: str | Sequence[str], columns=None) -> DataFrame:
    """Parquet files as one table, with the columns asked for."""
    df = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    wanted = field_list(columns)
    return df.select(*wanted) if wanted else df


LOADERS = {"tabular": scan}


def loader(data_type: str):
    if data_type.lower() not in LOADERS:
        raise ValueError(f"data type {data_type!r} is none of {sorted(LOADERS)}")
    return LOADERS[data_type.lower()]


def save(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Writes a new table; never over another. ``one_file`` is for small results only."""
    if not isinstance(df, DataFrame):
        raise TypeError(f"a step's result is a DataFrame, not {type(df).__name__}")
    (df.coalesce(1) if one_file else df).write.mode("errorifexists").parquet(path)


def file_batches(folder: Folder, size: int) -> Iterator[tuple[int, list[str]]]:
    """Parquet files in slices of ``size``, numbered from 1."""
    if size < 1:
        raise ValueError("a batch has one file at least")
    names = [n for n in folder.list_objects() if n.endswith(".parquet")]
    for k in range(0, len(names), size):
        yield k // size + 1, [f"{folder.path}/{n}" for n in names[k : k + size]]


def artifact_name(family: str, run: str, stamp: str, extension: str = "parquet") -> str:
    """stamp: the time of writing, to the microsecond, as ``YYYYmmdd_HHMMSS_ffffff``."""
    return f"{family}__run_{run}__{stamp}.{extension}"


def write_artifact(folder: Folder, df: DataFrame, family: str, run: str, stamp: str, partition_by: Sequence[str] = ()) -> str:
    name = artifact_name(family, run, stamp)
    df.write.mode("errorifexists").option("compression", "zstd").partitionBy(*partition_by).parquet(f"{folder.path}/{name}")
    return name


def write_json(folder: Folder, payload: Mapping, family: str, run: str, stamp: str) -> str:
    name = artifact_name(family, run, stamp, "json")
    folder.write_text(name, json.dumps(payload, ensure_ascii=False, indent=2, default=str))
    return name


def artifacts(folder: Folder, family: str) -> list[str]:
    return [n for n in folder.list_objects() if n.startswith(f"{family}__run_") and n.endswith(".parquet")]


def newest_snapshot(folder: Folder, family: str) -> tuple[list[str], int | None]:
    """The paths of the newest state of a family: an artifact, or the buckets that a newer ``..._buckets`` file names. With such a file
    also the last ``seq`` that it covers."""
    listed = [n for n in folder.list_objects() if n.endswith(".json") and n.startswith(f"{family}_buckets__run_")]
    names = artifacts(folder, family) + listed
    if not names:
        return [], None
    name = max(names, key=lambda n: n.rsplit("__", 1)[1].split(".")[0])
    if name.endswith(".parquet"):
        return [f"{folder.path}/{name}"], None
    told = json.loads(folder.read_text(name))
    return [f"{folder.path}/{n}/bucket__={k}" for k, n in told["buckets"].items()], told["seq"]


def read_latest(folder: Folder, family: str, schema: StructType) -> DataFrame:
    """The newest state of a family in its schema; empty if there is none."""
    paths, _ = newest_snapshot(folder, family)
    if not paths:
        return folder.spark.createDataFrame([], schema)
    return conform(folder.spark.read.parquet(*paths), schema)


def read_progress(folder: Folder) -> DataFrame:
    """The newest snapshot and the deltas of single waves; of each unit, the last."""
    deltas = artifacts(folder, "progress_delta")
    known = read_latest(folder, "progress", PROGRESS)
    if not deltas:
        return known
    newer = folder.spark.read.parquet(*[f"{folder.path}/{n}" for n in deltas])
    return latest_progress(append_all([known, newer], PROGRESS))


def read_permanent_review(folder: Folder) -> DataFrame:
    return read_latest(folder, "permanent_review", DEBUG)


def read_results(folder: Folder) -> DataFrame:
    """The newest checkpoint and the deltas it does not cover. Without either, the newest of the older ``results_snapshot``
    files, or else all plain ``results_`` files."""
    spark, names = folder.spark, [n for n in folder.list_objects() if n.endswith(".parquet")]
    at = lambda some: conform(spark.read.parquet(*[f"{folder.path}/{n}" for n in some]), RESULT)
    deltas, (paths, covered) = artifacts(folder, "results_delta"), newest_snapshot(folder, "results_checkpoint")
    if not deltas and not paths:
        snapshots = [n for n in names if n.startswith("results_snapshot_")]
        older = [max(snapshots)] if snapshots else [n for n in names if n.startswith("results_")]
        # Files of older formats are few and may differ in columns, so each is read by itself.
        return latest_results(append_all([at([n]) for n in older], RESULT)) if older else spark.createDataFrame([], RESULT)
    logged = at(deltas) if deltas else spark.createDataFrame([], RESULT)
    if not paths:
        return replay(None, -1, logged)
    known = conform(spark.read.parquet(*paths), RESULT)
    if covered is None:
        covered = known.agg(F.max("seq")).first()[0]
    return replay(known, -1 if covered is None else covered, logged)


def prompt_context(folder: Folder, template: str, schema: str | None = None, notes: Sequence[str] = ()) -> dict:
    """Texts that prompts are made of. They are small and go to the workers with the task."""

    def text(name: str) -> str:
        return folder.spark.read.text(f"{folder.path}/{name}", wholetext=True).first()[0]

    shape = text(schema) if schema else None
    return {"template": text(template), "schema_text": shape, "schema": json.loads(shape) if shape else None, "notes": [text(n) for n in notes]}
