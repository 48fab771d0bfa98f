"""Pipelines: steps that are functions of DataFrames, or model steps, over a folder of Parquet files."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidewright.operators.units import field_list
from tidewright.plans.settings import ModelStep
from tidewright.plans.waves import run_step
from tidewright.sources import tables

MODES = ("global", "batch")


@dataclass(frozen=True)
class FunctionStep:
    function: Callable[..., DataFrame]
    arguments: Mapping = field(default_factory=dict)


@dataclass(frozen=True)
class Pipeline:
    name: str
    steps: Sequence[FunctionStep | ModelStep]
    mode: str = "global"
    data_type: str = "tabular"
    columns: object = "*"
    batch_size: int = 1

    def __post_init__(self):
        if not self.name or not self.steps:
            raise ValueError("a pipeline has a name and steps")
        if self.mode not in MODES:
            raise ValueError(f"mode {self.mode!r} is none of {MODES}")
        field_list(self.columns)
        tables.loader(self.data_type)


def single_task(name: str, function: Callable[[DataFrame], DataFrame], **options) -> Pipeline:
    return Pipeline(name, [FunctionStep(function)], **options)


def load_pipeline(path: str) -> Pipeline:
    """The ``PIPELINE`` of a Python file, or its ``run`` function as a single task with the settings of ``TASK``."""
    spec = importlib.util.spec_from_file_location("user_pipeline", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    if isinstance(getattr(module, "PIPELINE", None), Pipeline):
        return module.PIPELINE
    if callable(getattr(module, "run", None)) and isinstance(getattr(module, "TASK", None), dict):
        return single_task(function=module.run, **module.TASK)
    raise ValueError(f"{path} has neither a PIPELINE nor TASK and run")


def run_steps(steps: Sequence[FunctionStep | ModelStep], data: DataFrame, work: tables.Folder, run: str) -> DataFrame:
    for k, step in enumerate(steps):
        if isinstance(step, ModelStep):
            data = run_step(data, step, work.ensure_subdir(step.name), run)
        else:
            data = step.function(data, **step.arguments)
        if not isinstance(data, DataFrame):
            raise TypeError(f"step {k} returned {type(data).__name__}, not a DataFrame")
    return data


def run_pipeline(spark: SparkSession, pipeline: Pipeline, source: str, destination: str, output: str, run: str) -> list[str]:
    """Runs over all files at once, or in batches of files. Returns the paths of the outputs. State is shared by the batches, so
    keys must be unique over all files."""
    inputs, target = tables.Folder(spark, source), tables.Folder(spark, destination)
    work = target.ensure_subdir(pipeline.name)
    load = tables.loader(pipeline.data_type)
    files = [f"{source}/{n}" for n in inputs.list_objects() if n.endswith(".parquet")]
    if not files:
        raise FileNotFoundError(f"no Parquet file in {source}")
    batches = [("", files)] if pipeline.mode == "global" else [(f"_batch_{k}", paths) for k, paths in tables.file_batches(inputs, pipeline.batch_size)]
    written = []
    for suffix, paths in batches:
        path = f"{destination}/{output}{suffix}_{run}.parquet"
        tables.save(run_steps(pipeline.steps, load(spark, paths, pipeline.columns), work, run), path)
        written.append(path)
    return written
