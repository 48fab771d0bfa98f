"""Tables that cut a lineage or fix an order, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Unset, a local master gets a temporary folder; a cluster must name one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return _OWN.setdefault("folder", "file://" + tempfile.mkdtemp(prefix="spark-step-"))


def new_folder(spark: SparkSession, kind: str) -> str:
    """A folder that nothing else has. It stays until the caller deletes it, as results read it."""
    return f"{shared_folder(spark)}/{kind}/{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str = "scratch") -> DataFrame:
    """df, from a table that it is written to once."""
    path = new_folder(df.sparkSession, kind)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
