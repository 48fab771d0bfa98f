"""Tables that cut a lineage, in the folder that the cluster shares."""

from __future__ import annotations

import gc
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
    if "folder" not in _OWN:
        _OWN["folder"] = "file://" + tempfile.mkdtemp(prefix="spark-tidewright-")
    return _OWN["folder"]


class Workspace:
    """A folder for one run of one operator. The tables a result reads stay until the caller drops the folder."""

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/tidewright/{operator}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = (), group_bytes: int = 128 << 20) -> DataFrame:
        """Writes a table in row groups of about ``group_bytes``, which are read as wholes, and reads it back."""
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").options(**{"compression": "zstd", "parquet.block.size": group_bytes}).partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path) if not partition_by else self.spark.read.parquet(path)

    def drop(self, name: str = "") -> None:
        """Deletes a table that nothing reads any more, or the whole folder."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop_all_but(self, *names: str) -> None:
        """Deletes the folder's tables but for those that a result still reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for found in fs.listStatus(path) if fs.exists(path) else ():
            if found.getPath().getName() not in names:
                fs.delete(found.getPath(), True)

    def release(self) -> None:
        """Asks the driver to collect the plans of finished jobs. Spark deletes a job's shuffle files only once its plan is collected, which
        may be long after the tables that were made of them are written."""
        gc.collect()
        self.spark._jvm.System.gc()
