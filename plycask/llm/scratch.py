"""Tables between the jobs of one operator, in the folder that all executors share.

The folder is the one the cluster names in ``spark.checkpoint.dir``; a temporary folder
is taken only where that setting is missing and all runs on this machine.  What is still there
when the driver's Python ends is deleted then, as returned DataFrames read it lazily.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def root(spark: SparkSession) -> str:
    """The shared folder, with no slash at its end."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not named:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"{_SETTING} must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="plycask-")
        spark.conf.set(_SETTING, named)
    return named.rstrip("/")


class Scratch:
    """Parquet tables of one call of an operator, under a name that no other call uses."""

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.path = f"{root(spark)}/plycask/{operator}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def save(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        """Writes df once and returns a DataFrame over the files, whose lineage is a scan."""
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.at(name))
        self.collect_garbage()
        return self.read(name, df.schema)

    def read(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.at(name))

    def collect_garbage(self) -> None:
        """Lets Spark delete the shuffle files of jobs that are over; it does so only for plans that are no longer referred to."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, name: str = "") -> None:
        """Deletes one table, or all; a session that has ended is no error here, as this also runs at exit."""
        sc = self.spark.sparkContext
        if sc._jsc is None:
            return
        path = sc._jvm.org.apache.hadoop.fs.Path(self.at(name) if name else self.path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
