"""The folder for intermediate tables that every executor can read."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from sensorlake.sources.files import delete


def _of_application(spark: SparkSession) -> str:
    """The folder of this application below ``spark.checkpoint.dir``, or below the warehouse where that is unset.

    Spark's default warehouse lies on the driver's own disk, which only a local session shares
    with its executors; elsewhere such a folder is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir", None)
        # ``local`` and ``local[8]``, not ``local-cluster[...]``.
        one_machine = spark.sparkContext.master.split("[")[0] == "local"
        if not base or base.startswith(("file:", "/")) and not one_machine:
            raise RuntimeError("set spark.checkpoint.dir, or a shared spark.sql.warehouse.dir, to a folder that all executors share")
    return f"{base.rstrip('/')}/sensorlake-{spark.sparkContext.applicationId}"


def shared_folder(spark: SparkSession) -> str:
    """A new folder that every executor can read."""
    return f"{_of_application(spark)}/{uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application; results that were not written can't be read any more."""
    delete(spark, _of_application(spark))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table and read again: computed once, and not lost with an executor."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
