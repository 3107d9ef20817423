"""Names of files and folders below a path, as the session's file systems list them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = file_system(spark, path)
    return files.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a path, in order; none where it does not exist."""
    files, place = file_system(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(place)) if files.exists(place) else []


def holds_rows(spark: SparkSession, path: str) -> bool:
    return any(name.endswith(".parquet") for name in names(spark, path))


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether anything fits a pattern with ``*``."""
    files, place = file_system(spark, pattern)
    return bool(files.globStatus(place))


def rename(spark: SparkSession, path: str, new: str) -> None:
    files, place = file_system(spark, path)
    if not files.rename(place, file_system(spark, new)[1]):
        raise OSError(f"{path} could not be renamed to {new}")


def delete(spark: SparkSession, path: str) -> None:
    files, place = file_system(spark, path)
    files.delete(place, True)
