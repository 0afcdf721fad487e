"""Folders of a shared file system, through Spark's own file system layer, so any store that Spark reads will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder in order; none where there is no folder."""
    files, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return bool(files.exists(place))


def delete(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)


def mark_complete(spark: SparkSession, path: str) -> None:
    """Say that a folder of several tables was written to its end, as Spark's writers say it of one."""
    files, place = _at(spark, f"{path}/_SUCCESS")
    files.create(place, True).close()


def generations(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the folders ``generation=N`` that were written to their end, ascending."""
    found = [int(n.removeprefix("generation=")) for n in names(spark, path) if n.startswith("generation=")]
    return sorted(n for n in found if exists(spark, f"{path}/generation={n}/_SUCCESS"))
