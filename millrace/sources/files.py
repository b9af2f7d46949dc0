"""Folders of a table, through the file system Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder unless it is there; a stream cannot watch one that is not."""
    _system(spark, path).mkdirs(_path(spark, path))


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the ``column=value`` folders directly under ``path``; a missing path raises."""
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    names = [entry.getPath().getName() for entry in _system(spark, path).listStatus(_path(spark, path))]
    return sorted(unescape(name.split("=", 1)[1]) for name in names if name.startswith(f"{column}="))


# Folder of rows whose partition value is NULL or empty text.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partition_path(spark: SparkSession, path: str, column: str, value: str | None) -> str:
    """Folder of a partition; ``None`` is the partition of rows without a value."""
    if value is None or value == "":
        return f"{path}/{column}={NO_VALUE}"
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{path}/{column}={escape(value)}"


def drop_partition(spark: SparkSession, path: str, column: str, value: str | None) -> None:
    """Remove one partition folder; a folder that is already gone is fine."""
    folder = partition_path(spark, path, column, value)
    _system(spark, folder).delete(_path(spark, folder), True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    return _system(spark, path).getContentSummary(_path(spark, path)).getLength()


def drop_folders(spark: SparkSession, *paths: str) -> None:
    """Remove folders of staged rows whose consumer has committed."""
    for path in paths:
        _system(spark, path).delete(_path(spark, path), True)
