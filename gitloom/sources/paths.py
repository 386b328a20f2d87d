"""File-system helpers that work on every file system Spark knows."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def rename(spark: SparkSession, path: str, target: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    if not fs.rename(hadoop_path, _file_system(spark, target)[1]):
        raise OSError(f"could not rename {path} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file that appears whole: written beside its place and renamed."""
    beside = f"{path}.tmp"
    fs, hadoop_path = _file_system(spark, beside)
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    rename(spark, beside, path)
