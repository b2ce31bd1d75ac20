"""Questions about paths, asked through Hadoop's file system so any URI works."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system, Hadoop path) of a path."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none when it is absent."""
    fs, hadoop_path = file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    fs, hadoop_path = file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that is there as a whole or not at all; an existing one is an error.

    It is written under another name and renamed, which is one step in the file system.
    """
    folder, name = path.rsplit("/", 1)
    fs, target = file_system(spark, path)
    _, aside = file_system(spark, f"{folder}/_{uuid.uuid4().hex}-{name}")
    stream = fs.create(aside, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise FileExistsError(path)


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = file_system(spark, path)
    fs.delete(hadoop_path, True)
