"""Small file operations on whatever file system a path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _at(spark, path)
    return system.exists(target)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names inside a folder, sorted; none if it is absent."""
    target, system = _at(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(target)) \
        if system.exists(target) else []


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all that it holds."""
    target, system = _at(spark, path)
    system.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    target, system = _at(spark, path)
    stream = system.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Give a small file new content in one step: readers see the old text or the new one."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fresh, system = _at(spark, f"{path}.{uuid.uuid4().hex}")
    target, _ = _at(spark, path)
    stream = system.create(fresh)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    option = jvm.org.apache.hadoop.fs.Options.Rename
    choice = gateway.new_array(option, 1)
    choice[0] = option.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(system.makeQualified(fresh), system.makeQualified(target), choice)
