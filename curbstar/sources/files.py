"""Small files and folders in whatever store the session reads, through Hadoop's file systems."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str):
    """Hadoop's path and its file system, whatever the store."""
    context = spark.sparkContext
    own = context._jvm.org.apache.hadoop.fs.Path(path)
    return own, own.getFileSystem(context._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    own, files = located(spark, path)
    return files.exists(own)


def delete(spark: SparkSession, path: str) -> None:
    own, files = located(spark, path)
    files.delete(own, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    own, files = located(spark, folder)
    return sorted(entry.getPath().getName() for entry in files.listStatus(own)) if files.exists(own) else []


def read_text(spark: SparkSession, path: str) -> str:
    own, files = located(spark, path)
    stream = files.open(own)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file unless there is one; False if there is. Readers see all of it or nothing.

    The text goes to a file of its own first, which then gets the name in one step: by a link on a
    local or mounted file system, else by a rename that refuses to overwrite.
    """
    jvm = spark.sparkContext._jvm
    target, files = located(spark, path)
    files.mkdirs(target.getParent())
    folder = files.resolvePath(target.getParent())
    target = jvm.org.apache.hadoop.fs.Path(folder, target.getName())
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    beside = jvm.org.apache.hadoop.fs.Path(folder, f".{target.getName()}-{uuid.uuid4().hex}")
    stream = files.create(beside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if target.toUri().getScheme() == "file":
            java_path = jvm.java.nio.file.Paths.get
            place = spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)
            jvm.java.nio.file.Files.createLink(
                java_path(target.toUri().getPath(), place), java_path(beside.toUri().getPath(), place)
            )
        else:
            options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            context = jvm.org.apache.hadoop.fs.FileContext
            hadoop = spark.sparkContext._jsc.hadoopConfiguration()
            context.getFileContext(target.toUri(), hadoop).rename(beside, target, options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        files.delete(beside, False)
    return True
