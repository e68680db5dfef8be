"""Small files and folders of the shared file system, through Spark's own file system layer.

For what a job's driver does itself: name folders, take a number, remove what nobody reads any more.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _caused_by(error: Py4JJavaError, name: str) -> bool:
    return error.java_exception.getClass().getName().endswith(name)


def children(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """Names in a folder, sorted, and whether each is a folder itself; a missing folder has none."""
    system, path = _opened(spark, folder)
    try:
        return sorted((x.getPath().getName(), x.isDirectory()) for x in system.listStatus(path))
    except Py4JJavaError as error:
        if _caused_by(error, "FileNotFoundException"):
            return []
        raise


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _opened(spark, path)
    return system.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all in it; a missing one is as good as removed."""
    system, where = _opened(spark, path)
    system.delete(where, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    system, where = _opened(spark, path)
    if not system.rename(where, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"could not move {path} to {to}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    system, where = _opened(spark, path)
    stream = system.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in place of one that is there."""
    system, where = _opened(spark, path)
    stream = system.create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one; of several writers one succeeds, and no reader sees half a file.

    The text is written beside and then takes the name: by a link on a local disk, else by the file system's
    rename that refuses to replace. As atomic as that rename, which on HDFS it is.
    """
    folder, name = path.rsplit("/", 1)
    beside = f"{folder}/.{name}.{uuid.uuid4().hex}"
    write_text(spark, beside, text)
    try:
        parsed = urlparse(path)
        if parsed.scheme in ("", "file"):
            try:
                os.link(urlparse(beside).path, parsed.path)
            except FileExistsError:
                return False
            return True
        hadoop = spark._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(hadoop.Path(path).toUri(), spark._jsc.hadoopConfiguration())
        options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        options[0] = hadoop.Options.Rename.NONE
        try:
            context.rename(hadoop.Path(beside), hadoop.Path(path), options)
        except Py4JJavaError as error:
            if _caused_by(error, "FileAlreadyExistsException"):
                return False
            raise
        return True
    finally:
        remove(spark, beside)
