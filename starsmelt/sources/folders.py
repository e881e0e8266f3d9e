"""Folders and small files on whatever file system the session uses."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system, system.makeQualified(folder)


def qualified(spark: SparkSession, path: str) -> str:
    """The full name of a path, with its file system."""
    return _resolve(spark, path)[1].toString()


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _resolve(spark, path)
    return system.exists(folder)


def names(spark: SparkSession, path: str) -> dict[str, int]:
    """What a folder holds, and when each was last changed, in milliseconds; nothing if it is missing."""
    system, folder = _resolve(spark, path)
    if not system.exists(folder):
        return {}
    return {found.getPath().getName(): found.getModificationTime() for found in system.listStatus(folder)}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and what it holds, if it is there."""
    system, folder = _resolve(spark, path)
    system.delete(folder, True)


def read_text(spark: SparkSession, path: str) -> str:
    system, file = _resolve(spark, path)
    stream = system.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file at once and whole; False if there is one of that name, which stays.

    It is written under another name first. The rename never replaces, and of two writers one fails.
    """
    jvm = spark.sparkContext._jvm
    system, target = _resolve(spark, path)
    system.mkdirs(target.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}.draft")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    never_replace = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, target, never_replace)
    except Py4JJavaError as failure:
        system.delete(draft, False)
        if "FileAlreadyExistsException" in failure.java_exception.getClass().getName():
            return False
        raise
    return True
