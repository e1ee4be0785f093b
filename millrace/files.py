"""Small file-system steps through Hadoop's API, so any store Spark reads works."""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob names anything at all."""
    fs, target = _path(spark, pattern)
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


def delete(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.delete(target, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``."""
    fs, target = _path(spark, path)
    if not fs.exists(target):
        return []
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file."""
    fs, target = _path(spark, path)
    out = fs.create(target, False)
    try:
        out.write(text.encode("utf-8"))
    finally:
        out.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of everything right below ``path``."""
    fs, target = _path(spark, path)
    if not fs.exists(target):
        return []
    return [s.getPath().getName() for s in fs.listStatus(target)]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, target = _path(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Put a whole small file in place unless there is one; tells whether it did.

    The text is written beside it, then renamed without overwriting.
    """
    jvm = spark.sparkContext._jvm
    side = f"{path}.{uuid.uuid4().hex}"
    write_text(spark, side, text)
    hadoop = jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(side), hadoop.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    context = hadoop.FileContext.getFileContext(fs.getUri(), fs.getConf())
    plain = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(source), fs.makeQualified(target), plain)
    except Py4JJavaError as error:
        delete(spark, side)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def age(spark: SparkSession, path: str) -> dt.timedelta:
    """Time since the last change of a file or folder."""
    fs, target = _path(spark, path)
    changed = fs.getFileStatus(target).getModificationTime()
    now = spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
    return dt.timedelta(milliseconds=now - changed)
