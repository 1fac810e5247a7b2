"""Small files through Hadoop's file systems: what the commit log and clean-up need.

Everything goes through the file system that the path's scheme names, so it
works wherever Spark reads.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system, Hadoop path) of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def children(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    """(name, is a folder, time of change in ms) of what lies in a folder; nothing if there is none."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), bool(s.isDirectory()), int(s.getModificationTime())) for s in fs.listStatus(p)]


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write_text(fs, p, text: str) -> None:
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text``, whole or not at all; False if it is there already.

    The text is written beside it first. A rename that refuses an existing
    target then publishes it, in one step on HDFS and the like; a local file
    system, whose rename replaces, gets a hard link, which refuses too. Object
    stores without either need a file system that offers such a rename.
    """
    jvm = spark.sparkContext._jvm
    fs, p = file_system(spark, path)
    fs.mkdirs(p.getParent())
    beside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}.tmp")
    _write_text(fs, beside, text)
    try:
        if fs.getUri().getScheme() == "file":
            there = [jvm.java.nio.file.Paths.get(x.toUri().getPath(), _array(spark, jvm.java.lang.String)) for x in (p, beside)]
            jvm.java.nio.file.Files.createLink(*there)
        else:
            whole = fs.makeQualified(p)
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                whole.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
            )
            option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            context.rename(fs.makeQualified(beside), whole, _array(spark, option))
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(beside, False)


def _array(spark: SparkSession, kind):
    return spark.sparkContext._gateway.new_array(kind, 0)
