"""Small-file operations on any file system Spark can reach."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target, spark.sparkContext._jsc.hadoopConfiguration()


def exists(spark: SparkSession, path: str) -> bool:
    _, target, conf = _hadoop(spark, path)
    return target.getFileSystem(conf).exists(target)


def size_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored below a folder."""
    _, target, conf = _hadoop(spark, path)
    return target.getFileSystem(conf).getContentSummary(target).getLength()


def read_json(spark: SparkSession, path: str) -> dict | None:
    """Content of a small JSON file, None if there is none."""
    jvm, target, conf = _hadoop(spark, path)
    fs = target.getFileSystem(conf)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if it does not exist."""
    _, target, conf = _hadoop(spark, folder)
    fs = target.getFileSystem(conf)
    return [f.getPath().getName() for f in fs.listStatus(target)] if fs.exists(target) else []


def complete(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the tables in a folder whose writing has ended."""
    return [f"{folder}/{n}" for n in names(spark, folder) if exists(spark, f"{folder}/{n}/_SUCCESS")]


def create_json(spark: SparkSession, path: str, content: dict) -> bool:
    """Create a small JSON file, whole at once; False if the path is taken.

    The file is written aside and then given its name, which fails if the name exists:
    by a hard link on a local file system, by a rename elsewhere. The rename must be
    atomic, as it is on HDFS.
    """
    jvm, target, conf = _hadoop(spark, path)
    fs = target.getFileSystem(conf)
    fs.mkdirs(target.getParent())
    staged = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(staged, False)
    try:
        stream.write(bytearray(json.dumps(content, sort_keys=True).encode("utf-8")))
    finally:
        stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            link, source = (jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, staged))
            jvm.java.nio.file.Files.createLink(link, source)
        else:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(
                staged, target, spark.sparkContext._gateway.new_array(
                    jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(staged, False)


def remove(spark: SparkSession, path: str) -> None:
    _, target, conf = _hadoop(spark, path)
    target.getFileSystem(conf).delete(target, True)
