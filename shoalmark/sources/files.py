"""Small files in the shared folder: what a crawl leaves for the engine, written and listed through Hadoop's file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from ..operators.graph import checkpoint_dir


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared one, which goes when the application ends."""
    path = f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"
    at, fs = _fs(spark, path)
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    return path


def put(spark: SparkSession, path: str, content: str | bytes) -> str:
    """Writes a file whole: under another name first, so that readers see all of it or nothing."""
    fresh, fs = _fs(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(fresh, True)
    stream.write(bytearray(content.encode() if isinstance(content, str) else content))
    stream.close()
    at, _ = _fs(spark, path)
    fs.delete(at, False)
    if not fs.rename(fresh, at):
        raise OSError(f"{path} could not be written")
    return path


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names of the files of a folder, in order; none if it isn't there."""
    at, fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isFile()) if fs.exists(at) else []


def text(spark: SparkSession, path: str) -> str:
    """A small file's text, whatever its name begins with."""
    at, fs = _fs(spark, path)
    stream = fs.open(at)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
