"""Path questions, asked of whatever Hadoop file system a URI names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def join(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *(p.strip("/") for p in parts[1:])])


def parent(path: str) -> str:
    return path.rstrip("/").rpartition("/")[0]


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """False only for a path that is absent; refused or failed access raises."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a directory; none if it is absent."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern names, in one call."""
    fs, p = _fs(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file appear whole, if there is none of its name; False if there is.

    The text is written aside and renamed without replacing, which HDFS does in
    one step; a store where a rename copies needs one that refuses a second put.
    """
    fs, p = _fs(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    aside = hadoop.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(p), options)
    except Exception:
        fs.delete(aside, False)
        if fs.exists(p):
            return False
        raise
    return True
