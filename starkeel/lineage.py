"""Cutting lineage through storage that outlives executors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .sources import files


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory.

    A cluster names a shared one in ``spark.checkpoint.dir``. Only a local
    session without one gets a folder below its warehouse; a cluster without one
    is refused, since a machine's own folder would be lost with the machine.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared directory")
        named = files.join(spark.conf.get("spark.sql.warehouse.dir"), "_staging")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and continue from the stored result."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _write_aside(df: DataFrame, name: str, root: str | None) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = files.join(root or checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like :func:`cut`, but columnar and with statistics; stays in the checkpoint directory."""
    return _write_aside(df, name, None)[0]


@contextmanager
def staged(df: DataFrame, name: str, root: str | None = None) -> Iterator[DataFrame]:
    """Write ``df`` as a table aside, yield it as read back, remove it afterwards.

    For results that several later steps read: unlike a checkpoint the table is
    columnar, so each step reads only the columns it needs. ``root`` is a shared
    folder to use instead of the checkpoint directory.
    """
    table, path = _write_aside(df, name, root)
    try:
        yield table
    finally:
        files.delete(df.sparkSession, path)
