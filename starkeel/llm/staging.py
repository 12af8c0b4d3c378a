"""Tables written in the shared folder, so that no later step depends on an executor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources import files


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; below the warehouse in a local session without one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared directory")
    return named or files.join(spark.conf.get("spark.sql.warehouse.dir"), "_staging")


class Workspace:
    """Intermediate tables of one run of an operator, in a folder of its own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = files.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")

    def write(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        """Store ``df`` as Parquet and continue from the stored table."""
        path = files.join(self.root, name)
        df.write.parquet(path, compression=compression)
        return self.spark.read.schema(df.schema).parquet(path)

    def append(self, df: DataFrame, name: str) -> None:
        """Add the rows of ``df`` to a stored table."""
        df.write.mode("append").parquet(files.join(self.root, name))

    def read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(files.join(self.root, name))

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more."""
        for name in names:
            files.delete(self.spark, files.join(self.root, name))

    def keep(self, *names: str) -> None:
        """Remove all tables but these."""
        self.drop(*(set(files.children(self.spark, self.root)) - set(names)))
