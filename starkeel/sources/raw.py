"""The raw zone: one directory per table and ingest date, CSV with a header.

    <root>/<table>/ingest_date=YYYY-MM-DD/*.csv
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.keys import as_date
from ..lineage import staged
from ..operators.conform import CORRUPT
from . import files

log = logging.getLogger(__name__)

# Doubled quotes inside quoted values, as CSV writers of most tools produce.
CSV = {"header": True, "quote": '"', "escape": '"'}


class MissingInput(FileNotFoundError):
    """A feed that should be there is not; never treated as an empty batch."""


def raw_path(root: str, table: str, day: str | dt.date) -> str:
    return files.join(root, table, f"ingest_date={as_date(day).isoformat()}")


def read_raw(
    spark: SparkSession, root: str, table: str, day: str | dt.date,
    schema: T.StructType | None = None,
) -> DataFrame:
    """One day of a feed, every column as text.

    The day's directory is addressed directly: listing does not grow with the
    number of days landed. Header names are checked against the schema, and a
    line with too few or too many fields keeps its text in ``_corrupt_record``.
    """
    path = raw_path(root, table, day)
    if not files.exists(spark, path):
        raise MissingInput(f"no {table} feed at {path}")
    text = schemas.all_text(schema or schemas.FEEDS[table])
    return (
        spark.read.schema(T.StructType([*text, T.StructField(CORRUPT, T.StringType())]))
        .options(**CSV, enforceSchema=False, mode="PERMISSIVE",
                 columnNameOfCorruptRecord=CORRUPT)
        .csv(path)
    )


def read_days(
    spark: SparkSession, root: str, table: str, days: Sequence[dt.date], schema: T.StructType | None = None,
) -> DataFrame:
    """Several days of a feed in one scan, as :func:`read_raw`, with their ``ingest_date``."""
    paths = [raw_path(root, table, day) for day in days]
    for path in paths:
        if not files.exists(spark, path):
            raise MissingInput(f"no {table} feed at {path}")
    text = schemas.all_text(schema or schemas.FEEDS[table])
    extra = [T.StructField(CORRUPT, T.StringType()), T.StructField("ingest_date", T.DateType())]
    return (
        spark.read.schema(T.StructType([*text, *extra]))
        .options(**CSV, enforceSchema=False, mode="PERMISSIVE",
                 columnNameOfCorruptRecord=CORRUPT, basePath=files.join(root, table))
        .csv(paths)
    )


def write_raw(df: DataFrame, root: str, table: str, day: str | dt.date) -> str:
    """Land one day of a feed; landing a day again replaces that day only."""
    path = raw_path(root, table, day)
    df.write.mode("overwrite").options(**CSV).csv(path)
    return path


def publish_plan(
    spark: SparkSession, landing: str, root: str, day: str | dt.date
) -> DataFrame:
    """Which landed CSV goes to which raw directory: ``table_name, source, target``.

    The landing area holds ``ingest_date=D/<table>.csv``, each a file or a
    directory of part files; the name gives the table. Only the listing is read.
    """
    inbox = files.join(landing, f"ingest_date={as_date(day).isoformat()}")
    if not files.exists(spark, inbox):
        raise MissingInput(f"nothing landed at {inbox}")
    listed = [(files.join(inbox, n),) for n in files.children(spark, inbox) if n.endswith(".csv")]
    table = F.regexp_extract("source", r"([^/]+)\.csv$", 1)
    target = F.concat(
        F.lit(root.rstrip("/") + "/"), table, F.lit(f"/ingest_date={as_date(day).isoformat()}")
    )
    return spark.createDataFrame(listed, "source string").select(
        table.alias("table_name"), "source", target.alias("target")
    )


def _copy_lines(spark: SparkSession, source: str, target: str) -> None:
    """Copy a CSV line by line, unparsed, with its header on every part file.

    ``source`` is a file or a directory of part files, each with a header; files
    whose headers differ are refused. Only the first line of a file is its
    header: lines equal to it and blank ones are copied like any other. Lines are
    written as text, so that no field is interpreted or lost.
    """
    numbered = spark.read.text(source).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        (F.col("_metadata.file_block_start") == 0).alias("starts"),
        F.monotonically_increasing_id().alias("line"),
    )
    # Numbers are only good within one scan: it is stored, and read for both uses.
    with staged(numbered, "publish", files.join(files.parent(target), "_staging")) as lines:
        firsts = lines.filter("starts").groupBy("file").agg(F.min(F.struct("line", "value")).alias("first"))
        headers = firsts.select("first.value").distinct().limit(2).collect()
        if not headers:
            raise ValueError(f"{source} has no header line")
        if len(headers) > 1:
            raise ValueError(f"the files of {source} have different headers")
        header = headers[0]["value"]
        # One row per landed file of one table and day.
        marks = F.broadcast(firsts.select("file", F.col("first.line").alias("line")))
        rows = lines.join(marks, ["file", "line"], "left_anti").select("value")
        # The lower 33 bits count the rows of a task, that is, of the file it writes.
        is_first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
        whole = F.when(is_first, F.concat(F.lit(header + "\n"), "value")).otherwise(F.col("value"))
        rows.select(whole.alias("value")).write.mode("overwrite").text(target)
        if rows.isEmpty():
            spark.createDataFrame([(header,)], "value string").write.mode("overwrite").text(target)


def publish(
    spark: SparkSession, landing: str, root: str, day: str | dt.date,
    dry_run: bool = False,
) -> DataFrame:
    """Copy a landed day into the raw zone and return the plan.

    The copy is a Spark job per table, so a feed of any size moves in parallel.
    A table that fails does not stop the others but fails the call at the end.
    """
    plan = publish_plan(spark, landing, root, day)
    # One row per table of the day, at most as many as the directory has files.
    moves = plan.collect()
    if not moves:
        log.warning("no CSV files landed for %s", day)
    failed = []
    for move in [] if dry_run else moves:
        try:
            _copy_lines(spark, move["source"], move["target"])
        except Exception as e:  # noqa: BLE001 - reported below, with every other
            log.error("publishing %s failed: %s", move["source"], e)
            failed.append(move["table_name"])
    if failed:
        raise RuntimeError(f"publishing failed for: {', '.join(sorted(failed))}")
    return plan
