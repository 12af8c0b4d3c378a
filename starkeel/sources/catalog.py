"""Curated tables in the session catalog, for every session that shares it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from .. import schemas
from . import commits, files
from .commits import State

# Partitions that one statement adds or drops.
_AT_ONCE = 200
# Which commit the partitions of a table are those of.
_COMMIT = "starkeel.commit"


def define(spark: SparkSession, table: str, location: str, name: str | None = None) -> str:
    """Create a table over its files if it is not there; returns its name."""
    spark.sql(schemas.create_table_sql(table, location, name))
    return name or table


def register_partitions(spark: SparkSession, table: str) -> None:
    """Make partitions written as directories known to the catalog."""
    spark.catalog.recoverPartitions(table)


def _places(state: State, table: str, levels: tuple[str, ...]) -> dict[str, str]:
    """Partition specification to directory, as a state has them."""
    found = {}
    for part in state.of(table):
        if len(levels) == 1:
            found[f"{levels[0]}='{part.label}'"] = state.at(part)
        else:
            for value in part.values:
                spec = f"{levels[0]}='{part.label}', {levels[1]}='{value}'"
                found[spec] = files.join(state.at(part), f"{levels[1]}={value}")
    return found


def partitioned(spark: SparkSession, state: State, table: str, levels: tuple[str, ...]) -> None:
    """Make a table's partitions in the catalog those of a state, without listing files.

    Each partition is registered with its directory. The table remembers the
    commit it was last brought to, so only what differs is dropped and added.
    """
    define(spark, table, files.join(state.root, table))
    known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}.get(_COMMIT)
    wanted, have = _places(state, table, levels), {}
    if known is not None and commits.exists(spark, state.root, int(known)):
        have = _places(commits.read(spark, state.root, int(known)), table, levels)
        drop = [spec for spec, where in have.items() if wanted.get(spec) != where]
    else:
        listed = spark.sql(f"SHOW PARTITIONS {table}").collect()
        drop = [", ".join(f"{k}='{v}'" for k, _, v in (x.partition("=") for x in r[0].split("/"))) for r in listed]
    add = [spec for spec, where in wanted.items() if have.get(spec) != where]
    for i in range(0, len(drop), _AT_ONCE):
        specs = ", ".join(f"PARTITION ({s})" for s in drop[i : i + _AT_ONCE])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    for i in range(0, len(add), _AT_ONCE):
        specs = " ".join(f"PARTITION ({s}) LOCATION '{wanted[s]}'" for s in add[i : i + _AT_ONCE])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_COMMIT}' = '{state.number}')")
    spark.catalog.refreshTable(table)


def view(
    spark: SparkSession, name: str, schema: T.StructType, places: Iterable[tuple[str, Mapping[str, str]]]
) -> None:
    """A view in the catalog over directories of Parquet files.

    ``places`` gives each directory and the columns that are not in its files,
    as SQL. Directories with the same such columns are read as one.
    """
    grouped: dict[tuple, list[str]] = {}
    for path, fixed in places:
        grouped.setdefault(tuple(fixed.items()), []).append(path)
    selects = []
    for fixed, paths in grouped.items():
        where = paths[0] if len(paths) == 1 else "{" + ",".join(paths) + "}"
        of = dict(fixed)
        columns = ", ".join(
            f"cast({of.get(f.name, f'`{f.name}`')} as {f.dataType.simpleString()}) as `{f.name}`" for f in schema
        )
        selects.append(f"select {columns} from parquet.`{where}`")
    if not selects:
        columns = ", ".join(f"cast(null as {f.dataType.simpleString()}) as `{f.name}`" for f in schema)
        selects = [f"select {columns} where false"]
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {' union all '.join(selects)}")
