"""As-of join as a sweep over one ordered stream, linear for any key.

Facts and versions are put into one stream ordered by (key, instant), versions
before facts of the same instant, and dealt out by range: a key with very many
rows is cut like everything else. Within its piece of the stream a fact takes
the version that began last before it. What a piece lacks, the version that was
open at its border, is carried over from the pieces before: one row for each
piece that begins inside a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..lineage import stored

_KEY, _AT, _KIND, _TIE, _PIECE = "__key", "__at", "__kind", "__tie", "__piece"
_FACT, _VERSION, _LAST, _CARRIED = "__fact", "__version", "__last", "__carried"


def as_of_sweep(
    facts: DataFrame, versions: DataFrame, key: str, ts: str,
    start: str = "start_date", end: str = "end_date", how: str = "inner",
) -> DataFrame:
    """Join each fact row to the version of its key valid at ``ts``, ``[start, end)``.

    The versions of a key must not overlap, as those of a Type-2 dimension do
    not; gaps are allowed, and empty versions count for nothing. Facts and
    versions must not share column names other than ``key``. The stream is
    stored once, so that its pieces stay the same; no pairs are formed, however
    many versions and facts a key has.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    names = [c for c in versions.columns if c != key]
    v_type = T.StructType([versions.schema[c] for c in names])
    sound = F.col(key).isNotNull() & (F.col(start) < F.col(end))
    begun = versions.filter(sound).select(
        F.col(key).alias(_KEY), F.col(start).alias(_AT), F.lit(0).alias(_KIND),
        F.struct(*names).alias(_VERSION), F.lit(None).cast(facts.schema).alias(_FACT),
    )
    placed = F.col(key).isNotNull() & F.col(ts).isNotNull()
    seen = facts.filter(placed).select(
        F.col(key).alias(_KEY), F.col(ts).alias(_AT), F.lit(1).alias(_KIND),
        F.lit(None).cast(v_type).alias(_VERSION), F.struct(*facts.columns).alias(_FACT),
    )
    stream = begun.unionByName(seen).withColumn(_TIE, F.xxhash64(_FACT))
    # The last column spreads facts of one key and instant.
    ranged = stream.repartitionByRange(_KEY, _AT, _KIND, _TIE).withColumn(_PIECE, F.spark_partition_id())
    ranged = stored(ranged.drop(_TIE), "sweep")
    so_far = Window.partitionBy(_KEY, _PIECE).orderBy(_AT, _KIND).rowsBetween(Window.unboundedPreceding, 0)
    rows = ranged.withColumn(_LAST, F.last(_VERSION, ignorenulls=True).over(so_far)).filter(F.col(_KIND) == 1)
    tails = ranged.groupBy(_KEY, _PIECE).agg(
        F.max_by(_VERSION, F.when(F.col(_VERSION).isNotNull(), F.col(_AT))).alias("tail")
    )
    pieces = Window.partitionBy(_KEY).orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        tails.withColumn(_CARRIED, F.last("tail", ignorenulls=True).over(pieces))
        .filter(F.col(_CARRIED).isNotNull()).drop("tail")
    )
    # At most one row for each piece: only its first key can have begun before it.
    met = rows.join(F.broadcast(carried), [_KEY, _PIECE], "left").withColumn(
        _LAST, F.coalesce(_LAST, _CARRIED)
    )
    valid = F.coalesce(F.col(_AT) < F.col(f"{_LAST}.{end}"), F.lit(False))
    if how == "inner":
        met = met.filter(valid)
    found = met.select(
        *[F.col(f"{_FACT}.{c}").alias(c) for c in facts.columns],
        *[F.when(valid, F.col(f"{_LAST}.{c}")).alias(c) for c in names],
    )
    if how == "inner":
        return found
    alone = facts.filter(~placed).select("*", *[F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in names])
    return found.unionByName(alone)
