"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Keys hash rendered timestamps, so the zone is part of the data's meaning. The
# rest are scale settings: AQE coalesces, splits skewed joins and rebalances.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(name: str = "starkeel", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for k, v in {**SETTINGS, **extra}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Refuse a session that would render other keys than the stored ones."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"the session time zone must be UTC, not {zone}")
