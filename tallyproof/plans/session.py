"""The session that the engine expects."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


BASE = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def object_store(endpoint: str, key: str, secret: str) -> dict[str, str]:
    """Settings of an S3-compatible store that is addressed by path."""
    return {f"spark.hadoop.fs.s3a.{name}": value for name, value in (("endpoint", endpoint), ("access.key", key), ("secret.key", secret), ("path.style.access", "true"))}


def session(name: str = "tallyproof", master: str | None = None, shuffle_partitions: int | None = None, more: Mapping[str, str] | None = None) -> SparkSession:
    """A session with ANSI casts, adaptive execution with skew handling, UTC, and ``more`` settings, an object store's for instance."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    conf = BASE | ({"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {}) | dict(more or {})
    return builder.config(map=conf).getOrCreate()
