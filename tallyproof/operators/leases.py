"""Leases over a table of (resource, token, owner, expires_at, active): reads only, the holder decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expired(leases: DataFrame, now: Column) -> DataFrame:
    return leases.filter(F.col("active") & (F.col("expires_at") < now))


def next_tokens(leases: DataFrame, key: str = "resource") -> DataFrame:
    """The token that the next holder must show: one more than any before."""
    return leases.groupBy(key).agg((F.max("token") + 1).alias("next_token"), F.max(F.col("active").cast("int")).alias("held"))


def active_lease(leases: DataFrame, resource, now: Column) -> DataFrame:
    """One lease that holds a resource at ``now``, if there is any: enough to refuse another."""
    return leases.filter((F.col("resource") == resource) & F.col("active") & (F.col("expires_at") >= now)).limit(1)


def of_run(leases: DataFrame, attempts: DataFrame, wanted: str) -> DataFrame:
    """Leases of a run, named by the run itself or by one of its attempts."""
    run = attempts.filter(F.col("attempt_id") == wanted).select("run_id").unionByName(leases.filter(F.col("run_id") == wanted).select("run_id")).distinct()
    return leases.join(run, "run_id", "left_semi")


def status_of(rows: DataFrame, board: DataFrame, fallback: DataFrame, key: str = "task_id") -> DataFrame:
    """Rows with the status that the board gives, else the fallback's, else ``unknown``."""
    one = board.groupBy(key).agg(F.max("status").alias("_board"))
    two = fallback.groupBy(key).agg(F.max("status").alias("_fallback"))
    return rows.join(one, key, "left").join(two, key, "left").withColumn("status", F.coalesce("_board", "_fallback", F.lit("unknown"))).drop("_board", "_fallback")
