"""Assertions as violation rows: an empty result is a pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_grain(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values that are not accepted, null left aside, with their rows."""
    return df.filter(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def broken(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a check, one per rule; a null check passes, as in SQL."""
    names = F.array_compact(F.array(*(F.when(~F.coalesce(rule, F.lit(True)), name) for name, rule in rules.items())))
    return df.withColumn("rule", F.explode(names))


def release_gate(gold: DataFrame, deltas: list[str]) -> DataFrame:
    """Rows that stop a release: not matched, or a delta that is not zero; a null delta does not stop it."""
    stop = F.col("status") != "MATCHED"
    for d in deltas:
        stop = stop | (F.col(d) != 0)
    return gold.filter(stop)


def clear_identifiers(df: DataFrame, columns: list[str], pattern: str) -> DataFrame:
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.col(c).rlike(pattern)
    return df.filter(hit)


def status_conflicts(batches: DataFrame, status: str = "status", failure: str = "failure_code", initial: bool = True) -> DataFrame:
    """(.., conflict) of rows whose failure code does not fit their status.

    A new batch is claimed without a code, or quarantined or an oracle mismatch with one; later on only quarantine needs a code.
    """
    code = F.col(failure).isNotNull()
    unsafe = ~F.col(status).isin("claimed", "quarantined", "oracle_mismatch")
    wrong = ((F.col(status) == "claimed") & code) | ((F.col(status) != "claimed") & ~code)
    new = F.when(unsafe, "UNSAFE_INITIAL_STATUS").when(wrong, "FAILURE_CODE_MISMATCH")
    later = F.when((F.col(status) == "quarantined") & ~code, "FAILURE_CODE_MISMATCH")
    return batches.withColumn("conflict", new if initial else later).filter("conflict is not null")
