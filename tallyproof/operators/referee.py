"""Comparison with an approved expectation: every difference is found, classified and never tolerated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.functions.money import canonical


def classify(matches_contract: Column, matches_reference: Column, source_wrong: Column | None = None, approved: Column | None = None) -> Column:
    """Who is wrong, in this order of precedence."""
    no = F.lit(False)
    return (
        F.when(no if approved is None else approved, "APPROVED_BEHAVIOR_CHANGE")
        .when(no if source_wrong is None else source_wrong, "CONFIRMED_SOURCE_DEFECT")
        .when(matches_contract & ~matches_reference, "CONFIRMED_LEGACY_DEFECT")
        .when(~matches_contract, "MODERN_DEFECT")
        .otherwise("UNRESOLVED")
    )


EXPLAINED = ("APPROVED_BEHAVIOR_CHANGE", "CONFIRMED_SOURCE_DEFECT", "CONFIRMED_LEGACY_DEFECT")


def status(differences: DataFrame, by: list[str] | None = None) -> DataFrame:
    """MATCHED without differences, RESOLVED when all are explained, else STALLED."""
    bad = F.count(F.when(~F.col("classification").isin(*EXPLAINED), 1))
    n = F.count("classification")
    return differences.groupBy(*(by or [])).agg(n.alias("differences"), bad.alias("unexplained"), F.when(n == 0, "MATCHED").when(bad == 0, "RESOLVED").otherwise("STALLED").alias("status"))


def last_of_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row a key, the last in ``order``: what a dictionary filled in that order holds."""
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(*keys).agg(F.max_by(whole, F.struct(*order)).alias("_last")).select("_last.*")


def record_diff(actual: DataFrame, contract: DataFrame, keys: list[str], fields: list[str], money: tuple[str, ...] = (), order: list[str] | None = None) -> DataFrame:
    """(keys, field, actual, expected, classification) of every field that differs; a row on one side only is one difference ``(record)``.

    Of rows that share a key the last in ``order`` counts; without an order there must be one row a key.
    """
    if order:
        actual, contract = last_of_key(actual, keys, order), last_of_key(contract, keys, order)
    shape = lambda df, name: df.select(*keys, F.struct(*(canonical(F.col(f), f in money).alias(f) for f in fields)).alias(name))
    joined = shape(actual, "a").join(shape(contract, "c"), keys, "full_outer")
    one_side = F.col("a").isNull() | F.col("c").isNull()
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"a.{f}").alias("actual"), F.col(f"c.{f}").alias("expected")) for f in fields))
    whole = F.array(F.struct(F.lit("(record)").alias("field"), F.when(F.col("a").isNull(), "absent").otherwise("present").alias("actual"), F.when(F.col("c").isNull(), "absent").otherwise("present").alias("expected")))
    found = joined.select(*keys, F.explode(F.when(one_side, whole).otherwise(pairs)).alias("d")).select(*keys, "d.*").filter("actual <> expected")
    return found.withColumn("classification", classify(F.lit(False), F.lit(False)))


def unpivoted(df: DataFrame, fields: list[str], value: str, money: tuple[str, ...] = ()) -> DataFrame:
    """(field, value) rows of a one-row frame, as canonical text."""
    return df.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), canonical(F.col(f), f in money).alias(value)) for f in fields))).alias("r")).select("r.*")


def aggregate_diff(actual: DataFrame, contract: DataFrame, reference: DataFrame) -> DataFrame:
    """Differences of (field, value) frames, three ways, over the union of their fields."""
    joined = actual.join(contract, "field", "full_outer").join(reference, "field", "full_outer")
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    a, c, r = blank("actual"), blank("contract"), blank("reference")
    return joined.select("field", a.alias("actual"), c.alias("contract"), r.alias("reference"), classify(a == c, a == r).alias("classification")).filter(~((a == c) & (a == r)))


def in_order(differences: DataFrame, keys: list[str], numeric: bool = False) -> DataFrame:
    """Differences by key and field for a report, keys compared as text or as numbers."""
    by = [F.col(k).cast("decimal(38,0)") if numeric else F.col(k).cast("string") for k in keys]
    return differences.orderBy(*by, "field")


def control_pairs(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """declared_* and computed_* columns as rows (keys, control, declared, computed, equal)."""
    rows = F.explode(F.array(*(F.struct(F.lit(n).alias("control"), F.col(f"declared_{n}").cast("string").alias("declared"), F.col(f"computed_{n}").cast("string").alias("computed")) for n in names)))
    return df.select(*keys, rows.alias("r")).select(*keys, "r.*").withColumn("equal", F.col("declared").eqNullSafe(F.col("computed")))
