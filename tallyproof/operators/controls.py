"""Control totals: one pass, mergeable, exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total(amount: Column) -> Column:
    """Sum with 0.00 for no rows; null instead of an overflow."""
    return F.coalesce(F.try_sum(amount.cast("decimal(18,2)")), F.lit("0.00").cast("decimal(18,2)")).cast("decimal(38,2)")


def five_controls(df: DataFrame, amount: Column) -> DataFrame:
    """Rows, rows without a valid amount, sum, least and greatest in one scan."""
    value = amount.cast("decimal(18,2)")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(F.when(value.isNull(), 1)).alias("invalid_count"),
        F.try_sum(value).cast("decimal(38,2)").alias("sum_amount"),
        F.min(value).alias("min_amount"),
        F.max(value).alias("max_amount"),
    )


def totals_by_code(df: DataFrame, code: Column, amount: Column) -> DataFrame:
    """Sum by trimmed code over valid rows; empty codes are left out afterwards."""
    value = amount.cast("decimal(18,2)")
    return df.filter(value.isNotNull()).groupBy(F.trim(code).alias("code")).agg(F.sum(value).cast("decimal(38,2)").alias("sum_amount")).filter("code <> ''")


def controls_and_codes(df: DataFrame, code: Column, amount: Column) -> DataFrame:
    """The five controls and the totals by code from one scan: grouped once, then merged."""
    value = amount.cast("decimal(18,2)")
    by = df.groupBy(F.trim(code).alias("code")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(value.isNull(), 1)).alias("bad"), F.sum(value).cast("decimal(38,2)").alias("s"), F.min(value).alias("lo"), F.max(value).alias("hi"))
    codes = F.sort_array(F.collect_list(F.when((F.col("code") != "") & F.col("s").isNotNull(), F.struct("code", F.col("s").cast("string").alias("sum_amount")))))
    return by.agg(F.sum("n").alias("row_count"), F.sum("bad").alias("invalid_count"), F.sum("s").cast("decimal(38,2)").alias("sum_amount"), F.min("lo").alias("min_amount"), F.max("hi").alias("max_amount"), F.map_from_entries(codes).alias("totals_by_code"))


def envelope(controls: DataFrame) -> DataFrame:
    """The controls as one JSON document with money as text."""
    return controls.select(F.to_json(F.struct("row_count", "invalid_count", *(F.col(c).cast("string").alias(c) for c in ("sum_amount", "min_amount", "max_amount")), "totals_by_code")).alias("envelope"))


def filtered_totals(df: DataFrame, key: str, amount: Column, credit: Column, debit: Column) -> DataFrame:
    value = amount.cast("decimal(18,2)")
    return df.groupBy(key).agg(
        F.count(F.when(credit, 1)).alias("credit_count"),
        total(F.when(credit, value)).alias("credit_amount"),
        F.count(F.when(debit, 1)).alias("debit_count"),
        total(F.when(debit, F.abs(value))).alias("debit_amount"),
    )


def two_levels(df: DataFrame, inner: str | list[str], amount: Column) -> DataFrame:
    """Totals per inner group, and once more over them, in one rollup.

    With one column the levels are 0 and 1; with several, a file and its lots for instance, there is one more for each.
    """
    by = [inner] if isinstance(inner, str) else inner
    value = amount.cast("decimal(18,2)")
    level = F.bit_count(F.grouping_id()).cast("int")
    return df.rollup(*by).agg(level.alias("level"), F.count(F.lit(1)).alias("row_count"), F.sum(value).cast("decimal(38,2)").alias("sum_amount"))


def gate(declared: DataFrame, computed: DataFrame, key: str, checks: list[tuple[str, str]]) -> DataFrame:
    """Declared against computed by key; the first check (column, code) that differs gives the code, none gives null."""
    joined = declared.select(key, *(F.col(c).alias(f"declared_{c}") for c, _ in checks)).join(computed.select(key, *(F.col(c).alias(f"computed_{c}") for c, _ in checks)), key, "left")
    code = F.coalesce(*(F.when(~F.col(f"declared_{c}").eqNullSafe(F.col(f"computed_{c}")), name) for c, name in checks))
    return joined.withColumn("rejection_code", code).withColumn("accepted", F.col("rejection_code").isNull())


def accepted_only(details: DataFrame, verdicts: DataFrame, key: str) -> DataFrame:
    """Rows of accepted batches: a refused batch gives none."""
    return details.join(verdicts.filter("accepted").select(key), key, "left_semi")


def first_by_phase(findings: DataFrame, key: str, phase: str = "phase", position: str = "position", code: str = "code") -> DataFrame:
    """The code of the least phase and then least position of each key."""
    return findings.groupBy(key).agg(F.min_by(code, F.struct(phase, position)).alias("rejection_code"))
