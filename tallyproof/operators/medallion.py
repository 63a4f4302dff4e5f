"""Bronze, silver and gold: typed casts, labels, and reconciliation by batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.operators.controls import total


def bronze(raw: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns cast to their declared types; a cast that fails stops the job."""
    return raw.select(*(F.col(c).cast(t).alias(c) for c, t in types.items()))


def identity_silver(bronze_rows: DataFrame, columns: list[str]) -> DataFrame:
    """Silver that takes bronze over as it is, by named columns, so that an unexpected one stops the job."""
    extra = set(bronze_rows.columns) - set(columns)
    if extra:
        raise ValueError(f"columns that silver does not know: {sorted(extra)}")
    return bronze_rows.select(*columns)


def conditional_split(df: DataFrame, by: str, amount: Column, back: Column) -> DataFrame:
    """Per group: how many rows went back, their total, and the total of the others."""
    zero = F.lit(0).cast("decimal(18,2)")
    value = amount.cast("decimal(18,2)")
    return df.groupBy(by).agg(F.sum(F.when(back, 1).otherwise(0)).alias("returned_count"), F.sum(F.when(back, value).otherwise(zero)).cast("decimal(38,2)").alias("returned_amount"), F.sum(F.when(~back, value).otherwise(zero)).cast("decimal(38,2)").alias("kept_amount"))


def lost_rows(source: DataFrame, kept: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """(rows, amount) that a filter between two layers loses: what a superseded procedure that applies only some kinds drops."""
    gone = source.join(kept.select(*keys), keys, "left_anti")
    return gone.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.col(amount).cast("decimal(18,2)")), F.lit(0)).cast("decimal(38,2)").alias("amount"))


def label(code: Column, names: dict[str, str]) -> Column:
    """Names of codes; an unknown code is null."""
    out = None
    for k, v in names.items():
        out = F.when(code == k, v) if out is None else out.when(code == k, v)
    return out


def reconcile(control: DataFrame, staged: DataFrame, applied: DataFrame, measures: dict[str, str], key: str = "batch_id", compared: list[str] | None = None, extra: Column | None = None) -> DataFrame:
    """Gold: one row per batch that all three sides know.

    ``control`` has the key, ``source_count`` and ``source_<measure>`` columns;
    ``measures`` maps a measure to the column that is summed in staged and
    applied.  The verdict compares counts and the ``compared`` measures (all by
    default) of the three sides; a null comparison counts as a mismatch.
    Inner joins: a control without rows is not in gold.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(key).agg(F.count(F.lit(1)).alias(f"{name}_count"), *(total(F.col(c)).cast("decimal(18,2)").alias(f"{name}_{m}") for m, c in measures.items()))

    joined = control.join(side(staged, "staged"), key).join(side(applied, "applied"), key)
    same = F.lit(True)
    for m in ["count", *(measures if compared is None else compared)]:
        same = same & (F.col(f"applied_{m}") == F.col(f"source_{m}")) & (F.col(f"staged_{m}") == F.col(f"source_{m}"))
    if extra is not None:
        same = same & extra
    deltas = [(F.col("applied_count") - F.col("source_count")).alias("count_delta"), *((F.col(f"applied_{m}") - F.col(f"source_{m}")).cast("decimal(18,2)").alias(f"{m}_delta") for m in measures)]
    return joined.select("*", *deltas, F.lit(0).alias("reject_count"), F.when(same, "MATCHED").otherwise("MISMATCHED").alias("status"))


#: What each file type sums and compares: (measures, measures in the verdict or None for all).
TYPES: dict[str, tuple[dict[str, str], list[str] | None]] = {
    "01": ({"net_amount": "amount_brl"}, None),
    "02": ({"credit_amount": "credit_brl", "debit_amount": "debit_brl", "net_amount": "amount_brl"}, None),
    "03": ({"net_amount": "net_amount_brl"}, None),
    "04": ({"gross_amount": "gross_brl", "returned_amount": "returned_brl", "net_amount": "amount_brl"}, ["gross_amount", "returned_amount"]),
    "05": ({"assessed_amount": "assessed_fee_brl"}, None),
    "06": ({"original_amount": "original_amount_brl", "chargeback_amount": "chargeback_amount_brl", "calculated_amount": "calculated_amount_brl"}, None),
}


def split_amounts(kind: str, details: DataFrame) -> DataFrame:
    """The extra amount columns that types 02 and 04 sum."""
    amount = F.col("amount_brl")
    if kind == "02":
        return details.withColumns({"credit_brl": F.when(F.col("direction") == "C", amount), "debit_brl": F.when(F.col("direction") == "D", F.abs(amount))})
    if kind == "04":
        return details.withColumns({"gross_brl": F.when(F.col("movement_kind") == "TRANSFER", amount), "returned_brl": F.when(F.col("movement_kind") == "RETURN", amount)})
    return details


def gold(kind: str, control: DataFrame, staged: DataFrame, applied: DataFrame) -> DataFrame:
    """Gold reconciliation of one file type."""
    measures, compared = TYPES[kind]
    return reconcile(control, split_amounts(kind, staged), split_amounts(kind, applied), measures, compared=compared)


def conserves_totals(one: DataFrame, two: DataFrame, key: str, amounts: list[str]) -> DataFrame:
    """Keys whose counts or totals differ between two layers, either side missing included; no rows is a pass."""
    side = lambda df, n: df.groupBy(key).agg(F.count(F.lit(1)).alias(f"{n}_count"), *(F.sum(F.col(a).cast("decimal(18,2)")).cast("decimal(38,2)").alias(f"{n}_{a}") for a in amounts))
    joined = side(one, "bronze").join(side(two, "silver"), key, "full_outer")
    differs = F.lit(False)
    for m in ["count", *amounts]:
        differs = differs | ~F.col(f"bronze_{m}").eqNullSafe(F.col(f"silver_{m}"))
    return joined.filter(differs)
