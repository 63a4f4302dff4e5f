"""Set differences, inserts, upserts and state changes over append-only tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of one side only, with the side; counts must be compared beside it, as duplicates do not show."""
    return a.subtract(b).withColumn("side", F.lit("left")).unionAll(b.subtract(a).withColumn("side", F.lit("right")))


def insert_missing(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key the target does not hold, one per key."""
    return incoming.join(target.select(*keys), keys, "left_anti").dropDuplicates(keys)


def replay_differences(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that come again with other values, null-safe."""
    values = [c for c in incoming.columns if c not in keys]
    old = target.select(*keys, *(F.col(c).alias(f"old_{c}") for c in values))
    differs = F.lit(False)
    for c in values:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"old_{c}"))
    return incoming.join(old, keys).filter(differs)


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """The target with incoming rows written over it."""
    values = [c for c in target.columns if c not in keys]
    new = incoming.select(*keys, F.struct(*values).alias("_new"))
    joined = target.join(new, keys, "full_outer")
    return joined.select(*keys, *(F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in values))


#: Allowed moves of a batch.
TRANSITIONS = {"claimed": ("committed", "failed"), "committed": ("succeeded",), "failed": (), "succeeded": ()}


def transition(state: Column, wanted: Column) -> Column:
    """The new state if the move is allowed, null if it is refused."""
    out = F.lit(None).cast("string")
    for now, after in TRANSITIONS.items():
        if after:
            out = F.when((state == now) & wanted.isin(*after), wanted).otherwise(out)
    return out


def latest(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """The last value of each key, by an aggregate rather than a sort."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value), F.max(F.struct(*order)).alias("_at")).select(key, value, *(F.col(f"_at.{c}").alias(c) for c in order))


def first_seen(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; ``duplicates`` counts the later ones."""
    w = Window.partitionBy(*keys)
    return df.withColumn("_n", F.row_number().over(w.orderBy(*order))).withColumn("duplicates", F.count(F.lit(1)).over(w) - 1).filter("_n = 1").drop("_n")


def zone_selection(processing: DataFrame, cache: DataFrame, incoming: DataFrame, settled: DataFrame, most: int = 100) -> DataFrame:
    """Batches to work on: processing, then cached ones not settled, then incoming ones not in processing; the first ``most``, with how many wait."""
    ranked = (
        processing.select("batch_id", F.lit(0).alias("zone"))
        .unionByName(cache.join(settled, "batch_id", "left_anti").select("batch_id", F.lit(1).alias("zone")))
        .unionByName(incoming.join(processing, "batch_id", "left_anti").select("batch_id", F.lit(2).alias("zone")))
        .groupBy("batch_id")
        .agg(F.min("zone").alias("zone"))
    )
    waiting = ranked.agg(F.greatest(F.count(F.lit(1)) - most, F.lit(0)).alias("deferred"))
    return ranked.orderBy("zone", "batch_id").limit(most).crossJoin(F.broadcast(waiting))


def ambiguous(processing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Batches that stand in both zones."""
    return processing.select("batch_id").intersect(incoming.select("batch_id"))


def with_loads(batches: DataFrame, loads: DataFrame, key: str = "batch_id") -> DataFrame:
    """Batches with their loads, one row a load; a batch without one is left out."""
    return batches.join(loads, key)


def registered(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Registrations once each: the first in order stands, later ones of its key change nothing."""
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.groupBy(*key).agg(F.min_by(whole, F.struct(*order)).alias("_first")).select("_first.*")


def next_of_kind(df: DataFrame, by: str, order: list[str], key: str, kind: str) -> DataFrame:
    """Each row with the key of the one after it in its group, and whether both are of one kind."""
    w = Window.partitionBy(by).orderBy(*order)
    return df.select(key, by, F.lead(key).over(w).alias("next_id"), (F.lead(kind).over(w) == F.col(kind)).alias("pairs_with_next"))


def islands(df: DataFrame, by: str, order: list[str], starts: Column, amount: Column) -> DataFrame:
    """Rows of a group in runs that begin where ``starts`` holds: their number and total by run."""
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumn("island", F.sum(F.when(starts, 1).otherwise(0)).over(w))
    return rows.groupBy(by, "island").agg(F.count(F.lit(1)).alias("n"), F.sum(amount.cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"))
