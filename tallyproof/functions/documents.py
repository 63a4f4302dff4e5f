"""JSON documents as columns: kinds, equality whatever the order of keys, and control maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names under which a source may state its number of rows, in order of preference.
COUNT_KEYS = ("detail_count", "event_count", "logical_count", "transfer_count", "record_count", "count")
AMOUNT_KEYS = ("net_amount", "assessed_fee")


def entries(text: Column) -> Column:
    """Keys and values of an object in the order of its keys; null for anything else."""
    return F.when(F.ltrim(text).startswith("{"), F.sort_array(F.map_entries(F.from_json(text, "map<string,string>"))))


def is_object(text: Column) -> Column:
    return entries(text).isNotNull()


def same_object(a: Column, b: Column) -> Column:
    """Whether two objects hold the same keys and values."""
    return entries(a).eqNullSafe(entries(b)) & entries(a).isNotNull()


def first_of(text: Column, keys: tuple[str, ...], kind: str) -> Column:
    """The first of several keys that the object has, as ``kind``."""
    return F.coalesce(*(F.get_json_object(text, f"$.{k}").try_cast(kind) for k in keys))


def control_count(text: Column) -> Column:
    return first_of(text, COUNT_KEYS, "bigint")


def control_amount(text: Column) -> Column:
    return first_of(text, AMOUNT_KEYS, "decimal(18,2)")


def control_map(count: Column, amounts: dict[str, Column]) -> Column:
    """A control document: the count as a number, money as text with two places."""
    return F.to_json(F.struct(count.alias("count"), *(v.cast("decimal(18,2)").cast("string").alias(k) for k, v in amounts.items())))


def number(text: Column, *keys: str) -> Column:
    """The first of several keys that a document has, as a whole number."""
    return first_of(text, keys, "bigint")


def array_sum(values: Column, kind: str = "decimal(18,6)") -> Column:
    """The exact sum of an array's elements, each cast first; 0 of none."""
    whole = "decimal(28," + kind.split(",")[1]
    return F.aggregate(values, F.lit(0).cast(whole), lambda total, x: (total + x.cast("double").cast(kind)).cast(whole))
