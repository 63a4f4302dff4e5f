"""Approved expectations and batch layouts; what is not approved or not measured is refused."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect())


def expectation(spark: SparkSession, path: str) -> dict[str, Any]:
    """An expectation document; without an approver it is refused."""
    found = json.loads(_text(spark, path))
    if not str(found.get("approved_by") or "").strip():
        raise PermissionError(f"{path} names no approver")
    return found


def expected_records(spark: SparkSession, document: dict[str, Any]) -> DataFrame:
    """The records of an expectation, all text, in the order of their fields."""
    records = document.get("records", [])
    names = list(dict.fromkeys(k for r in records for k in r))
    rows = [tuple(None if r.get(n) is None else str(r.get(n)) for n in names) for r in records]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))


#: Layouts of the benefit file by first month: (columns, money place, code place, description place).
LAYOUTS = {"000000": (13, 10, 11, 12), "202509": (14, 9, 12, 13)}


def layout(month: str) -> tuple[int, int, int, int]:
    """The layout in force in a month written yyyyMM."""
    return LAYOUTS[max(m for m in LAYOUTS if m <= month)]


def metrics(spark: SparkSession, path: str, schema: str, order: str, last: int = 50) -> tuple[DataFrame, DataFrame]:
    """The last records of a JSON-lines file, and the lines that could not be read."""
    rows = spark.read.text(path).withColumn("r", F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    good = rows.filter("r._bad is null and r is not null").select("r.*").drop("_bad")
    return good.orderBy(F.desc(order)).limit(last), rows.filter("r is null or r._bad is not null").select("value")
