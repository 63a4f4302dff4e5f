"""The engine's catalog as frames, and ranked keyword search over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.functions.text import keyword_score


def tables(spark: SparkSession, database: str = "default") -> DataFrame:
    """(table_name, kind, column_name, data_type, comment) of what the catalog holds."""
    rows = [(t.name, t.tableType, c.name, c.dataType, c.description) for t in spark.catalog.listTables(database) for c in spark.catalog.listColumns(t.name)]
    return spark.createDataFrame(rows, "table_name string, kind string, column_name string, data_type string, comment string")


def keyword_search(df: DataFrame, key: str, text: str, query: str, limit: int = 12) -> DataFrame:
    """The best ``limit`` rows by score, ties by key; rows without a hit are left out."""
    scored = df.select(F.col(key), keyword_score(F.coalesce(F.col(text), F.lit("")), query).alias("score"))
    return scored.filter("score > 0").orderBy(F.desc("score"), key).limit(limit)


def mentions(statements: DataFrame, key: str, text: str, names: list[str]) -> DataFrame:
    """(key, relation) of the known relation names that a statement holds."""
    body = F.lower(F.col(text))
    hits = F.array_compact(F.array(*(F.when(body.contains(n.lower()), n) for n in names)))
    return statements.select(key, F.explode(hits).alias("relation"))


def edges(statements: DataFrame, key: str, text: str, names: list[str]) -> DataFrame:
    """(relation, used_by): each relation with the statements that name it, distinct and in order."""
    return mentions(statements, key, text, names).distinct().groupBy("relation").agg(F.sort_array(F.collect_list(key)).alias("used_by"))


def routines(spark: SparkSession) -> DataFrame:
    """(name, class_name, is_temporary, description) of the catalog's functions."""
    rows = [(f.name, f.className, f.isTemporary, f.description) for f in spark.catalog.listFunctions()]
    return spark.createDataFrame(rows, "name string, class_name string, is_temporary boolean, description string")


def foreign_keys(constraints: DataFrame, columns: DataFrame) -> DataFrame:
    """(constraint, table_name, column_name, of_table, of_column): keys of (constraint, table_name, position, column_name, of_table, of_column) whose both ends are known columns."""
    here = columns.select("table_name", "column_name")
    there = columns.select(F.col("table_name").alias("of_table"), F.col("column_name").alias("of_column"))
    return constraints.join(here, ["table_name", "column_name"], "left_semi").join(there, ["of_table", "of_column"], "left_semi").select("constraint", "table_name", "column_name", "of_table", "of_column")


def records(rows: DataFrame, since: str | None = None, author: str | None = None, status: str | None = None, board: DataFrame | None = None, at: str = "at", key: str = "task_id") -> DataFrame:
    """Records from ``since`` on (ISO texts compare as text), of one author, of tasks whose status on the board is the one asked for."""
    if since:
        rows = rows.filter(F.col(at) >= since)
    if author:
        rows = rows.filter(F.col("author") == author)
    if status and board is not None:
        rows = rows.join(board.filter(F.col("status") == status).select(key).distinct(), key, "left_semi")
    return rows
