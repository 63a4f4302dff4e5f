"""Readers and writers: delimited, landing, ledger and totals files."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Names of character sets as other tools write them.
ENCODINGS = {"latin-1": "ISO-8859-1", "latin1": "ISO-8859-1", "cp1252": "windows-1252", "utf8": "UTF-8", "utf-8-sig": "UTF-8"}


def encoding(name: str) -> str:
    return ENCODINGS.get(name.lower(), name)


def positional_schema(n: int) -> StructType:
    """``c0`` to ``c<n-1>``, all text: columns are bound by place, as header names may repeat."""
    return StructType([StructField(f"c{i}", StringType()) for i in range(n)])


def positional(spark: SparkSession, path: str, columns: int, separator: str = ";", charset: str = "latin-1") -> DataFrame:
    """A delimited file with its first line dropped and its columns bound by place."""
    return spark.read.schema(positional_schema(columns)).options(header=True, enforceSchema=True, sep=separator, encoding=encoding(charset), mode="PERMISSIVE").csv(path)


def separator_of(spark: SparkSession, path: str) -> str:
    """The first of ``; , tab |`` that the header holds more than twice."""
    head = spark.read.text(path).limit(1).collect()
    line = head[0][0] if head else ""
    return next((s for s in ";,\t|" if line.count(s) > 2), ";")


def short_rows(spark: SparkSession, path: str, columns: int, separator: str = ";", charset: str = "latin-1") -> DataFrame:
    """(rows, invalid): lines after the first, read with quotes, and how many have fewer columns than asked for."""
    raw = spark.read.option("encoding", encoding(charset)).csv(path, sep="\u0001", quote="", schema="line string", header=True, enforceSchema=True)
    cut = F.from_csv("line", ", ".join(f"c{i} string" for i in range(columns)), {"sep": separator, "mode": "PERMISSIVE"})
    return raw.select(cut[f"c{columns - 1}"].isNull().alias("short")).agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("short"), 1)).alias("invalid"))


def ragged(spark: SparkSession, path: str, separator: str = ";", charset: str = "latin-1") -> DataFrame:
    """(line, fields, width): lines cut at each separator without quotes, so that uneven widths show; the header is dropped by its text."""
    raw = spark.read.option("encoding", encoding(charset)).csv(path, sep="\u0001", quote="", schema="line string", header=True, enforceSchema=True)
    cut = F.split("line", "\\Q" + separator + "\\E", -1)
    return raw.select("line", cut.alias("fields"), F.size(cut).alias("width"))


def unique_names(names: list[str]) -> list[str]:
    """Repeated header names get _1, _2, ..."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        seen[n] = seen.get(n, -1) + 1
        out.append(f"{n}_{seen[n]}" if seen[n] else n)
    return out


def landing(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """All Parquet files under ``root`` whose name starts with ``prefix``; hidden folders are skipped."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"{prefix}*.parquet").parquet(root)


def manifests(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Control rows from the JSON documents beside the data, amounts as text."""
    return spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(root)


def expected_rows(spark: SparkSession, path: str) -> DataFrame:
    """A contract's expected rows, all text."""
    return spark.read.options(header=True, quote='"', escape='"').csv(path)


def ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """NDJSON events; lines that are not events keep their text in ``_corrupt_record``."""
    return spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)


def monthly_totals(spark: SparkSession, path: str, anchor: DataFrame | None = None) -> DataFrame:
    """(period, rows, total) of totals documents, which come in two spellings; the period stands in the file name.

    Periods that ``anchor``, a frame of the same columns, has are taken from there.
    """
    found = spark.read.schema("count_linhas long, linhas long, sum_vl_liquido string, soma string").option("multiLine", True).json(path)
    period = F.regexp_extract(F.col("_metadata.file_name"), r"(\d{6})", 1)
    totals = found.select(period.alias("period"), F.coalesce("count_linhas", "linhas").alias("rows"), F.coalesce("sum_vl_liquido", "soma").cast("decimal(38,2)").alias("total"))
    if anchor is None:
        return totals
    return totals.join(anchor.select("period"), "period", "left_anti").unionByName(anchor.select("period", "rows", "total"))


def ready_batches(spark: SparkSession, root: str) -> DataFrame:
    """Batches of a drop zone: folders named B and 15 digits that hold a manifest."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "source-manifest.json").load(root).select("path")
    return found.select(F.regexp_extract("path", r"/(B\d{15})/[^/]*$", 1).alias("batch_id"), "path").filter("batch_id <> ''").orderBy("batch_id")


def content_hash(df: DataFrame) -> DataFrame:
    """A digest of the rows that does not depend on files, order or partitions.

    Each row's SHA-256 is taken over JSON that writes nulls out; its four quarters are summed.
    """
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"}), 256)
    quarter = lambda i: F.conv(F.substring(F.col("h"), 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")
    sums = [F.coalesce(F.sum(quarter(i)), F.lit(0)).cast("string") for i in range(4)]
    return df.select(row.alias("h")).agg(F.count(F.lit(1)).alias("rows"), F.sha2(F.concat_ws(",", *sums), 256).alias("digest"))


def file_digests(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, sha256) of the bytes of whole files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", F.sha2("content", 256).alias("sha256"))


def _place(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark._jsc.hadoopConfiguration())


def _commit(spark: SparkSession, staged: str, path: str) -> None:
    """Make a finished folder visible under its name by one rename."""
    there, system = _place(spark, path)
    system.mkdirs(there.getParent())
    if system.exists(there) or not system.rename(_place(spark, staged)[0], there):
        system.delete(_place(spark, staged)[0], True)
        raise FileExistsError(path)


def publish(df: DataFrame, path: str, order: list[str] | None = None, one_file: bool = False) -> str:
    """Write once: ``published``; the same content again: ``already_published``; other content is refused.

    Rows are written beside the target and renamed when whole, with their number and digest in ``_manifest.json``
    written last; a folder without a manifest was never published.  ``order`` sorts over all rows, ``one_file`` keeps
    them in one row group's file, which suits a batch and not a corpus.
    """
    spark = df.sparkSession
    there, system = _place(spark, path)
    found = content_hash(df).first()
    manifest = json.dumps({"digest": found["digest"], "rows": found["rows"]}, sort_keys=True)
    if system.exists(there):
        beside = _place(spark, f"{path}/_manifest.json")[0]
        said = None
        if system.exists(beside):  # a hidden file, so not one that Spark's readers see
            opened = system.open(beside)
            said = spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
            opened.close()
        if said != manifest:
            raise ValueError(f"{path} holds other content")
        return "already_published"
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    rows = df.coalesce(1).sortWithinPartitions(*order) if one_file and order else df.coalesce(1) if one_file else df.orderBy(*order) if order else df
    rows.write.mode("errorifexists").option("compression", "zstd").parquet(staged)
    written = system.create(_place(spark, f"{staged}/_manifest.json")[0])
    written.write(bytearray(manifest.encode()))
    written.close()
    _commit(spark, staged, path)
    return "published"


def overwrite(df: DataFrame, path: str, files: int | None = None) -> None:
    """Parquet in place of what was there, in so many files, or one a core."""
    df.coalesce(files or df.sparkSession.sparkContext.defaultParallelism).write.mode("overwrite").parquet(path)


def replace_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """A table in place of the one of that name, as a load with write disposition ``replace`` or a create-or-replace-as does."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def evidence(spark: SparkSession, documents: dict[str, dict], path: str) -> str:
    """Small JSON documents with sorted keys in a folder that appears whole or not at all; the folder's digest."""
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    total = hashlib.sha256()
    for name in sorted(documents):
        body = (json.dumps(documents[name], sort_keys=True, ensure_ascii=False, separators=(",", ":")) + "\n").encode()
        total.update(name.encode() + b"\0" + body)
        there, system = _place(spark, f"{staged}/{name}.json")
        written = system.create(there)
        written.write(bytearray(body))
        written.close()
    _commit(spark, staged, path)
    return total.hexdigest()


def append_ledger(events: DataFrame, path: str) -> None:
    events.write.mode("append").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)
