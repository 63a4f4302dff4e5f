"""A drop zone as a stream: ready files are taken in small batches, exactly once in effect."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def batches(spark: SparkSession, root: str, pattern: str = "*", per_cycle: int = 100) -> DataFrame:
    """A stream of (path, modificationTime, length, content), at most ``per_cycle`` files a cycle."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", per_cycle).load(root)


_OUTCOMES = "path string, modificationTime timestamp, state string, cycle long"


def _exists(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def ready(files: DataFrame, marker: str = "source-manifest.json") -> DataFrame:
    """Without the files whose folder holds no ``marker`` among these files, and without the markers."""
    folder, name = F.regexp_extract("path", r"^(.*)/[^/]*$", 1), F.regexp_extract("path", r"([^/]*)$", 1)
    told = files.filter(name == marker).select(folder.alias("_folder")).distinct()
    return files.filter(name != marker).withColumn("_folder", folder).join(told, "_folder", "left_semi").drop("_folder")


def pending(spark: SparkSession, outcomes: str) -> DataFrame:
    """(path, modificationTime) of files whose last outcome is retry_pending."""
    if not _exists(spark, outcomes):
        return spark.createDataFrame([], "path string, modificationTime timestamp")
    last = spark.read.schema(_OUTCOMES).json(outcomes).groupBy("path", "modificationTime").agg(F.max_by("state", "cycle").alias("state"))
    return last.filter("state like 'retry_pending%'").select("path", "modificationTime")


def work(stream: DataFrame, handle: Callable[[DataFrame], DataFrame], target: str, outcomes: str, checkpoint: str, keys: list[str], once: bool = True, every: str = "5 seconds") -> StreamingQuery:
    """Run ``handle`` on the files of each micro-batch and append the rows whose keys the target lacks.

    If the files of a micro-batch fail together, each is tried alone, so one bad file stops no other; it is noted in
    ``outcomes`` as retry_pending and read again with each later micro-batch, and by ``retry``, until it succeeds.  A row whose key
    the target holds with other values makes its file fail; a replayed file adds nothing.
    """

    def cycle(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        names = ["path", "modificationTime"]
        late = pending(spark, outcomes).join(df.select(*names), names, "left_anti").select("path")
        again = [r["path"] for r in late.collect()]  # no more than failed so far, of per_cycle files each
        files = df if not again else df.unionByName(_read(spark, again), allowMissingColumns=True)
        _take(files, handle, target, outcomes, keys, number)

    writer = stream.writeStream.foreachBatch(cycle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def retry(spark: SparkSession, handle: Callable[[DataFrame], DataFrame], target: str, outcomes: str, keys: list[str], number: int = 1 << 40) -> int:
    """Try the pending files again without waiting for new ones; how many there were."""
    paths = [r["path"] for r in pending(spark, outcomes).select("path").collect()]
    if paths:
        _take(_read(spark, paths), handle, target, outcomes, keys, number)
    return len(paths)


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(paths)


def _take(files: DataFrame, handle: Callable[[DataFrame], DataFrame], target: str, outcomes: str, keys: list[str], number: int) -> None:
    spark = files.sparkSession

    def append(some: DataFrame) -> str:
        try:
            rows = handle(some)
            if _exists(spark, target):
                there = spark.read.schema(rows.schema).parquet(target)
                both = rows.join(there.select(*keys), keys, "left_semi").exceptAll(there.join(rows.select(*keys), keys, "left_semi"))
                if both.limit(1).count():
                    raise ValueError("a key is there with other values")
                rows = rows.join(there.select(*keys), keys, "left_anti")
            rows.write.mode("append").parquet(target)
            return "succeeded"
        except Exception as error:  # noqa: BLE001  one file must not stop the zone
            return f"retry_pending: {type(error).__name__}"

    told = [(r["path"], r["modificationTime"]) for r in files.select("path", "modificationTime").collect()]
    state = append(files)
    states = [state] * len(told)
    if state != "succeeded" and len(told) > 1:
        states = [append(files.filter(F.col("path") == path)) for path, _ in told]
    rows = [(path, at, state, number) for (path, at), state in zip(told, states)]
    spark.createDataFrame(rows, _OUTCOMES).coalesce(1).write.mode("append").json(outcomes)


def running_totals(events: DataFrame, at: str = "ts", by: str = "event_type", value: str = "value", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Windowed counts and sums of a stream with a watermark; an addition for continuous sources."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).groupBy(F.window(at, window).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).cast("decimal(38,2)").alias("total")).select(F.col("w.start").alias("start"), by, "n", "total")


def after(events: DataFrame, cursor: int, sequence: str = "sequence") -> DataFrame:
    """Events behind a cursor, in order."""
    return events.filter(F.col(sequence) > cursor).orderBy(sequence)
