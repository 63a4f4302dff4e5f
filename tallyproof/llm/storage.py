"""Where lineage is cut: the shared folder that the cluster names."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of an Arrow batch, at most: rows here hold whole texts, sets and packed signatures, and both sides keep the memory of the largest batch.
ROWS = 1000


def _folder(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; a folder of this machine's own only where there is no other machine."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tallyproof-"))
    return context._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the session's shared checkpoint folder and read back, so that lost executors lose nothing."""
    _folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back, columns still prunable."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()  # shuffle files go when the driver lets go of the plans that made them
    found = spark.read.schema(df.schema).parquet(path)
    found._stored_at = path
    return found


def discard(*frames: DataFrame) -> None:
    """Delete stored tables that all who read them have been stored themselves."""
    for df in frames:
        if path := getattr(df, "_stored_at", None):
            where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def lean(run: Callable, *forget: Callable[[], None]) -> Callable:
    """A function over Arrow batches of at most ``ROWS`` rows that gives its memory back when a task ends: workers live on, beside the next stage's JVM.

    Called where the plan is made; the size of batches is a setting of the session, which is lowered if it is higher.
    """
    session = SparkSession.getActiveSession()
    if session and not 0 < int(session.conf.get(_BATCH)) <= ROWS:
        session.conf.set(_BATCH, str(ROWS))

    def inner(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            for clear in forget:
                clear()
            gc.collect()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library keeps its own counsel
                pass

    return inner
