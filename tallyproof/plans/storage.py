"""Where written intermediate tables lie: the shared folder that the cluster names."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only where none is set and there is no other machine."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tallyproof-"))
    return str(context._jsc.sc().getCheckpointDir().get())


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the scratch folder, read back: its lineage ends there."""
    path = f"{scratch(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
