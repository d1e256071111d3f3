"""Tables that several later steps read, computed once and cut off from their lineage in the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def settle(df: DataFrame) -> DataFrame:
    """df as a checkpoint in the folder of spark.checkpoint.dir; only a session in one process gets a folder of its own if
    none is set, on a cluster that is an error."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="postalis-settled-"))
    return df.checkpoint()
