"""Cutting lineage where a plan is read more than once or grows by rounds."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, written to the checkpoint folder that all executors share (``spark.checkpoint.dir``); a lost executor costs no recomputation. Only a session on one
    machine may do without the setting and gets a temporary folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        root = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not context.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
            root = "file://" + tempfile.mkdtemp(prefix="stemma-")
        context.setCheckpointDir(root)
    return df.checkpoint()
