"""Where files of a run go."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.  A local session without the setting is
    given a checkpoint folder of its own machine once, and keeps it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile

    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/tillroll-{uuid.uuid4().hex}"
