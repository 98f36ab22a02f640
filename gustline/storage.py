"""Shared storage for intermediate tables and checkpoints.

Executors come and go, so nothing here relies on executor-local blocks: lineage is cut with a reliable
checkpoint or a written table in the folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_own: dict[str, tempfile.TemporaryDirectory] = {}


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder every executor can reach")
    # One machine only: driver and executors share this disk. The folder goes when the program ends.
    application = spark.sparkContext.applicationId
    if application not in _own:
        _own[application] = tempfile.TemporaryDirectory(prefix="gustline-", ignore_cleanup_errors=True)
        atexit.register(_own[application].cleanup)
    return _own[application].name


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody else writes to."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write the frame once and go on from the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
