"""Folders that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session without it gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_root:
        _local_root[context.applicationId] = tempfile.mkdtemp(prefix="stratalake-")
        context.setCheckpointDir(_local_root[context.applicationId])
    return _local_root[context.applicationId]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """Path of a folder of its own for one run; it is made by whoever writes to it."""
    return f"{shared_root(spark)}/stratalake/{purpose}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame's rows stored in the shared folder, without the work that led to them."""
    shared_root(df.sparkSession)  # gives a local session its checkpoint folder
    return df.checkpoint()
