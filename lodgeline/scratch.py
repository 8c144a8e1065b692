"""Folders for written tables, stream checkpoints and stream output."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as the session names it.

    A machine-local folder is made only for a local session that names none.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="lodgeline-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path not used before."""
    return f"{shared_root(spark)}/lodgeline/{label}-{uuid.uuid4().hex}"
