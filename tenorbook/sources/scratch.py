"""Folders for tables of one run, where all executors reach them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`. Without one a local session gets a temporary folder; a cluster is refused."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors reach")
        found = tempfile.mkdtemp(prefix="tenorbook-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that nothing else writes to."""
    return f"{shared_folder(spark)}/tenorbook-{name}-{uuid.uuid4().hex}"
