"""A folder for intermediate files that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the session's shared folder, spark.checkpoint.dir.

    A session that names none may only run on one machine (a local master): it gets a temporary
    folder, which is set as its shared folder. On a cluster that is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.sparkContext.getCheckpointDir()
    if not shared:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="claimweave-")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
