"""A folder that every executor can reach, for tables written between two jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under the session's checkpoint folder.

    Where the setting is absent, a temporary folder is used in local mode only.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="homelake-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
