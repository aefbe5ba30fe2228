"""Session settings for these jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
#: Bytes of input for each partition of a shuffle before adaptive execution joins small ones.
SHUFFLE_BYTES = 128 << 20


def build(master: str, app: str = "homelake", input_bytes: int | None = None, **extra: str) -> SparkSession:
    """A session; with ``input_bytes``, the size of what a job reads, shuffles start with one
    partition for each 128 MB of it, 200 at least, instead of 200 whatever the size."""
    settings = dict(SETTINGS)
    if input_bytes is not None:
        number = max(200, -(-input_bytes // SHUFFLE_BYTES))
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(number)
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**settings, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
