"""A Spark session with settings for large data, where the cluster sets none."""

from __future__ import annotations

from pyspark import SparkConf
from pyspark.sql import SparkSession

_DEFAULTS = {
    # plans follow what a stage really produced; hot keys are split in joins
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # small shuffle partitions are merged up to the advised size
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def session(name: str = "signalwatch", partitions: int | None = None) -> SparkSession:
    """The session of a cluster job; a setting given to spark-submit stays as given.

    ``partitions`` is how many parts a shuffle starts with; ``shuffle_parts`` tells it from the
    input's size. Too many are merged, too few spill.
    """
    given = SparkConf()
    settings = dict(_DEFAULTS)
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    builder = SparkSession.builder.appName(name)
    for key, value in settings.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_parts(n_bytes: int, part_bytes: int = 128 << 20, least: int = 200) -> int:
    """How many parts a shuffle of ``n_bytes`` starts with: none holds more than ``part_bytes``."""
    return max(least, -(-n_bytes // part_bytes))
