"""Session settings for large tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import SparkConf
from pyspark.sql import SparkSession

MIB = 1 << 20

# Input splits of 256 MiB; adaptive execution with skew handling; hash joins
# where every shuffled partition of a side is measured to fit its map. Beyond
# 2000 shuffle partitions Spark reports block sizes as averages, which hides a
# hot key from the skew handling unless blocks well above the median are
# reported as they are.
SETTINGS = {
    "spark.sql.files.maxPartitionBytes": str(256 * MIB),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(64 * MIB),
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 * MIB),
    "spark.shuffle.accurateBlockSkewedFactor": "5.0",
}


def shuffle_partitions(input_bytes: int, target: int = 256 * MIB) -> int:
    """Partitions for a shuffle of that much input, 200 at least.

    Adaptive execution merges partitions that turn out small but does not
    divide those that are evenly too large, so the number follows the data
    without a limit: 100 TiB make 409,600 partitions.
    """
    return max(-(-input_bytes // target), 200)


def session(name: str, settings: Mapping[str, str] = SETTINGS) -> SparkSession:
    """The active session as it is, or a new one; what the caller sets stays set."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    conf = SparkConf()
    for key, value in settings.items():
        conf.setIfMissing(key, value)
    return SparkSession.builder.appName(name).config(conf=conf).getOrCreate()


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """The size of files and folders, on whatever file system they are."""
    configuration = spark._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        location = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = location.getFileSystem(configuration)
        total += files.getContentSummary(location).getLength()
    return total


def fit_shuffles(spark: SparkSession, *paths: str) -> None:
    """Size shuffles for that input, unless the session's own settings do."""
    key = "spark.sql.shuffle.partitions"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, shuffle_partitions(input_bytes(spark, *paths)))
