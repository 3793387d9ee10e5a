"""Session settings the results and the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Of shuffled data for a task. Ids and counts are compressed to a tenth of what a
#: sort and a hash table of them take together, so Spark's own 64 MB would be 1 GB.
TASK_BYTES = "16m"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def tune(spark: SparkSession) -> SparkSession:
    """Apply runtime settings to a session the caller owns.

    How many partitions a shuffle starts from is the session's to say, in
    `spark.sql.shuffle.partitions`: about its volume over 256 MB. Adaptive
    execution merges those that turn out small, up to TASK_BYTES unless the
    session names a size of its own.
    """
    cores = spark.sparkContext.defaultParallelism
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Listing a table of many days takes a few tasks per core, not one per day.
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(max(32, 4 * cores)),
    }
    if spark.conf.get(ADVISORY, None) is None:
        settings[ADVISORY] = TASK_BYTES
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark
