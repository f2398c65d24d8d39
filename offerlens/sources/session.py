"""Session settings the engine counts on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# One seller, item or order may hold a third of the rows.  Adaptive execution
# splits such join partitions at run time; ``force`` lets it do so even where the
# split costs one more shuffle after the join (a join on the key that the next
# step groups by).  Memory-sized partitions follow from the advisory size, so the
# number of shuffle partitions is only an upper bound.
#
# A broadcast passes through the driver.  Frames of one row per seller lie in parquet at
# an eighth of their size in memory or less, so by file size they would be broadcast far
# beyond the limit; the factor lets Spark compare what it would hold.  After a shuffle
# the rows are placed already, and only short sides are worth a broadcast.
#
# Stage tables dealt by seller are read back so dealt even if only the next write, and no
# join or aggregate, asks for it.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.fileCompressionFactor": "8.0",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "1m",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark
