"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: AQE does the run-time half of the skew work (it splits big shuffle partitions
#: of a join and merges tiny ones); the plans do the other half by salting.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # the JVM compiles no method beyond 8000 bytes: let Spark split the code of wide
    # projections (the encoders) instead; this made bucketizing eight times quicker
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # `hh` = '00' must stay a string when a partitioned folder is read back
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def new_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the recommended settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
