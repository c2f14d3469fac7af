"""Session settings the jobs are tuned for. The caller applies them, or not."""

RECOMMENDED = {
    # Merge small and split overfull shuffle partitions at run time, in joins
    # and in the rebalanced write of the user-wise split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM never compiles a method above 8000 bytes of bytecode. Beyond
    # that, Spark's operator-by-operator code is the faster one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The wide rollups hold more than 100 buffer fields with browser columns.
    "spark.sql.codegen.maxFields": "300",
    "spark.sql.session.timeZone": "UTC",
}
