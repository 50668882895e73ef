"""Session settings the library is meant to run with. It works without them, only slower."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Timestamps turn into days by this zone.
    "spark.sql.session.timeZone": "UTC",
    # Coalesces small partitions, and splits the join partition of a customer with very many
    # orders, also where that costs another shuffle later in the plan. The build of the fact needs
    # this in sessions made elsewhere too: without it the split is given up there.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Up to so many values of a key are asked for by value in a scan (operators.loading.FEW_KEYS).
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # The JVM does not compile methods above 8000 bytes; past that, Spark's split code is faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording a call site for every column expression doubles the time to build a query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


PARTITION_BYTES = 128 << 20


def configured(
    builder: SparkSession.Builder, shuffled_bytes: int | None = None
) -> SparkSession.Builder:
    """The settings; ``shuffled_bytes`` is the size of the largest shuffle that is expected.

    Adaptive execution merges shuffle partitions and does not add any, so it starts with as many as
    give 128 MB each. Without the size Spark's default of 200 stays, which is right up to 25 GB.
    """
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffled_bytes:
        start = max(200, -(-shuffled_bytes // PARTITION_BYTES))
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(start))
    return builder


def local_session(cpus: int | str = 8, **settings: str) -> SparkSession:
    """One JVM with a shuffle partition per core, for tests and measurements."""
    builder = configured(SparkSession.builder.master(f"local[{cpus}]").appName("martwright"))
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    builder = builder.config("spark.sql.shuffle.partitions", str(cpus))
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
