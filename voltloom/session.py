"""Session defaults used by tests, bench and local runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "voltloom", master: str | None = None, shuffle_partitions: int | None = None,
                  driver_memory: str | None = None, **extra: str) -> SparkSession:
    """A session with UTC clock, AQE (coalesce + skew split) and Arrow.

    On a cluster ``master`` and sizes come from spark-submit; the arguments are
    for local runs.  No broadcast threshold is raised: joins are planned from
    the sizes AQE measures at run time.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    for k, v in extra.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
