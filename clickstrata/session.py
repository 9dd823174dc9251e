"""Spark session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: All stored times are UTC, and a session day ends at UTC midnight.
TIME_ZONE = "UTC"

#: Settings that are right at any data size. Partition counts and memory belong to the
#: cluster; AQE coalesces small shuffle partitions and splits skewed join partitions.
SETTINGS = {
    "spark.sql.session.timeZone": TIME_ZONE,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # HotSpot does not compile a method above this size; run such plan parts without
    # whole-stage code rather than interpreted (several times faster in ingest)
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # merge sessions of one partition before the shuffle, so that a hot visitor sends
    # windows rather than events
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", name: str = "clickstrata") -> SparkSession:
    """A local session for tests and benchmarks."""
    partitions = 8 if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # do not record the call site of every column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def require_utc(spark: SparkSession) -> None:
    """Days and hours are UTC; a session in another zone would shift them silently."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(
            f"spark.sql.session.timeZone is {zone!r}; call clickstrata.session.configure(spark)"
        )
