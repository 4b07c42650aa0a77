"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Feature rows are wider than Spark's default limit of 100 code-generated
# fields, so that is raised. The JVM does not compile methods above 8,000 bytes of
# byte code; beyond that Spark's own split projections are faster.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.maxFields": "300",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Windows turn a narrow bar into a hundred columns, so small shuffles are
    # worth spreading over the cores too.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
}

# A wide feature table compiles several hundred classes; Spark keeps 100 by default and would compile them all again in the
# next run. A static setting: it must be given when the session is started.
_CODE_CACHE = 4000


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session and return it."""
    for name, value in _SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(
    cores: int | str = 8, shuffle_partitions: int = 8, app: str = "tickloom", options: dict[str, str] | None = None
) -> SparkSession:
    """Session for tests and single-machine benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.cache.maxEntries", str(_CODE_CACHE))
    )
    for name, value in (options or {}).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)
