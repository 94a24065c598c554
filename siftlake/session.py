"""Session settings the rule expressions profit from."""

from pyspark.sql import SparkSession

# May change in a running session.
SETTINGS = {
    # The JVM does not compile methods above 8000 bytes of bytecode. Very wide projections exceed
    # that in one generated method, so whole-stage code gives way to small methods there.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Only take effect when the session is built.
BUILD_SETTINGS = {
    # Recording the call site of every Column operation costs extra round trips to the JVM.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Put all settings on a session builder."""
    for key, value in {**SETTINGS, **BUILD_SETTINGS}.items():
        builder = builder.config(key, value)
    return builder


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings that a running session can still take."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
