"""Spark session bootstrap."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # Recording a call site for every column operation makes plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name="clickflow", master=None, hive=False, settings=None) -> SparkSession:
    """A session with this library's settings.

    ``hive=True`` reads tables from a Hive metastore, otherwise the in-memory catalog
    is used. ``master=None`` leaves the choice to spark-submit.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()
