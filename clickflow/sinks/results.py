"""Result writers. Nothing is written while a result is computed, only once it is complete."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickflow import schemas
from clickflow.sinks import versions
from clickflow.sources.catalog import conform

# Groups of sessions that rows of a day are clustered by.
CLUSTERS = 256
_DYNAMIC = {"partitionOverwriteMode": "dynamic"}


def write_result(df: DataFrame, path: str, task_id: int, key: str = "task_id") -> None:
    """Replace one task's rows in a Parquet folder; other tasks' rows stay as they are.

    Running a task again gives the same folder, also where its new result is empty.
    """
    df.drop(key).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{key}={int(task_id)}")


def write_result_table(df: DataFrame, table: str, task_id: int, key: str = "task_id") -> None:
    """``write_result`` into a catalog table partitioned by task."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.limit(0).write.partitionBy(key).format("parquet").saveAsTable(table)
    columns = [name for name in spark.table(table).columns if name != key]
    rows = df.select(*columns)
    spark.sql(f"INSERT OVERWRITE {table} PARTITION ({key} = {int(task_id)}) SELECT * FROM {{rows}}", rows=rows)


def read_result(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A result folder with the schema's column order and types; of a versioned one its current rows."""
    if versions.is_versioned(spark, path):
        return versions.read_folder(spark, path, schema)
    return conform(spark.read.schema(schema).parquet(path), schema)


def write_jdbc(df: DataFrame, options, table: str, batch_size: int = 1000, connections: int = 8) -> None:
    """Append to a database table in batches; each partition is one transaction.

    ``connections`` bounds how many partitions write at once. A task run again after its
    commit was lost can repeat its rows, so give the table a unique key, and delete a task's
    old rows before writing it again.
    """
    (
        df.write.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("batchsize", str(batch_size))
        .option("numPartitions", str(connections))
        .mode("append")
        .save()
    )


def _skippable(column: str, page_rows: int) -> dict:
    """Parquet options that let a scan for a few values of ``column`` leave out the rest."""
    return {
        f"parquet.bloom.filter.enabled#{column}": "true",
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.page.row.count.limit": str(page_rows),
    }


def write_actions(df: DataFrame, path: str, clusters: int = CLUSTERS, page_rows: int = 20_000) -> None:
    """The action table as Parquet by day; the days that ``df`` holds are replaced, others stay.

    So a write may be repeated. ``df`` must not read the folder itself.

    Within a day rows are clustered by a hash of their session and sorted by it, with Bloom filters and
    page statistics: a lookup of a few sessions reads the pages that hold them, see
    ``sessions.push_sessions``. Large clusters, of one session too, are split into several files at run time.
    """
    cluster = F.pmod(F.xxhash64("session_id"), F.lit(clusters))
    balanced = df.withColumn("__cluster", cluster).hint("rebalance", "date", "__cluster").drop("__cluster")
    ordered = balanced.sortWithinPartitions("date", "session_id")
    options = {**_DYNAMIC, **_skippable("session_id", page_rows)}
    ordered.write.mode("overwrite").options(**options).partitionBy("date").parquet(path)


def write_users(df: DataFrame, path: str) -> None:
    """The user table, merged by ``user_id``: rows of an id in ``df`` take the place of those there.

    So a write may be repeated. The merged table becomes visible at once; a null id is an id like
    any other, and rows of one id in ``df`` all stay. Read it with ``read_result``.
    """
    merged = df.select(*schemas.USER_INFO.names)
    if versions.is_versioned(df.sparkSession, path):
        there = versions.read_folder(df.sparkSession, path, schemas.USER_INFO)
        ids = df.select(F.col("user_id").alias("__id")).distinct()
        others = there.join(ids, F.col("user_id").eqNullSafe(F.col("__id")), "left_anti")
        merged = others.unionByName(merged)
    versions.replace_folder(merged, path)


def write_bucketed_actions(df: DataFrame, table: str, buckets: int) -> None:
    """The action table by day, bucketed by session: session roll-ups then need no shuffle.

    The days that ``df`` holds are replaced, others stay. Rows are dealt out by bucket first, so
    that a write makes one file per day and bucket, and sorted by session inside.
    """
    spark = df.sparkSession
    dealt = df.repartition(buckets, "session_id")
    if spark.catalog.tableExists(table):
        rows = dealt.select(*spark.table(table).columns)
        # A write into a catalog table takes the mode from the session alone.
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            rows.write.mode("overwrite").insertInto(table)
        finally:
            spark.conf.set(mode, before)
        return
    writer = dealt.write.options(**_skippable("session_id", 20_000)).partitionBy("date")
    writer.bucketBy(buckets, "session_id").sortBy("session_id").format("parquet").saveAsTable(table)


def preview(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows in the given order."""
    return df.orderBy(*order).limit(n)


def row_counts(tables) -> DataFrame:
    """(table, n) for a mapping of name to DataFrame."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
        for name, df in tables.items()
    ]
    result = counted[0]
    for one in counted[1:]:
        result = result.unionByName(one)
    return result
