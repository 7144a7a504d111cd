"""Helpers shared by the operators of this subpackage."""

import ctypes
import gc
import shutil
import tempfile
from functools import reduce, wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.operators.staging import fresh_path

# White space that separates words, as bytes.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

# A staged side up to this many bytes on disk may be broadcast; a larger one is shuffled.
BROADCAST_BYTES = 8 << 20


# Rows of an Arrow batch: documents are large rows, and a batch is held several times on its way.
BATCH_ROWS = "1000"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SPARKS_OWN = "10000"

_shipped: set[str] = set()


def tidy(function):
    """``function`` over batches, giving the worker's free memory back to the system at the end.

    Python workers outlive their task, and what they hold adds to the executor's memory.
    """

    @wraps(function)
    def run(batches):
        yield from function(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return run


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the session's Python workers, once.

    Wherever the driver has found it, executors get it from the driver. Unless the session has
    its own setting, batches for Python are made smaller, see ``BATCH_ROWS``.
    """
    context = spark.sparkContext
    if spark.conf.get(_BATCH) == _SPARKS_OWN:
        spark.conf.set(_BATCH, BATCH_ROWS)
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        target = f"{tempfile.mkdtemp()}/clickflow"
        context.addPyFile(shutil.make_archive(target, "zip", root, "clickflow"))
        _shipped.add(context.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` written to the shared folder and read back, and its size there in bytes."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.schema(df.schema).parquet(path), files.getContentSummary(folder).getLength()


def small_side(df: DataFrame, name: str, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` staged, hinted for broadcast only if what was written is at most ``most`` bytes.

    Beyond that the join is left to Spark, which shuffles both sides and splits skewed keys.
    """
    kept, size = staged(df, name)
    return F.broadcast(kept) if size <= most else kept


def parts_for(rows: int, each: int) -> int:
    """How many parts of about ``each`` rows ``rows`` rows make."""
    return max(1, -(-rows // each))


def components(links: DataFrame, left: str = "a", right: str = "b", name: str = "component") -> DataFrame:
    """Connected components of an undirected graph: node, ``name`` (its smallest node).

    In every round the ends of an edge, and the nodes that name their components so far, take the
    smaller of the two names, and every node then the name of the node it is named after, so
    names travel over distances that double. A hub is only ever aggregated to a minimum or joined
    with one row. Names are written tables, whose real size decides how Spark joins them; nothing but a
    checksum reaches the driver. Null ends and loops take no part; an empty table gives an
    empty table.
    """
    edges = links.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v")
    edges, _ = staged(edges.selectExpr("least(u, v) AS u", "greatest(u, v) AS v").distinct(), "links")
    ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("u").alias("name")), F.struct(F.col("v").alias("node"), F.col("u").alias("name"))))
    names = edges.select(ends.alias("e")).select("e.*").groupBy("node").agg(F.min("name").alias("name"))
    names, _ = staged(names, "names")
    before = None
    while True:
        seen = edges
        for end in ("u", "v"):
            seen = seen.join(names.select(F.col("node").alias(end), F.col("name").alias(f"name_{end}")), end)
        both = F.least("name_u", "name_v").alias("name")
        taken = F.explode(F.array(*(F.struct(F.col(c).alias("node"), both) for c in ("u", "v", "name_u", "name_v"))))
        hooked = seen.filter("name_u <> name_v").select(taken.alias("e")).select("e.*").unionByName(names)
        hooked, _ = staged(hooked.groupBy("node").agg(F.min("name").alias("name")), "hooked")
        further = hooked.select(F.col("node").alias("name"), F.col("name").alias("next"))
        names, _ = staged(hooked.join(further, "name").select("node", F.col("next").alias("name")), "names")
        check = names.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "name").cast("decimal(38,0)"))).first()
        if check == before:
            break
        before = check
    return names.withColumnRenamed("name", name)


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
