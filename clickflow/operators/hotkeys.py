"""Keys that hold very many rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.operators.staging import stage

# A key below this many rows is sorted comfortably by one task.
HOT_ROWS = 200_000
# Keys that a sketch of frequent ones tracks, a bound of its size; it may not exceed a million.
TRACKED = 100_000
# A key is in a sketch of all rows for certain if it has more than this many rows for each row and
# tracked key: the sketch forgets at most half of that.
FORGOTTEN = 5.25
# Tasks' sketches meet in this many groups before they meet in one.
GROUPS = 64


def hot_keys(df: DataFrame, key: str, rows: int = HOT_ROWS) -> DataFrame:
    """All keys with more than ``rows`` rows, counted with partial aggregation.

    There is at most one for every ``rows`` rows. The list only routes rows to an equivalent
    path; whether it is broadcast is left to Spark, by its real size once it is staged.
    """
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter(F.col("rows") > rows).select(key)


def likely_hot_keys(df: DataFrame, key: str, rows: int = HOT_ROWS, tracked: int = TRACKED) -> DataFrame | None:
    """All keys with more than ``rows`` rows and perhaps some with fewer, staged; None if there are none.

    Every task sends a sketch of bounded size instead of a row for each of its keys, so keys are not
    shuffled. Where there are so many rows that a sketch of ``tracked`` keys could have lost
    one with more than ``rows`` of them, keys are counted as in ``hot_keys``. Null is no key.
    """
    df = df.filter(F.col(key).isNotNull())
    group = F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("group")
    state = F.call_function("approx_top_k_accumulate", F.col(key), F.lit(tracked)).alias("state")
    parts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), state)
    whole = F.call_function("approx_top_k_combine", F.col("state"), F.lit(tracked)).alias("state")
    # By a key of its own, as a table without rows has no sketch to merge.
    merged = parts.groupBy(F.lit(0).alias("all")).agg(F.sum("n").alias("n"), whole)
    frequent = F.call_function("approx_top_k_estimate", F.col("state"), F.lit(tracked))
    hot = F.filter(frequent, lambda item: item["count"] > rows)
    found = stage(merged.select("n", F.explode_outer(hot).alias("found")).select("n", F.col("found.item").alias(key)), "hot_keys")
    seen = found.agg(F.max("n").alias("n"), F.count(key).alias("keys")).first()
    if (seen.n or 0) * FORGOTTEN > float(rows) * tracked:
        counted = stage(hot_keys(df, key, rows), "counted_hot_keys")
        return None if counted.isEmpty() else counted
    return found.select(key) if seen.keys else None
