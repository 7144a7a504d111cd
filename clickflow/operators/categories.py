"""Category popularity, and the most active sessions of the popular categories."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickflow.functions.text import csv_to_ids, is_not_empty
from clickflow.operators.sessions import actions_of

KINDS = ("click", "order", "pay")
COUNTS = tuple(f"{kind}_count" for kind in KINDS)
DEFAULT_TOP = 10
# Spark limits ranks before the shuffle up to this rank; beyond it a category is ranked in slices first.
LIMITED_RANK = 1_000
SLICES = 64


def category_touches(actions: DataFrame) -> DataFrame:
    """(session_id, kind, category_id): one row per category an action clicked, ordered or paid."""

    def tagged(kind, ids):
        pairs = F.transform(
            ids, lambda c: F.struct(F.lit(kind).alias("kind"), c.alias("category_id"))
        )
        return F.coalesce(pairs, F.array().cast("array<struct<kind:string,category_id:bigint>>"))

    click = F.col("click_category_id")
    clicked = F.when(click.isNotNull(), F.array(click))
    touches = F.concat(
        tagged("click", clicked),
        tagged("order", csv_to_ids(F.col("order_category_ids"))),
        tagged("pay", csv_to_ids(F.col("pay_category_ids"))),
    )
    touching = (
        click.isNotNull()
        | is_not_empty(F.col("order_category_ids"))
        | is_not_empty(F.col("pay_category_ids"))
    )
    return actions.filter(touching).select("session_id", F.inline(touches))


def session_category_counts(actions: DataFrame) -> DataFrame:
    """(session_id, category_id, click_count, order_count, pay_count)."""
    counts = [
        F.count_if(F.col("kind") == kind).alias(name) for kind, name in zip(KINDS, COUNTS, strict=True)
    ]
    return category_touches(actions).groupBy("session_id", "category_id").agg(*counts)


def kept_category_counts(actions: DataFrame, kept: DataFrame) -> DataFrame:
    """``session_category_counts`` of the kept sessions only; ``kept`` should be staged.

    Actions meet the kept list before anything is parsed or counted.
    """
    return session_category_counts(actions_of(actions, kept))


def categories_touched(counts: DataFrame) -> DataFrame:
    return counts.select("category_id").distinct()


def category_totals(counts: DataFrame) -> DataFrame:
    """(category_id, click_count, order_count, pay_count); a kind that never occurs counts 0."""
    return counts.groupBy("category_id").agg(*[F.sum(name).alias(name) for name in COUNTS])


def category_count(counts: DataFrame, kind: str) -> DataFrame:
    """(category_id, n) of one kind, categories without it left out."""
    total = F.sum(f"{kind}_count").alias("n")
    return counts.groupBy("category_id").agg(total).filter(F.col("n") > 0)


def top_categories(counts: DataFrame, k: int = DEFAULT_TOP) -> DataFrame:
    """The k categories with most clicks, then orders, then pays, then the smallest id."""
    order = [F.desc(name) for name in COUNTS] + [F.asc("category_id")]
    return category_totals(counts).orderBy(*order).limit(k)


def _ranked(counts: DataFrame, k: int, *keys) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc("click_count"), "session_id")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")


def top_category_sessions(counts: DataFrame, top: DataFrame, k: int = DEFAULT_TOP) -> DataFrame:
    """(category_id, session_id, click_count): each top category's k sessions with most clicks.

    ``top`` should be staged; its real size decides how it is joined. Ranks are limited
    before the shuffle: by Spark up to ``LIMITED_RANK``, beyond it by ranking hash slices of
    a category first, of which no more than k sessions each go on.
    """
    active = counts.filter(F.col("click_count") > 0).join(top.select("category_id"), "category_id", "left_semi")
    active = active.select("category_id", "session_id", "click_count")
    if k > LIMITED_RANK:
        slice_ = F.expr(f"pmod(xxhash64(session_id), {SLICES})")
        active = _ranked(active.withColumn("slice", slice_), k, "category_id", "slice").drop("slice")
    return _ranked(active, k, "category_id")
