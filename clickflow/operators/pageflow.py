"""Page-to-page steps inside sessions and conversion along a target flow."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickflow.functions.numbers import ratio
from clickflow.operators.hotkeys import HOT_ROWS, likely_hot_keys
from clickflow.operators.sessions import in_sessions
from clickflow.operators.staging import stage
from clickflow.params import page_hops

# Longest run of consecutive tiebreak values in one piece of a hot session.
PIECE = 100_000


def page_steps(actions: DataFrame, tiebreak: str = None, hot_rows: int = HOT_ROWS, piece: int = PIECE) -> DataFrame:
    """(page_id, next_page_id, n): how often a page is followed by another in a session.

    Actions are ordered by time and then by ``tiebreak``, a unique integer column, or by page
    where there is none; nulls come first. The last action of a session has no next page and
    counts under null, as does an action outside any session.

    Actions are scanned twice: for sessions that may have more than ``hot_rows`` actions, and to pair
    pages, where alone they are shuffled. Only the actions of hot sessions are cut into pieces, see ``_steps_in_pieces``.
    """
    hot = likely_hot_keys(in_sessions(actions), "session_id", hot_rows)
    columns = ["session_id", "action_time", "page_id", *([tiebreak] if tiebreak else [])]
    actions = actions.select(*columns)
    # An action outside any session is a group of its own.
    lone = F.when(F.col("session_id").isNull(), F.monotonically_increasing_id()).alias("lone")
    if hot is None:
        order = W.partitionBy("session_id", "lone").orderBy("action_time", tiebreak or "page_id")
        next_page = F.lead("page_id").over(order).alias("next_page_id")
        steps = actions.select("*", lone).select("page_id", next_page, F.lit(1).alias("n"))
    else:
        steps = _steps_in_pieces(actions.select("*", lone), tiebreak, hot, piece)
    return steps.groupBy("page_id", "next_page_id").agg(F.sum("n").alias("n"))


def _steps_in_pieces(actions, tiebreak, hot, piece):
    """Page pairs with hot sessions cut into pieces that follow their order.

    A piece is a time and a run of tiebreak values. Without a tiebreak it is a time and a page: its
    actions are copies of each other, so any split of them will do. Pages are paired inside
    pieces, and the last page of each piece with the first page of the next. Actions of other
    sessions are in no piece and take the same window.
    """
    flagged = actions.join(hot.withColumn("hot", F.lit(True)), "session_id", "left")
    if tiebreak is None:
        run, part = "page_id", "spark_partition_id()"
    else:
        run, part = f"`{tiebreak}` div {piece}", "0"
    place = f"if(hot, named_struct('time', action_time, 'run', {run}, 'part', {part}), NULL)"
    pieces = flagged.withColumn("piece", F.expr(place))

    window = W.partitionBy("session_id", "lone", "piece").orderBy("action_time", tiebreak or "page_id")
    present = F.lit(True)
    paired = pieces.select(
        "session_id",
        "piece",
        "page_id",
        F.lead("page_id").over(window).alias("next_page_id"),
        F.lag(present).over(window).isNull().alias("first"),
        F.lead(present).over(window).isNull().alias("last"),
    )
    # Only the ends of a hot session's pieces keep their session; all else collapses to page pairs.
    cut = F.col("piece").isNotNull()
    end = cut & (F.col("first") | F.col("last"))
    collapsed = paired.groupBy(
        "page_id",
        "next_page_id",
        F.when(end, F.col("session_id")).alias("session_id"),
        F.when(end, F.col("piece")).alias("piece"),
        (cut & F.col("first")).alias("first"),
        (cut & F.col("last")).alias("last"),
    ).agg(F.count(F.lit(1)).alias("n"))
    collapsed = stage(collapsed, "page_pairs")

    inside = collapsed.filter(~F.col("last")).select("page_id", "next_page_id", "n")
    ends = (
        collapsed.filter(F.col("session_id").isNotNull())
        .groupBy("session_id", "piece")
        .agg(
            F.max(F.when(F.col("first"), F.col("page_id"))).alias("entry"),
            F.max(F.when(F.col("last"), F.col("page_id"))).alias("exit"),
        )
    )
    return inside.unionByName(_across(ends))


def _across(ends):
    """Steps from piece to piece, given each piece's first and last page.

    Pieces are joined up within a second, seconds within an hour and hours within a session,
    so that no task sees all pieces of a session.
    """
    levels = (
        (["session_id", "hour", "second"], "piece"),
        (["session_id", "hour"], "second"),
        (["session_id"], "hour"),
    )
    ends = ends.withColumn("second", F.unix_timestamp("piece.time"))
    ends = ends.withColumn("hour", F.floor(F.col("second") / 3600))
    steps = []
    for within, order in levels:
        window = W.partitionBy(*within).orderBy(order)
        linked = ends.select(
            F.col("exit").alias("page_id"),
            F.lead("entry").over(window).alias("next_page_id"),
            F.lit(1).alias("n"),
            F.lead(F.lit(True)).over(window).alias("linked"),
        )
        steps.append(linked.filter("linked").drop("linked"))
        # A null time is the smallest inside a struct, as in the window; alone it would be skipped.
        place = F.struct(order)
        ends = ends.groupBy(*within).agg(
            F.min_by("entry", place).alias("entry"), F.max_by("exit", place).alias("exit")
        )
    final = ends.selectExpr("exit AS page_id", "CAST(NULL AS BIGINT) AS next_page_id", "1 AS n")
    return reduce(DataFrame.unionByName, steps, final)


def page_slices(steps: DataFrame) -> DataFrame:
    """Consecutive page pairs, without the ends of sessions."""
    return steps.filter(F.col("next_page_id").isNotNull())


def page_flow_matches(steps: DataFrame, flow) -> DataFrame:
    """(slice, n): page pairs that are consecutive steps of the flow."""
    wanted = " OR ".join(f"page_id = {a} AND next_page_id = {b}" for a, b in page_hops(flow))
    return steps.filter(wanted).selectExpr("concat(page_id, '_', next_page_id) AS slice", "n")


def page_conversion(steps: DataFrame, flow) -> DataFrame:
    """(slice, n, rate): share of the step before that goes on, for each hop of the flow.

    The first hop is measured against all views of the first page.
    """
    hops = page_hops(flow)
    tests = [f"page_id = {hops[0][0]}"] + [f"page_id = {a} AND next_page_id = {b}" for a, b in hops]
    wide = steps.filter(F.col("page_id").isin([a for a, _ in hops])).agg(
        *[F.expr(f"coalesce(sum(if({test}, n, 0)), 0) AS n{i}") for i, test in enumerate(tests)]
    )
    rows = [
        F.struct(
            F.lit(f"{a}_{b}").alias("slice"),
            F.col(f"n{i}").alias("n"),
            ratio(f"n{i}", f"n{i - 1}").alias("rate"),
        )
        for i, (a, b) in enumerate(hops, 1)
    ]
    return wide.select(F.inline(F.array(*rows)))
