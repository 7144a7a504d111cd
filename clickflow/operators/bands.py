"""Visit-length and step-length distributions."""

from dataclasses import dataclass
from functools import reduce
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.functions.numbers import ratio
from clickflow.schemas import STEP_LABELS, VISIT_LABELS


@dataclass(frozen=True)
class Band:
    """A labelled range, both ends included; no upper end means open."""

    label: str
    low: int
    high: Optional[int] = None

    def holds(self, column: str) -> str:
        """SQL test for a value inside the band."""
        if self.high is None:
            return f"{column} >= {self.low}"
        return f"{column} BETWEEN {self.low} AND {self.high}"


# Upper ends of the bands in seconds and in steps. The first band starts at 1,
# each other one right after the band before it, and the last is open.
VISIT_ENDS = (3, 6, 9, 30, 60, 180, 600, 1800, None)
STEP_ENDS = (3, 6, 9, 30, 60, None)


def consecutive(labels, ends):
    starts = (1, *(end + 1 for end in ends[:-1]))
    return tuple(Band(*parts) for parts in zip(labels, starts, ends, strict=True))


VISIT_BANDS = consecutive(VISIT_LABELS, VISIT_ENDS)
STEP_BANDS = consecutive(STEP_LABELS, STEP_ENDS)


def _counts(bands, column, prefix):
    return [F.expr(f"count_if({band.holds(column)}) AS `{prefix}{band.label}`") for band in bands]


def _rows(wide, names, columns):
    """One row per column of a single wide row."""
    pairs = ", ".join(f"'{name}', `{name}`" for name in names)
    return wide.selectExpr(f"stack({len(names)}, {pairs}) AS ({columns})")


def band_counts(sessions: DataFrame, bands, column: str) -> DataFrame:
    """(band, sessions), one row per band, empty bands included."""
    wide = sessions.agg(*_counts(bands, column, ""))
    return _rows(wide, [band.label for band in bands], "band, sessions")


def visit_bands(sessions: DataFrame, bands=VISIT_BANDS) -> DataFrame:
    return band_counts(sessions, bands, "visit_length")


def step_bands(sessions: DataFrame, bands=STEP_BANDS) -> DataFrame:
    return band_counts(sessions, bands, "step_length")


def counters(sessions: DataFrame, visits=VISIT_BANDS, steps=STEP_BANDS) -> DataFrame:
    """(counter, value): the number of sessions and of every band, zeros included."""
    wide = sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        *_counts(visits, "visit_length", ""),
        *_counts(steps, "step_length", ""),
    )
    return _rows(wide, counter_names(visits, steps), "counter, value")


def counter_names(visits=VISIT_BANDS, steps=STEP_BANDS) -> list:
    return ["session_count", *(band.label for band in (*visits, *steps))]


def counter_states(sessions: DataFrame, visits=VISIT_BANDS, steps=STEP_BANDS) -> DataFrame:
    """(date, counter, value): ``counters`` of the sessions that start on each day, null for an unknown start.

    A state that can be stored and merged with others, see ``merge_counters``.
    """
    wide = sessions.groupBy(F.to_date("start_time").alias("date")).agg(
        F.count(F.lit(1)).alias("session_count"),
        *_counts(visits, "visit_length", ""),
        *_counts(steps, "step_length", ""),
    )
    names = counter_names(visits, steps)
    pairs = ", ".join(f"'{name}', `{name}`" for name in names)
    return wide.selectExpr("date", f"stack({len(names)}, {pairs}) AS (counter, value)")


def write_counter_states(states: DataFrame, path: str) -> None:
    """Replaces the days that ``states`` holds, others stay."""
    days = states.coalesce(1)  # sixteen rows a day
    days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def read_counter_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("date date, counter string, value bigint").parquet(path)


def merge_counters(*states: DataFrame, names=None) -> DataFrame:
    """(counter, value): the sum of any number of states by counter, as one state again.

    A state has a counter and a value column, may hold a counter any number of times or not at all, and may
    be empty: then the result is that of the others. Names that are not among ``names`` and null
    values change nothing. Every name has a row.
    """
    names = list(names or counter_names())
    parts = [state.select("counter", "value") for state in states]
    known = F.col("counter").isin(names)
    summed = reduce(DataFrame.unionByName, parts).filter(known).agg(
        *(F.coalesce(F.sum(F.when(F.col("counter") == name, F.col("value"))), F.lit(0)).alias(name) for name in names)
    )
    return _rows(summed, names, "counter, value")


def stat_of_counters(state: DataFrame, task_id: int, visits=VISIT_BANDS, steps=STEP_BANDS) -> DataFrame:
    """``aggr_stat`` from a state instead of sessions."""
    value = {name: F.coalesce(F.sum(F.when(F.col("counter") == name, F.col("value"))), F.lit(0)) for name in counter_names(visits, steps)}
    counted = state.agg(
        value["session_count"].alias("session_count"),
        *(value[band.label].alias(f"visit_length_{band.label}") for band in visits),
        *(value[band.label].alias(f"step_length_{band.label}") for band in steps),
    )
    return _shares(counted, task_id, visits, steps)


def aggr_stat(sessions: DataFrame, task_id: int, visits=VISIT_BANDS, steps=STEP_BANDS) -> DataFrame:
    """One row: the number of sessions and each band's share of them, two decimals."""
    counted = sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        *_counts(visits, "visit_length", "visit_length_"),
        *_counts(steps, "step_length", "step_length_"),
    )
    return _shares(counted, task_id, visits, steps)


def _shares(counted, task_id, visits, steps):
    names = [f"visit_length_{b.label}" for b in visits] + [f"step_length_{b.label}" for b in steps]
    return counted.select(
        F.lit(task_id).cast("bigint").alias("taskid"),
        "session_count",
        *[ratio(f"`{name}`", "session_count").alias(f"{name}_ratio") for name in names],
    )
