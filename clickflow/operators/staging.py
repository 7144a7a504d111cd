"""Intermediate results written once to the cluster's shared folder and read many times.

A written table cuts lineage, survives the loss of executors and carries real sizes, so
later joins are planned on what is there. Tables of a run with a key also survive the loss of the
driver: the next run with the same key reads those that were written in whole.
"""

import hashlib
import json
import re
import tempfile
import uuid
from collections import Counter
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Part of every run's key; raised when staged tables change their content or order.
STAGES_VERSION = 1
_FIELDS = "spark.sql.debug.maxToStringFields"


@dataclass
class _Run:
    """A run's folder. With ``resumable`` its tables have names that the next run finds again."""

    path: str
    resumable: bool
    seen: Counter = field(default_factory=Counter)


_run = ContextVar("run", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` or set as checkpoint folder.

    Only a single-process session, as in tests, falls back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="clickflow-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def files_of(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def session_folder(spark: SparkSession) -> str:
    """This application's folder in the shared one, deleted when the driver ends."""
    path = f"{shared_folder(spark)}/clickflow/{spark.sparkContext.applicationId}"
    folder, files = files_of(spark, path)
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own in this application's folder, or in the current run's folder."""
    run = _run.get()
    return f"{run.path if run else session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to its end."""
    mark, files = files_of(spark, f"{path}/_SUCCESS")
    return files.exists(mark)


def _sources(df: DataFrame) -> list:
    """The leaves of a DataFrame's plan."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return [leaves.apply(i) for i in range(leaves.size())]


def _plan_text(df: DataFrame) -> str:
    """How a DataFrame is derived from its sources, without the numbers of one session."""
    conf = df.sparkSession.conf
    before = conf.get(_FIELDS, None)
    conf.set(_FIELDS, "1000000")
    try:
        return df._jdf.queryExecution().analyzed().canonicalized().toString()
    finally:
        if before is None:
            conf.unset(_FIELDS)
        else:
            conf.set(_FIELDS, before)


def _file_versions(df: DataFrame) -> list:
    """(path, size, time) of every file that a DataFrame reads, listed folder by folder."""
    spark, wanted = df.sparkSession, set(df.inputFiles())
    found = []
    for parent in sorted({path.rpartition("/")[0] for path in wanted}):
        folder, files = files_of(spark, parent)
        for status in files.listStatus(folder):
            found.append((status.getPath().getName(), status.getLen(), status.getModificationTime()))
        found.append((parent, sum(path.rpartition("/")[0] == parent for path in wanted), 0))
    return found


def run_key(inputs: list[DataFrame], settings: dict, input_version: str = None) -> str | None:
    """Names a run by what it computes: its settings and its inputs' derivation and version.

    ``input_version`` is the caller's name for the state of all inputs, such as a snapshot's id. Without
    it the files that the inputs read stand for it, by name, size and time; an input that is not
    made of files alone has no version, and the run no key.
    """
    parts = [STAGES_VERSION, json.dumps(settings, sort_keys=True, default=str), input_version]
    for df in inputs:
        if input_version is None:
            kinds = {leaf.getClass().getSimpleName() for leaf in _sources(df)}
            if kinds != {"LogicalRelation"} or not df.inputFiles():
                return None
            parts.append(_file_versions(df))
        parts.append(_plan_text(df))
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()[:32]


@contextmanager
def run_folder(spark: SparkSession, key: str = None):
    """Tables staged inside the block share one folder, deleted when the block ends.

    With a ``key`` the folder is deleted only when the block ends well. After a failure, or when
    the driver was lost, the next block with the same key finds its tables there: each name is
    counted, so the block must stage the same tables in the same order. One block for a key at a time.
    """
    path = fresh_path(spark, "run") if key is None else f"{shared_folder(spark)}/clickflow/runs/{key}"
    token = _run.set(_Run(path, key is not None))
    ended = False
    try:
        yield path
        ended = True
    finally:
        _run.reset(token)
        if ended or key is None:
            folder, files = files_of(spark, path)
            files.delete(folder, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under a fresh path and read back with its own schema.

    In a run with a key a table that is there already is read instead. It is written elsewhere first and
    then renamed, so that a half-written one is never taken for it.
    """
    spark, run = df.sparkSession, _run.get()
    path = fresh_path(spark, name)
    if run is None or not run.resumable:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    run.seen[name] += 1
    kept = f"{run.path}/{name}-{run.seen[name]}"
    if not is_written(spark, kept):
        df.write.parquet(path)
        (written, files), (place, _) = files_of(spark, path), files_of(spark, kept)
        files.delete(place, True)
        files.rename(written, place)
    return spark.read.schema(df.schema).parquet(kept)


def is_empty(df: DataFrame) -> bool:
    """Whether a staged table has no rows."""
    return df.isEmpty()
