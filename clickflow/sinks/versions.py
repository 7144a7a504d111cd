"""Result tables of a task that become visible all at once.

A run writes every table to a folder of its own that nobody reads yet. When all are written, a
manifest that names them is put in place by one rename, under a number not used before. Readers
resolve the manifest with the highest number. A run that ends early leaves no manifest, so they
go on seeing the version before, of all tables.

The rename is atomic on HDFS and local disks. On a store without renames the manifest, one small
object, still appears as a whole.
"""

import hashlib
import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from clickflow.operators.staging import files_of, is_written
from clickflow.sources.catalog import conform

MANIFESTS = "_versions"
DATA = "data"


@dataclass(frozen=True)
class Manifest:
    """``tables``: each table's folder, relative to the target."""

    task_id: int
    number: int
    version: str
    tables: dict

    def paths(self, target: str) -> dict:
        return {name: f"{target.rstrip('/')}/{folder}" for name, folder in self.tables.items()}


def _manifest_folder(target: str, task_id: int) -> str:
    return f"{target.rstrip('/')}/{MANIFESTS}/{int(task_id)}"


def _names(spark: SparkSession, path: str) -> list[str]:
    folder, files = files_of(spark, path)
    if not files.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(folder))


def _numbers(spark: SparkSession, target: str, task_id: int) -> list[int]:
    names = _names(spark, _manifest_folder(target, task_id))
    return [int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[:-5].isdigit()]


def _load(spark: SparkSession, target: str, task_id: int, number: int) -> Manifest:
    path, files = files_of(spark, f"{_manifest_folder(target, task_id)}/{number:08d}.json")
    stream = files.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(**json.loads(text))


def current(spark: SparkSession, target: str, task_id: int) -> Manifest | None:
    """The task's newest complete version; None if it has none."""
    numbers = _numbers(spark, target, task_id)
    return _load(spark, target, task_id, numbers[-1]) if numbers else None


def new_version(spark: SparkSession, target: str, task_id: int, run_key: str | None = None) -> str:
    """A name for what a run is about to write.

    A run with a key gets the same name until the task's next version is committed, so that it finds
    the tables that an interrupted run of the same key has written.
    """
    if run_key is None:
        return uuid.uuid4().hex
    numbers = _numbers(spark, target, task_id)
    return hashlib.sha256(f"{run_key} {numbers[-1] if numbers else 0}".encode()).hexdigest()[:32]


def write_table(df: DataFrame, target: str, name: str, task_id: int, version: str) -> str:
    """Writes one table of a version that is not committed yet; its folder, relative to the target.

    Already written in whole by an interrupted run of the same version, it is left as it is.
    """
    folder = f"{DATA}/{name}/{int(task_id)}/{version}"
    path = f"{target.rstrip('/')}/{folder}"
    if not is_written(df.sparkSession, path):
        df.write.mode("overwrite").parquet(path)
    return folder


def commit(spark: SparkSession, target: str, task_id: int, version: str, tables: dict) -> Manifest:
    """Makes ``tables`` (name to folder) the task's current version.

    Of two runs that commit at the same time both get a number of their own, and the higher is current.
    """
    parent = _manifest_folder(target, task_id)
    folder, files = files_of(spark, parent)
    files.mkdirs(folder)
    draft, _ = files_of(spark, f"{parent}/.draft-{uuid.uuid4().hex}")
    while True:
        number = max(_numbers(spark, target, task_id), default=0) + 1
        manifest = Manifest(int(task_id), number, version, dict(tables))
        out = files.create(draft, True)
        out.write(json.dumps(manifest.__dict__, sort_keys=True).encode())
        out.close()
        place, _ = files_of(spark, f"{parent}/{number:08d}.json")
        if not files.exists(place) and files.rename(draft, place):
            return manifest


def read_table(spark: SparkSession, target: str, name: str, schema: StructType, task_ids=None) -> DataFrame:
    """A table's current rows of all tasks, or of ``task_ids``, with the schema's columns and types.

    Tasks without a version, or whose version lacks the table, have no rows.
    """
    if task_ids is None:
        task_ids = [int(n) for n in _names(spark, f"{target.rstrip('/')}/{MANIFESTS}") if n.lstrip("-").isdigit()]
    found = [current(spark, target, task_id) for task_id in task_ids]
    paths = [m.paths(target)[name] for m in found if m is not None and name in m.tables]
    if not paths:
        return spark.createDataFrame([], schema)
    return conform(spark.read.schema(schema).parquet(*paths), schema)


def drop_old_versions(spark: SparkSession, target: str, task_id: int, keep: int = 2, idle_seconds: float = 86_400) -> list[str]:
    """Deletes what no reader resolves any more; the folders that went, relative to the target.

    The newest ``keep`` versions (at least the current one) stay. Folders without a manifest are a
    run's that was interrupted or still writes: they go once untouched for ``idle_seconds``.
    """
    numbers = _numbers(spark, target, task_id)
    kept = [_load(spark, target, task_id, number) for number in numbers[-max(1, keep) :]]
    named = {folder for manifest in kept for folder in manifest.tables.values()}
    old = numbers[: -max(1, keep)]
    committed = {folder for number in old for folder in _load(spark, target, task_id, number).tables.values()}
    for number in old:
        path, files = files_of(spark, f"{_manifest_folder(target, task_id)}/{number:08d}.json")
        files.delete(path, False)
    gone = []
    for name in _names(spark, f"{target.rstrip('/')}/{DATA}"):
        parent, files = files_of(spark, f"{target.rstrip('/')}/{DATA}/{name}/{int(task_id)}")
        for status in files.listStatus(parent) if files.exists(parent) else ():
            folder = f"{DATA}/{name}/{int(task_id)}/{status.getPath().getName()}"
            idle = time.time() - status.getModificationTime() / 1000 >= idle_seconds
            if folder not in named and (folder in committed or idle):
                files.delete(status.getPath(), True)
                gone.append(folder)
    return gone


# A folder of one table that belongs to no task is versioned under these.
ALONE, ROWS = 0, "rows"


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(spark, path, ALONE))


def read_folder(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The current rows of a folder that ``replace_folder`` writes."""
    return read_table(spark, path, ROWS, schema, [ALONE])


def replace_folder(df: DataFrame, path: str, keep: int = 2) -> None:
    """``df`` becomes the folder's content at once; the ``keep`` newest versions stay for readers under way.

    ``df`` may read the folder itself.
    """
    spark = df.sparkSession
    version = new_version(spark, path, ALONE)
    commit(spark, path, ALONE, version, {ROWS: write_table(df, path, ROWS, ALONE, version)})
    drop_old_versions(spark, path, ALONE, keep)
