"""A table's folders: one for each epoch, and merged ones, each for a stretch of epochs.

    <table>/epoch_id=12/...                 what an epoch wrote
    <table>.merged/run=1-0-9/...            epochs 0 to 9, merged once

Merged folders are merged again, ten of a kind at a time, so a row is copied once for each tenfold
of the epochs and folders stay few. A merged folder counts from when its write is complete; from then
on readers pass over those it covers, which the next merge removes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

EPOCH = "epoch_id"
FAN_IN = 10


@dataclass(frozen=True, order=True)
class Run:
    """Epochs `first` to `last` of a table; `level` is how often they were merged."""

    first: int
    last: int
    level: int

    @property
    def name(self) -> str:
        return f"{self.level}-{self.first}-{self.last}"

    def folder(self, path: str) -> str:
        if self.level == 0:
            return f"{path}/{EPOCH}={self.first}"
        return f"{path}.merged/run={self.name}"

    def covers(self, other: Run) -> bool:
        inside = self.first <= other.first and other.last <= self.last
        return inside and self.level > other.level


def _hadoop(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _hadoop(spark, path)
    return files.exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this job wrote."""
    files, place = _hadoop(spark, path)
    files.delete(place, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    files, place = _hadoop(spark, path)
    if not files.exists(place):
        return []
    return [status.getPath().getName() for status in files.listStatus(place)]


def _all_runs(spark: SparkSession, path: str) -> list[Run]:
    """Every complete folder, oldest epochs first, also those that others cover."""
    found = []
    for name in folder_names(spark, path):
        if name.startswith(f"{EPOCH}="):
            epoch = int(name.split("=")[1])
            found.append(Run(epoch, epoch, 0))
    for name in folder_names(spark, f"{path}.merged"):
        level, first, last = map(int, name.removeprefix("run=").split("-"))
        run = Run(first, last, level)
        if path_exists(spark, f"{run.folder(path)}/_SUCCESS"):
            found.append(run)
    return sorted(found)


def runs(spark: SparkSession, path: str) -> list[Run]:
    """The folders that hold the table's rows, each epoch in one of them."""
    found = _all_runs(spark, path)
    return [run for run in found if not any(other.covers(run) for other in found)]


def read_runs(spark: SparkSession, path: str, schema: T.StructType, chosen: list[Run]) -> DataFrame:
    """Rows of some of a table's folders. `schema` has the epoch, and columns that folders tell."""
    parts = []
    for merged in (False, True):
        folders = [run.folder(path) for run in chosen if (run.level > 0) == merged]
        if folders:
            base = f"{path}.merged" if merged else path
            rows = spark.read.schema(schema).option("basePath", base).parquet(*folders)
            parts.append(rows.select(*schema.fieldNames()))
    if not parts:
        return spark.createDataFrame([], schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def merge_runs(
    spark: SparkSession,
    path: str,
    before: int,
    merge: Callable[[list[Run], str], None],
    fan_in: int = FAN_IN,
) -> list[Run]:
    """Where `fan_in` folders of a kind have come together, `merge(runs, folder)` writes them as one.

    Only epochs below `before` are merged, and no backfill's, which is one large folder from the
    start. Gives the folders removed: what earlier merges have covered. Done again after a break it
    does the same.
    """
    found = _all_runs(spark, path)
    covered = [run for run in found if any(other.covers(run) for other in found)]
    kept = [run for run in found if run not in covered]
    level, removed = 0, []
    while True:
        ready = [run for run in kept if run.level == level and 0 <= run.first and run.last < before]
        if len(ready) < fan_in:
            if level >= max((run.level for run in kept), default=0):
                return removed
        else:
            if not removed:
                for run in covered:
                    remove_path(spark, run.folder(path))
                removed = covered
            merged = Run(ready[0].first, ready[-1].last, level + 1)
            merge(ready, merged.folder(path))
            kept = [run for run in kept if run not in ready] + [merged]
        level += 1
