"""Which of a batch's keys a growing table holds, without reading the keys it holds.

For each folder of the table (`runs.py`) there are two more, written once the folder is whole:

    <table>.filters/run=.../    a Bloom filter: rows of 32,768 bits, a key's eight in one row
    <table>.ids/run=.../prefix=3/   the keys, by a hash prefix in large folders

New keys, nearly all of a batch, are told from the filters: some three bytes a key, and those of merged
folders stay cached for the life of a stream, so a batch reads the filters of the few newest epochs.
A key that a filter takes for a known one, as it is or once in thirty thousand, is looked for among
the ids of that folder and prefix, and there only. The answer is exact. Folders whose index is not
complete get one when they are first asked about; a stream broken off at any point goes on.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runs import EPOCH, Run, folder_names, path_exists, read_runs, remove_path, runs

#: Bits of a filter row, keys that share one on average, and bits that a key sets.
ROW_BITS, ROW_KEYS, KEY_BITS = 32_768, 1_300, 8
#: Keys of one prefix folder, about, and most folders.
PREFIX_KEYS, MOST_PREFIXES = 100_000, 256

_FILTER = "run string, bucket int, bits binary"
_PER_HASH = 4  # positions of 15 bits in a hash of 64


def _bucket(key: Column, buckets: Column | int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), key), F.lit(buckets)).cast("int")


def _prefix(key: Column, prefixes: Column | int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), key), F.lit(prefixes)).cast("int")


def _positions(key: Column) -> list[Column]:
    hashes = [F.xxhash64(F.lit(2 + k // _PER_HASH), key) for k in range(KEY_BITS)]
    return [
        F.shiftrightunsigned(h, 15 * (k % _PER_HASH)).bitwiseAND(ROW_BITS - 1).cast("int")
        for k, h in enumerate(hashes)
    ]


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.substring(bits, F.shiftright(position, 3) + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.call_function("shiftright", value, position.bitwiseAND(7)).bitwiseAND(1) == 1


class KeyIndex:
    """The index of one table. One object serves a stream: it keeps the filters it has read.

    `asked` lists the folders of ids that the last question had to read.
    """

    def __init__(self, table_path: str, schema: T.StructType, key: str):
        self.path, self.schema, self.key = table_path, schema, key
        self.asked: list[str] = []
        self._held: DataFrame | None = None
        self._held_names: list[str] = []

    def absent(self, rows: DataFrame, epoch: int) -> DataFrame:
        """`rows` whose key no earlier epoch has. One row a key; they are read more than once."""
        spark = rows.sparkSession
        found = [run for run in runs(spark, self.path) if run.first < epoch]
        earlier = [run for run in found if run.last < epoch]
        names = self._indexed(spark, earlier)
        self.asked = self._suspected(rows, names)
        known = []
        if self.asked:
            ids = spark.read.schema(T.StructType([self.schema[self.key]]))
            known.append(ids.parquet(*self.asked))
        if len(found) > len(earlier):
            # An old epoch run again after a merge that holds it as well.
            around = read_runs(spark, self.path, self.schema, [r for r in found if r not in earlier])
            known.append(around.where(F.col(EPOCH) < epoch).select(self.key))
        if not known:
            return rows
        return rows.join(reduce(DataFrame.unionByName, known), self.key, "left_anti")

    def forget(self, spark: SparkSession, removed: list[Run]) -> None:
        """Remove the indexes of folders that are no more."""
        gone = {run.name for run in removed}
        for root in (f"{self.path}.filters", f"{self.path}.ids"):
            for folder in folder_names(spark, root):
                if _run_name(folder) in gone:
                    remove_path(spark, f"{root}/{folder}")

    # Building ----------------------------------------------------------------------------------

    def _indexed(self, spark: SparkSession, wanted: list[Run]) -> list[str]:
        """Folder names of the runs' filters, in order; those that lack one are indexed first."""
        there = {
            _run_name(folder): folder
            for folder in folder_names(spark, f"{self.path}.filters")
            if path_exists(spark, f"{self.path}.filters/{folder}/_SUCCESS")
        }
        return [there.get(run.name) or self._index(spark, run) for run in wanted]

    def _index(self, spark: SparkSession, run: Run) -> str:
        keys = read_runs(spark, self.path, self.schema, [run]).select(self.key)
        n = keys.count()
        buckets = max(1, -(-n // ROW_KEYS))
        prefixes = max(1, min(MOST_PREFIXES, n // PREFIX_KEYS))
        folder = f"run={run.name}_{buckets}_{prefixes}"
        key = F.col(self.key)
        dealt = keys.withColumn("prefix", _prefix(key, prefixes))
        # A folder of one prefix is one file; larger ones have a file or more for each.
        dealt = dealt.coalesce(1) if prefixes == 1 else dealt.repartition(prefixes, "prefix")
        dealt.write.mode("overwrite").partitionBy("prefix").parquet(f"{self.path}.ids/{folder}")
        bits = keys.select(
            _bucket(key, buckets).alias("bucket"), F.explode(F.array(*_positions(key))).alias("at")
        )
        rows = bits.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits"))
        # Last, as a whole filter tells that the index is whole.
        rows.write.mode("overwrite").option("compression", "zstd").parquet(
            f"{self.path}.filters/{folder}"
        )
        return folder

    # Asking ------------------------------------------------------------------------------------

    def _suspected(self, rows: DataFrame, names: list[str]) -> list[str]:
        """Folders of ids that may hold a key of the rows: as many as there are at most, which the
        merges keep few."""
        if not names:
            return []
        spark, key = rows.sparkSession, F.col(self.key)
        sizes = [name.rsplit("_", 2)[1:] for name in names]
        asked = F.array(
            *[
                F.struct(
                    F.lit(name.removeprefix("run=")).alias("run"),
                    _bucket(key, int(buckets)).alias("bucket"),
                    _prefix(key, int(prefixes)).alias("prefix"),
                )
                for name, (buckets, prefixes) in zip(names, sizes, strict=True)
            ]
        )
        probes = rows.select(self.key, F.explode(asked).alias("at")).select(self.key, "at.*")
        hits = probes.join(self._filters(spark, names), ["run", "bucket"])
        for position in _positions(key):
            hits = hits.where(_is_set(F.col("bits"), position))
        suspects = hits.select("run", "prefix").distinct().collect()
        return sorted(f"{self.path}.ids/run={s['run']}/prefix={s['prefix']}" for s in suspects)

    def _filters(self, spark: SparkSession, names: list[str]) -> DataFrame:
        merged = [name for name in names if not name.startswith("run=0-")]
        if merged != self._held_names:
            if self._held is not None:
                self._held.unpersist()
            self._held_names = merged
            held = self._read_filters(spark, merged) if merged else None
            self._held = held and held.persist(StorageLevel.MEMORY_AND_DISK)
        newest = [name for name in names if name.startswith("run=0-")]
        parts = [self._held] if self._held is not None else []
        if newest:
            parts.append(self._read_filters(spark, newest))
        return reduce(DataFrame.unionByName, parts)

    def _read_filters(self, spark: SparkSession, names: list[str]) -> DataFrame:
        root = f"{self.path}.filters"
        read = spark.read.schema(_FILTER).option("basePath", root)
        return read.parquet(*[f"{root}/{name}" for name in names])


def _run_name(folder: str) -> str:
    return folder.removeprefix("run=").rsplit("_", 2)[0]
