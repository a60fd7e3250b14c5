"""What the operators share: reading a table, Arrow batches in bounded steps, cutting lineage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickstar.runtime import scratch_path

#: Bytes of texts that a task gathers before it writes them, and that it works on at a time.
ROW_GROUP, SLICE = 16 << 20, 4 << 20
#: Rows of a batch that are turned into Python objects at a time.
STEP = 256


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def hashable(kind: T.DataType) -> bool:
    """Whether Spark hashes values of a type: all but maps and variants, however deep they are."""
    if isinstance(kind, T.ArrayType):
        return hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(hashable(field.dataType) for field in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def written(df: DataFrame, purpose: str, row_group: int | None = None) -> DataFrame:
    """The rows as a table in the shared folder, which outlives executors; plans start anew.
    ``row_group``: bytes that a task gathers before it writes them, for tables of whole texts."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    writer = df.write.option("compression", "zstd")
    if row_group is not None:
        writer = writer.option("parquet.block.size", row_group)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(column: pa.Array) -> Iterator[str]:
    """The texts of an Arrow column, a null one as the empty text, some at a time."""
    for start in range(0, len(column), STEP):
        for text in column.slice(start, STEP).to_pylist():
            yield "" if text is None else text


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """A batch in parts whose texts have at most ``most`` bytes, but for single longer ones."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, end - start)
        start = end


Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Free memory of this process goes back to the system, where its allocators would keep it: a
    worker lives on from stage to stage, and would have the peaks of them all."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library, which has no such call


def released(work: Work) -> Work:
    """The same work, and memory given back at the end of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run
