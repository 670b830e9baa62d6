"""Shared helpers: reading tables, cutting lineage, Arrow plumbing."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import materialize

SLICE_BYTES = 4 << 20
BATCH_ROWS = 1000  # rows of an Arrow batch; the default of 10,000 texts fills tens of MB


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Arrow batches hold at most ``BATCH_ROWS`` rows while it is written: both
    the JVM and the Python worker of a task hold a batch."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key, None)
    conf.set(key, str(BATCH_ROWS))
    try:
        return materialize(df, f"llm-{label}")
    finally:
        if before is None:
            conf.unset(key)
        else:
            conf.set(key, before)


def small_batches(spark: SparkSession) -> None:
    """Hold Arrow batches of the session to ``BATCH_ROWS`` rows.  For results that the
    caller runs: the size is read when they are planned, beyond ``cut``'s reach."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "0")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def give_back() -> None:
    """Return freed memory to the system.  Python workers outlive their tasks,
    and allocators otherwise keep what the largest step of a stage needed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def giving_back(batches):
    """The batches, then ``give_back`` once the step that made them is done."""
    yield from batches
    del batches
    give_back()


def replacing(df: DataFrame, source: str, *outputs: str) -> DataFrame:
    """``df`` without columns named like an output: the outputs replace them."""
    names = {o.lower() for o in outputs}
    if source.lower() in names:
        raise ValueError(f"the output {source} is named like the input it is made from")
    return df.select(*(c for c in df.columns if c.lower() not in names))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Cut a batch into runs of rows whose ``column`` holds about ``limit`` bytes.

    One row longer than the limit is a slice by itself.  This bounds the
    Python objects and numpy temporaries that one step holds."""
    col = batch.column(batch.schema.get_field_index(column))
    n = batch.num_rows
    if not n:
        return
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes.astype(np.int64)) // limit
    edges = np.flatnonzero(np.diff(run)) + 1
    for a, b in zip([0, *edges], [*edges, n]):
        yield batch.slice(a, b - a)


def long_list(flat: np.ndarray, lens: np.ndarray, kind=None) -> pa.ListArray:
    """A list column from its flat values and the length of each row."""
    offsets = np.zeros(len(lens) + 1, dtype=np.int32)
    np.cumsum(lens, out=offsets[1:])
    values = pa.array(flat) if kind is None else pa.array(flat, type=kind)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def string_list(words: list[bytes], lens: np.ndarray) -> pa.ListArray:
    """A list<string> column from UTF-8 words and the word count of each row."""
    sizes = np.fromiter(map(len, words), dtype=np.int32, count=len(words))
    ends = np.zeros(len(words) + 1, dtype=np.int32)
    np.cumsum(sizes, out=ends[1:])
    values = pa.StringArray.from_buffers(
        len(words), pa.py_buffer(ends.tobytes()), pa.py_buffer(b"".join(words)))
    offsets = np.zeros(len(lens) + 1, dtype=np.int32)
    np.cumsum(lens, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
