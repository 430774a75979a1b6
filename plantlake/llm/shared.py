"""What the operators of this package share: tables of their own, Arrow passes, folds."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from pathlib import Path
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.config import shared_folder

PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])

#: Rows of an Arrow batch.
BATCH_ROWS = 1000
#: Texts are handled in runs of about so many bytes inside a task, whatever the Arrow batch holds.
CHUNK_BYTES = 4 << 20


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the folder all executors share and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, never this table.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_row(docs: DataFrame, name: str = "_row") -> DataFrame:
    """Number the rows. Only stable once stored, so callers store what they make of it."""
    return docs.select(F.monotonically_increasing_id().alias(name), *[docs[c] for c in docs.columns])


def on_executors(function: Callable, *args) -> Callable[[Iterator[pa.RecordBatch]], Iterator]:
    """A body for ``mapInArrow``: ``function(batches, *args)``, imported where the task runs.

    Sets the rows of an Arrow batch for the session: whole texts are long, and a batch is held several
    times over between Spark and Python.
    """
    root, module, name = PACKAGE_ROOT, function.__module__, function.__name__
    SparkSession.active().conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches):
        import importlib
        import sys

        if root not in sys.path:
            sys.path.append(root)
        try:
            yield from getattr(importlib.import_module(module), name)(batches, *args)
        finally:
            importlib.import_module("plantlake.llm.shared").release()

    return run


def release() -> None:
    """Give memory back at the end of a task: Spark keeps its Python workers for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def on_group(function: Callable, *args) -> Callable[[pa.Table], pa.Table]:
    """A body for ``applyInArrow``: ``function(table, *args)``, imported where the task runs."""
    root, module, name = PACKAGE_ROOT, function.__module__, function.__name__

    def run(table):
        import importlib
        import sys

        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), name)(table, *args)

    return run


def on_cogroup(function: Callable, *args) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A body for ``applyInArrow`` on two grouped frames: ``function(left, right, *args)``."""
    root, module, name = PACKAGE_ROOT, function.__module__, function.__name__

    def run(left, right):
        import importlib
        import sys

        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), name)(left, right, *args)

    return run


def remainder(doc_id: str | Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string")) % by


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column and the n + 1 offsets of its rows; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), starts - starts[0]
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``size`` bytes, one row at least."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def batch(like: pa.RecordBatch, keep: list[str], **columns) -> pa.RecordBatch:
    """Columns ``keep`` of a batch and new ones behind them."""
    made = {k: like.column(k) for k in keep}
    made |= {k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()}
    return pa.RecordBatch.from_arrays(list(made.values()), names=list(made))
