"""Small helpers for operators that work on Arrow batches inside Spark tasks.

Spark cuts the batches of ``mapInArrow`` by rows and by bytes, so one batch has
a bounded size however long the texts are; ``blocks`` cuts further where an
operator needs several times its input as memory.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The six white space bytes of the contracts: 0x20 and 0x09 to 0x0D. bytes.split() cuts at the same ones.
WHITESPACE = b" \t\n\x0b\x0c\r"
BLOCK_BYTES = 4 << 20


def byte_values(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [v or b"" for v in column.cast(kind).to_pylist()]


def text_values(column: pa.Array) -> list[str]:
    """Texts of a column; null is the empty text."""
    return [v or "" for v in column.to_pylist()]


def full_texts(column: pa.Array) -> pa.Array:
    """A text column with the empty text in place of nulls."""
    return pc.fill_null(column, "")


_kept: dict = {}


def kept(make: Callable, *key):
    """``make(*key)``, kept by the worker process from task to task; only the newest is, so no operator's memory outlives its stage."""
    if (make, key) not in _kept:
        release()
        _kept[make, key] = make(*key)
    return _kept[make, key]


def release() -> None:
    """Give up what the tasks of other operators left in this worker process."""
    if _kept:
        _kept.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()


def blocks(whole: pa.RecordBatch, column: int, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``limit`` bytes of text in ``column`` each; only one needs Python objects at a time."""
    sizes = pc.fill_null(pc.binary_length(whole.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    first = 0
    while first < whole.num_rows:
        before = ends[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield whole.slice(first, end - first)
        first = end


def fields(df: DataFrame, *names: str) -> list[T.StructField]:
    """The schema fields of ``names``, for the schema of a result that carries them on."""
    return [T.StructField(n, df.schema[n].dataType, True) for n in names]


def plain_names(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with numbered column names, which clash with none an operator uses, and the new ones of ``names``."""
    own = [f"column_{i}" for i in range(len(df.columns))]
    return df.toDF(*own), [own[df.columns.index(n)] for n in names]


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
