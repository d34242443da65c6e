"""Arrow columns of vectors as numpy matrices, for the operators that scale
vectors to whole numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import map_batches

# Whole numbers that a double holds exactly.
EXACT = 2**53


def entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, lengths, usable) of an array<double> column: all entries one after
    another, the entries of each row, and whether the row is a vector without
    null or non-finite entries.  A null row has no entries."""
    lengths = np.asarray(pc.list_value_length(column).fill_null(0), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)  # a null entry becomes nan
    usable = np.asarray(column.is_valid())
    if len(flat):
        row = np.repeat(np.arange(len(lengths)), lengths)
        usable = usable & (np.bincount(row[~np.isfinite(flat)], minlength=len(lengths)) == 0)
    return flat, lengths, usable


def scaled(column: pa.Array, factor: float, width: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(matrix, usable): floor(factor * entry) as integers within ±``most``, a
    row per usable vector, ``width`` columns; shorter vectors end in zeros."""
    flat, lengths, usable = entries(column)
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.clip(np.floor(factor * flat), -float(most), float(most))
    own = np.repeat(usable, lengths)
    kept = lengths[usable]
    out = np.zeros((len(kept), width), np.int64)
    starts = np.repeat(np.cumsum(kept) - kept, kept)
    out[np.repeat(np.arange(len(kept)), kept), np.arange(kept.sum()) - starts] = whole[own].astype(np.int64)
    return out, usable


def packed(matrix: np.ndarray) -> pa.Array:
    """Rows as binary values (little-endian 64-bit integers)."""
    data = np.ascontiguousarray(matrix, "<i8")
    size = data.shape[1] * 8
    offsets = np.arange(len(data) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unpacked(column: pa.Array, width: int) -> np.ndarray:
    """Inverse of ``packed``."""
    if not len(column):
        return np.zeros((0, width), np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), width)


def width_of(vectors: DataFrame, embedding: str) -> int:
    """Entries of the longest usable vector (0 if there is none)."""
    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = -1
        for b in batches:
            _, lengths, usable = entries(b.column(0))
            most = max([most, *lengths[usable].tolist()])
        yield pa.RecordBatch.from_arrays([pa.array([most], pa.int64())], names=["width"])

    found = map_batches(vectors.select(F.col(embedding).cast("array<double>").alias("v")), longest, "width long")
    return max(0, found.agg(F.max("width")).first()[0] or 0)
