"""Distributed sums of fixed-size numpy partials (the treeAggregate pattern of Spark ML).

Each task reads its rows as Arrow record batches (``mapInArrow``: columnar,
no per-row Python objects), folds them into one fixed-length partial with
numpy and emits its blocks that are not all zero.  The blocks are shuffled by their number and
summed as they stream in (a reducer holds its blocks once), so the driver receives every number
of the sum once, however many partitions there were, and never input rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# A vector is cut into at most this many blocks, of at least MIN_BLOCK numbers.
BLOCKS, MIN_BLOCK = 256, 4096


def list_column(batch: pa.RecordBatch, name: str, dtype) -> tuple[np.ndarray, np.ndarray]:
    """A list column of an Arrow batch as ``(lengths, flat values)`` numpy arrays (null lists -> length 0)."""
    arr = batch.column(batch.schema.get_field_index(name))
    lens = arr.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = arr.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return lens, flat


def one_list(column: pa.Array) -> pa.Array:
    """A column as the single list of a one-row column."""
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)


def runs(batches, most: int):
    """``(key, columns after it)`` for stretches of at most ``most`` rows with one key, from batches sorted by their first column."""
    held, key = [], None

    def out():
        t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return key, t.columns[1:]

    for b in batches:
        keys = b.column(0).to_numpy()
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for a, z in zip([0, *cuts], [*cuts, len(keys)]):
            while a < z:
                if held and (keys[a] != key or sum(h.num_rows for h in held) >= most):
                    yield out()
                    held = []
                key = int(keys[a])
                take = min(z - a, most - sum(h.num_rows for h in held))
                held.append(b.slice(a, take))
                a += take
    if held:
        yield out()


def sum_partials(df: DataFrame, fold, size: int, cols: list[str],
                 dtype=np.float64, arrow: bool = False) -> np.ndarray:
    """``sum over tasks of fold(batches)``.

    ``fold`` receives an iterator of batches holding columns ``cols`` --
    pandas DataFrames, or ``pyarrow.RecordBatch`` when ``arrow`` is set --
    and returns a vector of ``size`` numbers, or None for an empty partition.
    """
    out_dtype = np.dtype(dtype)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        src = batches if arrow else (b.to_pandas() for b in batches if b.num_rows)
        part = fold(src)
        if part is not None:
            part = np.ascontiguousarray(part, dtype=out_dtype)
            touched = [i for i in range(-(-size // block)) if part[i * block:(i + 1) * block].any()]
            for a in range(0, len(touched), 16):
                some = touched[a:a + 16]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()),
                                                  pa.array([part[i * block:(i + 1) * block].tobytes() for i in some], pa.binary())], ["block", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, cell in zip(b.column(0).to_pylist(), b.column(1)):
                part = np.frombuffer(cell.as_buffer(), dtype=out_dtype)
                if i in sums:
                    sums[i] += part
                else:
                    sums[i] = part.copy()
        for i, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                                             ["block", "part"])

    block = max(MIN_BLOCK, -(-size // BLOCKS))
    reducers = min(-(-size // block), max(1, df.sparkSession.sparkContext.defaultParallelism))
    schema = "block int, part binary"
    sums = df.select(*cols).mapInArrow(run, schema).repartition(reducers, "block").mapInArrow(add, schema).toArrow()
    out = np.zeros(size, dtype=out_dtype)
    for i, cell in zip(sums.column(0).to_pylist(), sums.column(1).to_pylist()):
        out[i * block:i * block + len(cell) // out_dtype.itemsize] = np.frombuffer(cell, dtype=out_dtype)
    return out
