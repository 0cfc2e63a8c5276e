"""Sums of large numeric tables over all partitions, as a tree of shuffles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

BLOCK = 4096
_SCHEMA = "block int, salt int, cells binary"


def _emit(table: np.ndarray, salt: int) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(table), BLOCK * 64):
        cells = table[a:a + BLOCK * 64].reshape(-1, BLOCK)
        used = np.flatnonzero(cells.any(axis=1))
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used + a // BLOCK, pa.int32()), pa.array(np.full(len(used), salt), pa.int32()),
                 pa.array([cells[k].tobytes() for k in used], pa.binary())], names=["block", "salt", "cells"])


def table_sum(df: DataFrame, size: int, dtype: str, add: Callable[[pa.RecordBatch, np.ndarray], None],
              fan: int = 32) -> np.ndarray:
    """Sum of one table of ``size`` cells per partition, where ``add(batch, table)`` adds a
    batch's part. A partition sends its blocks of cells; each (block, salt) adds up as a stream,
    then each block, so no task holds more than one table and the driver gets exactly one."""
    width = -(-size // BLOCK) * BLOCK

    def count(batches):
        table = np.zeros(width, dtype)
        for batch in batches:
            add(batch, table)
        yield from _emit(table, TaskContext.get().partitionId() % fan)

    def merge(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, c in zip(batch.column("block").to_pylist(), batch.column("cells")):
                cells = np.frombuffer(c.as_buffer(), dtype)
                held[b] = held[b] + cells if b in held else cells.copy()
        ks = sorted(held)
        yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int32()), pa.array([0] * len(ks), pa.int32()),
                                          pa.array([held[k].tobytes() for k in ks], pa.binary())], names=["block", "salt", "cells"])

    part = df.mapInArrow(count, _SCHEMA)
    once = part.repartition("block", "salt").mapInArrow(merge, _SCHEMA)
    total = once.repartition("block").mapInArrow(merge, _SCHEMA)
    out = np.zeros(width, dtype)
    for row in total.select("block", "cells").collect():
        out[row.block * BLOCK:(row.block + 1) * BLOCK] += np.frombuffer(bytes(row.cells), dtype)
    return out[:size]
