"""Tables of a fixed size that every task fills and Spark adds up."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

CHUNK_BYTES = 1 << 16  # of a table that travel together
FAN_IN = 256  # partial tables that one task adds up at first


def added_up(rows: DataFrame, fill: Callable[[Iterator[pa.RecordBatch], np.ndarray], None], size: int, dtype: str) -> np.ndarray:
    """The sum of all tasks' tables of `size` numbers; `fill(batches, table)` adds a task's rows to its own.

    Tables are summed in chunks, so no task holds more than FAN_IN chunks at first and one for each
    FAN_IN tasks then. The driver gets one table.
    """
    step = CHUNK_BYTES // np.dtype(dtype).itemsize
    names = ["chunk", "salt", "sums"]
    schema = "chunk int, salt int, sums binary"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size, dtype=dtype)
        fill(batches, table)
        salt = TaskContext.get().partitionId() // FAN_IN
        for chunk, at in enumerate(range(0, size, step)):
            part = table[at : at + step]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([salt], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=names)

    def total(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out = np.frombuffer(frame.sums.iloc[0], dtype=dtype).copy()
        for sums in frame.sums.iloc[1:]:
            out += np.frombuffer(sums, dtype=dtype)
        return pd.DataFrame({"chunk": [key[0]], "salt": [0], "sums": [out.tobytes()]})

    parts = rows.mapInArrow(partial, schema).groupBy("chunk", "salt").applyInPandas(total, schema)
    table = np.zeros(size, dtype=dtype)
    for row in parts.groupBy("chunk").applyInPandas(total, schema).toLocalIterator():
        sums = np.frombuffer(bytes(row.sums), dtype=dtype)
        table[row.chunk * step : row.chunk * step + len(sums)] = sums
    return table
