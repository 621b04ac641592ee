"""Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STEP = 256  # rows turned into Python objects at a time


def slices(batches: Iterator[pa.RecordBatch], step: int = STEP) -> Iterator[pa.RecordBatch]:
    """The batches' rows, ``step`` at a time, so that few whole texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def sized(batches: Iterator[pa.RecordBatch], name: str, size: int) -> Iterator[pa.RecordBatch]:
    """The batches' rows, about ``size`` bytes of column ``name`` at a time; a longer value comes alone or last."""
    for batch in batches:
        before = np.cumsum(pc.fill_null(pc.binary_length(column(batch, name)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = np.flatnonzero(np.diff(before // size, prepend=-1)).tolist()
        for start, end in zip(at, [*at[1:], batch.num_rows]):
            yield batch.slice(start, end - start)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.names.index(name))


def values(batch: pa.RecordBatch, name: str) -> list:
    return column(batch, name).to_pylist()


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """The strings' UTF-8 bytes."""
    return column(batch, name).cast(pa.binary()).to_pylist()
