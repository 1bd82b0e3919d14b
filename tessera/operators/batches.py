"""Arrow batches cut to a size in bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Bytes of a part; what Python makes of it is some ten times as large.
PART_BYTES = 1 << 21


def small_batches(batches: Iterator[pa.RecordBatch], most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in parts of about ``most`` bytes and one row at least, so that what Python objects of a part
    take doesn't grow with the batches that Spark hands over."""
    for batch in batches:
        step = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
