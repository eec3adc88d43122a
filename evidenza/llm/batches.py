"""Arrow helpers: functions over a text column that hold a bounded slice at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of text that one slice holds; a single longer text is a slice of its own.
SLICE_BYTES = 2 << 20


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, at least one row each."""
    if not len(texts):
        return
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, stop
        start = stop


def text_udf(
    work: Callable[[pa.Array], pa.Array], returns: str, limit: int = SLICE_BYTES
) -> Callable[[Column], Column]:
    """Arrow function of a string column, called on slices of each batch of at most ``limit`` bytes."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [work(batch.slice(a, b - a)) for a, b in slices(batch, limit)]
            yield pa.concat_arrays(parts) if parts else work(batch)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, returns)
