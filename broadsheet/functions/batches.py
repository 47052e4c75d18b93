"""Parts of Arrow columns: a task holds one part of a batch as Python objects, not the batch."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Executors then need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PART_BYTES, ROW_BYTES = 1 << 20, 64


def parts(texts: pa.Array, limit: int = PART_BYTES) -> Iterator[slice]:
    """Consecutive stretches of the rows, of about ``limit`` bytes of text, one row at least."""
    # Empty texts count as well, so that very many of them are no single part.
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + ROW_BYTES
    ends = np.cumsum(sizes)
    low = 0
    while low < len(texts):
        before = ends[low] - sizes[low]
        high = max(low + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield slice(low, high)
        low = high
