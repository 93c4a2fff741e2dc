"""Arrow batches in parts of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batch: pa.RecordBatch, most: int, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``most`` bytes in a binary column; longer rows alone."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    before = np.cumsum(sizes.astype(np.int64)) - sizes
    cuts = np.flatnonzero(np.diff(before // most)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for first, last in zip(edges, edges[1:]):
        yield batch.slice(first, last - first)
