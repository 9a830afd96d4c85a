"""Groups of sorted rows inside ``mapInArrow``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def groups_of(batches: Iterator[pa.RecordBatch], keys: int = 1) -> Iterator[pa.Table]:
    """Rows of equal values in the first ``keys`` (number) columns, which follow each other, as one table."""
    held: list[pa.RecordBatch] = []
    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.column_stack([c.to_numpy() for c in batch.columns[:keys]])
        cuts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if at is not None and at != tuple(values[a]):
                yield pa.Table.from_batches(held)
                held = []
            at = tuple(values[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
