"""Groups of a partition that is sorted by its first column, one at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def sorted_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of equal leading column. Holds one group at a time, over any number of batches."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        key = rows.column(0).to_numpy()
        ends = np.flatnonzero(key[1:] != key[:-1]) + 1
        if held and held[-1].column(0)[0].as_py() != key[0]:
            yield pa.concat_tables(held)
            held = []
        for a, b in zip([0, *ends], [*ends, len(key)]):
            if a and held:
                yield pa.concat_tables(held)
                held = []
            held.append(rows.slice(a, b - a))
    if held:
        yield pa.concat_tables(held)
