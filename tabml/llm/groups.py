"""Runs of equal keys in a sorted stream of Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def runs(batches, n_keys: int):
    """Yield one table per run of rows whose first ``n_keys`` columns (numbers without nulls) are equal.

    The partition must hold its rows in the order of these columns. Only the
    run that goes on into the next batch is held back.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(n_keys)])
        cut = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        if held and (keys[:, 0] != last).any():
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cut, cut[1:]):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
        last = keys[:, -1]
    if held:
        yield pa.Table.from_batches(held)
