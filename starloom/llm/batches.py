"""Helpers for Arrow tasks over texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHARS = 2_000_000
ROWS = 256


def slices(texts: list[str], chars: int = CHARS, rows: int = ROWS) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts with at most about `chars` characters and `rows` texts each, so long texts do not pile up."""
    if not texts:
        return
    block = np.cumsum([len(t) for t in texts]) // chars + np.arange(len(texts)) // rows * 1_000_003
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(texts)]
    yield from zip(cuts, cuts[1:])


def text_slices(column: pa.Array, chars: int = CHARS, rows: int = ROWS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of consecutive parts of a text column, bounded like slices(); only one part at a time becomes Python text.

    A null text counts as empty.
    """
    size = np.asarray(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), np.int64)
    block = np.cumsum(size) // chars + np.arange(len(size)) // rows * 1_000_003
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(size)] if len(size) else [0]
    for low, high in zip(cuts, cuts[1:]):
        yield low, [t or "" for t in column.slice(low, high - low).to_pylist()]
