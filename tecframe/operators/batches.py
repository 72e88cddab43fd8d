"""Whole groups out of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd


def group_starts(pdf: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    """First row of every group of a frame sorted by the keys."""
    new = np.zeros(len(pdf), dtype=bool)
    new[0] = True
    for k in keys:
        v = pdf[k]
        before = v.shift(1)
        new |= ((v != before) & ~(v.isna() & before.isna())).to_numpy(bool, na_value=True)
    return np.flatnonzero(new)


def whole_groups(
    batches: Iterator[pd.DataFrame], keys: Sequence[str]
) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Yields (rows, group starts) such that no group is cut by a batch border.

    Only the last, unfinished group of a batch waits for the next batch.
    """
    waiting: list[pd.DataFrame] = []
    for pdf in batches:
        if pdf.empty:
            continue
        if waiting:
            pdf = pd.concat([*waiting, pdf], ignore_index=True)
        starts = group_starts(pdf, keys)
        cut = int(starts[-1])
        waiting = [pdf.iloc[cut:].reset_index(drop=True)]
        if cut:
            yield pdf.iloc[:cut], starts[:-1]
    if waiting:
        yield waiting[0], np.array([0])
