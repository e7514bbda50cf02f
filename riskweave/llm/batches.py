"""Groups of a sorted partition, without holding more than one of them beyond a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd


def whole_groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Regroup the batches of a partition sorted by ``keys`` so that no group is cut. Keys are never null."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if frame.empty:
            continue
        last = np.ones(len(frame), bool)
        for key in keys:
            last &= frame[key].to_numpy() == frame[key].iloc[-1]
        start = len(frame) - int(last.sum())
        if held and (start or any(held[-1][key].iloc[-1] != frame[key].iloc[0] for key in keys)):
            yield pd.concat([*held, frame.iloc[:start]], ignore_index=True)
            held = []
        elif start:
            yield frame.iloc[:start]
        held.append(frame.iloc[start:])
    if held:
        yield pd.concat(held, ignore_index=True)


def bounds(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Where groups of a frame sorted by ``keys`` start, and the frame's length at the end."""
    change = np.zeros(len(frame), bool)
    change[:1] = True
    for key in keys:
        values = frame[key].to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(change), len(frame))
