"""Rows of one group met in one frame, from a table that is dealt out and sorted by its groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

GROUP = ["key", "i", "j"]


def by_group(handle: Callable[[pd.DataFrame], pd.DataFrame]):
    """Calls handle with frames that hold whole groups, from rows in the order of their groups."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            if not len(frame):
                continue
            last = (frame[GROUP] == frame[GROUP].iloc[-1]).all(axis=1).to_numpy()
            start = len(frame) - int(np.argmin(last[::-1])) if not last.all() else 0
            rest = frame.iloc[start:].reset_index(drop=True)
            if start:
                yield handle(frame.iloc[:start].reset_index(drop=True))
        if rest is not None:
            yield handle(rest)

    return run


def group_numbers(frame: pd.DataFrame) -> np.ndarray:
    values = frame[GROUP].to_numpy()
    return np.cumsum(np.append(True, (values[1:] != values[:-1]).any(axis=1))) - 1


def map_groups(rows: DataFrame, handle: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    dealt = rows.repartition(*GROUP).sortWithinPartitions(*GROUP)
    return dealt.mapInPandas(by_group(handle), schema)


def neighbours(frame: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one group, as arrays of their positions: each row with the next one, with
    the one after that, and so on. In a group of two blocks (i is not j) only pairs across them."""
    group, own = group_numbers(frame), frame["own"].to_numpy()
    cross = (frame["i"] != frame["j"]).to_numpy()
    at, step = np.arange(len(frame)), 1
    while len(at):
        at = at[at + step < len(frame)]
        at = at[group[at] == group[at + step]]
        ahead = at + step
        apart = ~cross[at] | (own[at] != own[ahead])
        yield at[apart], ahead[apart]
        step += 1


def local_components(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per row the smallest id that it reaches by the links a - b."""
    label = ids.copy()
    while True:
        least, before = np.minimum(label[a], label[b]), label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        if (before == label).all():
            return label
