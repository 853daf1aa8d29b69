"""Anchors of fixed-length windows over sequences of symbols.

A window of ``window`` symbols is anchored at its smallest n-gram by hash (the leftmost of
equals). Equal windows have equal anchors at equal places, so a window can only recur where
the n-gram it is anchored at recurs, and of all n-grams just a few are anchors.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.arrays import span_hashes


def gram_hashes(symbols: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` symbols from every place on."""
    starts = np.arange(max(len(symbols) - size + 1, 0))
    return span_hashes(symbols, starts, starts + size)


def anchored_windows(grams: np.ndarray, bounds: np.ndarray, window: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First places of all windows that lie within one text, and of their anchors.

    ``bounds`` holds the first place of every text and the end.
    """
    width = window - size + 1
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    value, at = grams, np.arange(len(grams))
    step = 1
    while step < width:
        # The leftmost smallest of a range is that of two overlapping halves.
        shift = min(step, width - step)
        left, right = value[:-shift], value[shift:]
        later = right < left
        at = np.where(later, at[shift:], at[:-shift])
        value = np.where(later, right, left)
        step += shift
    starts = np.arange(n)
    text = np.searchsorted(bounds, starts, side="right") - 1
    whole = starts + window <= bounds[text + 1]
    return starts[whole], at[:n][whole]


def runs(values: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of every run of equal values at neighbouring places."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.r_[True, (values[1:] != values[:-1]) | (places[1:] != places[:-1] + 1)]
    firsts = np.flatnonzero(new)
    return firsts, np.diff(np.r_[firsts, len(values)])


def covered(n: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in one of the ranges."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0
