"""Small graphs in one task: what a tile's links say about components."""

from __future__ import annotations

import numpy as np


def least_reachable(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``size`` nodes the smallest node that the links (a, b) reach, itself included."""
    least = np.arange(size)
    while True:
        before = least.copy()
        np.minimum.at(least, a, before[b])
        np.minimum.at(least, b, before[a])
        least = least[least]
        if (least == before).all():
            return least
