"""Numpy parts of the similarity joins: linked classes inside one task, and sizes of a grid of blocks."""

from __future__ import annotations

import numpy as np


def roots(parent: np.ndarray) -> np.ndarray:
    """Shortens every path to its end, in place."""
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent[:] = up


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Puts the items ``a[i]`` and ``b[i]`` into one class; the smallest index of a class is its root."""
    while len(a):
        roots(parent)
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def grid(rows: int, most: int) -> int:
    """Blocks a side, so that none is expected to have more than ``most`` rows."""
    return max(1, -(-rows // most))
