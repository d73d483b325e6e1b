"""Union-find by arrays, for links found inside one task."""

from __future__ import annotations

import numpy as np


class Forest:
    """Smallest-label components over positions 0..n-1, fed with batches of pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def _settle(self) -> None:
        while True:
            further = self.label[self.label]
            if np.array_equal(further, self.label):
                return
            self.label = further

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.label[i], self.label[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            self._settle()

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """(position, root) of all positions that are not their own root: a spanning star each."""
        moved = np.flatnonzero(self.label != np.arange(len(self.label)))
        return moved, self.label[moved]
