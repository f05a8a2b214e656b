"""Eigendecomposition of a scatter matrix under rank-one updates.

A spectrum holds the eigenvalues and eigenvectors of the centred scatter of the rows seen so far. A further row adds a
rank-one matrix to it; the new eigenvalues are the roots of a secular equation between the old ones, found for all
intervals at once, and the new vectors follow from them. Directions that the update does not touch, and directions of
equal eigenvalues, are set aside before (deflation), so that the equation has simple roots.
"""

from __future__ import annotations

import numpy as np

EPSILON = np.finfo(np.float64).eps
# Steps of the root finder; its bisection alone would halve an interval to nothing in fewer.
STEPS = 120


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(weights / (poles - x)) for rising poles and positive weights.

    Returns the roots, one above each pole, and their distances (root i, pole j) to all poles, which are exact where
    the roots themselves would lose digits.
    """
    k = len(poles)
    reach = weights.sum()
    if k == 1:
        return poles + reach, np.array([[reach]])
    gaps = np.append(np.diff(poles), reach)
    lines = np.arange(k)
    # The origin of a root is the nearer of the poles beside it: the equation is above zero at the middle if it is the left.
    middle = weights / (poles[None, :] - (poles + gaps / 2)[:, None])
    right = (1 + middle.sum(axis=1) < 0) & (lines < k - 1)
    origin = np.where(right, lines + 1, lines)
    from_origin = poles[None, :] - poles[origin][:, None]
    low = np.where(right, -gaps / 2, 0.0)
    high = np.where(right, 0.0, np.where(lines < k - 1, gaps / 2, gaps))
    x = (low + high) / 2
    # A step solves an equation of the two poles beside the root: the weight of the origin is kept, that of the other
    # pole and a constant are fitted to value and slope. The last root has both poles on its left, and fits both.
    left = np.minimum(lines, k - 2)
    other = np.where(right, left, left + 1)
    apart = poles[origin] - poles[other]
    for _ in range(STEPS):
        distance = from_origin - x[:, None]
        terms = weights / distance
        slopes = terms / distance
        value = 1 + terms.sum(axis=1)
        found = np.abs(value) <= 8 * EPSILON * k * (1 + np.abs(terms).sum(axis=1))
        if found.all():
            break
        high, low = np.where(value > 0, x, high), np.where(value > 0, low, x)
        near, far, slope = distance[lines, left], distance[lines, left + 1], slopes.sum(axis=1)
        c = value - distance[lines, other] * slope - apart * slopes[lines, origin]
        c[-1] = value[-1] - near[-1] * (slope[-1] - slopes[-1, -1]) - far[-1] * slopes[-1, -1]
        a = (near + far) * value - near * far * slope
        b = near * far * value
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            last = np.where(a >= 0, (a + root) / (2 * c), 2 * b / (a - root))
            new = x + np.where(lines < k - 1, step, last)
        inside = (new > low) & (new < high)
        halved = (low + high) / 2
        new = np.where(found, x, np.where(inside, new, halved))
        if (new == x).all():
            break
        x = new
    return poles[origin] + x, x[:, None] - from_origin


class Spectrum:
    """Count, mean, eigenvalues (rising) and eigenvectors (columns) of the centred scatter of weighted rows."""

    def __init__(self, size: int) -> None:
        self.n, self.mean = 0.0, np.zeros(size)
        self.values, self.vectors = np.zeros(size), np.eye(size)

    def add(self, row: np.ndarray, copies: float = 1.0) -> None:
        """Take in a row that occurs `copies` times."""
        away = row - self.mean
        if self.n:
            self._update(away, self.n * copies / (self.n + copies))
        self.n += copies
        self.mean = self.mean + away * (copies / self.n)

    def merge(self, other: Spectrum) -> None:
        """Take in all rows behind another spectrum: its directions one by one, then the way between the means."""
        if not other.n:
            return
        away = other.mean - self.mean
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self._update(vector, value)
        if self.n:
            self._update(away, self.n * other.n / (self.n + other.n))
        self.n += other.n
        self.mean = self.mean + away * (other.n / self.n)

    def _update(self, row: np.ndarray, weight: float) -> None:
        """Add weight * row row^T."""
        z = self.vectors.T @ row
        scale = max(self.values[-1], weight * float(z @ z))
        if not scale > 0:
            return
        tolerance = 8 * EPSILON * scale
        self._turn_equal(z, tolerance)
        active = weight * np.abs(z) * np.sqrt(float(z @ z)) > tolerance
        if not active.any():
            return
        poles, own = self.values[active], z[active]
        roots, distances = secular_roots(poles, weight * own * own)
        # The vectors of the exact problem whose roots these are: orthogonal however the roots are rounded.
        k = len(poles)
        apart = poles[:, None] - poles[None, :]
        rows = np.arange(k)
        beside = np.where(rows[:, None] < rows[None, :], apart, np.vstack([apart[1:], np.full((1, k), weight)]))
        own = np.sign(own) * np.sqrt(np.abs(np.prod(distances / beside, axis=0)))
        turned = own[:, None] / distances.T
        turned /= np.sqrt((turned * turned).sum(axis=0))
        self.values[active] = roots
        self.vectors[:, active] = self.vectors[:, active] @ turned
        order = np.argsort(self.values, kind="stable")
        self.values, self.vectors = self.values[order], self.vectors[:, order]

    def _turn_equal(self, z: np.ndarray, tolerance: float) -> None:
        """Reflect the directions of equal eigenvalues so that the update touches one of each set alone."""
        starts = np.flatnonzero(np.diff(self.values, prepend=-np.inf) > tolerance)
        for first, last in zip(starts, np.append(starts[1:], len(z))):
            if last - first < 2:
                continue
            part = z[first:last].copy()
            size = np.sqrt(part @ part)
            if size == 0:
                continue
            sign = 1.0 if part[0] >= 0 else -1.0
            part[0] += sign * size
            own = self.vectors[:, first:last]
            self.vectors[:, first:last] = own - np.outer(own @ part, part * (2 / (part @ part)))
            z[first:last] = 0
            z[first] = -sign * size
